"""Registered queries of the numbered operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontam,
    hash_forest,
    langid,
    license_scan,
    line_dedup,
    mixing,
    periodic_runs,
    setsketch,
    substring_dedup,
    suffix_dedup,
    token_align,
    token_count,
    token_store,
)

TOKENIZER_JSON = "word_bpe_49k.json"
TOKENIZER_MODEL = "piece_bpe_32k.model"
BYTE_TOKENIZER_JSON = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page without its host's boilerplate lines."""
    return line_dedup.drop_boilerplate(_table(spark, sf_dir, "pages"), max_ratio=0.3, min_pages=5)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 50-word windows seen in a smaller document."""
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), width=50)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds that are not held out."""
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.fit(docs.where("NOT held_out"))
    return langid.predict(docs, model, keep=["doc_id", "held_out"])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in a mix whose entropy is halfway to an even one."""
    docs = _table(spark, sf_dir, "documents")
    plan = mixing.plan(docs, evenness=0.5)
    out = mixing.copies(docs.select("doc_id", "source"), plan)
    return out.select("doc_id", "source", "n_copies")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    out = decontam.verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "contaminated", "n_regions", "items")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one, against all."""
    return hash_forest.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, on 4-word shingles at 0.8."""
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"), size=4, percent=80)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that start elsewhere too."""
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), width=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_MODEL))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to files and read back."""
    docs = _table(spark, sf_dir, "documents")
    path, _ = token_store.build_store(docs, public_tokenizers.path(TOKENIZER_JSON), end_id=2)
    return token_store.read_store(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers on every document, with the corpus-wide counts of its links."""
    docs = _table(spark, sf_dir, "documents")
    out, _ = token_align.align_corpus(docs, public_tokenizers.path(BYTE_TOKENIZER_JSON), public_tokenizers.path(TOKENIZER_MODEL))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named or quoted in every document."""
    out = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of them with a planted repetition."""
    docs = _table(spark, sf_dir, "documents")
    out = periodic_runs.periodic_runs(docs, rewrite=periodic_runs.planted, keep_text=False)
    return out.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_language_id": op3_language_id,
        "op4_mixing": op4_mixing,
        "op5_decontamination": op5_decontamination,
        "op6_nearest": op6_nearest,
        "op7_near_duplicates": op7_near_duplicates,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_token_counts": op9_token_counts,
        "op10_token_store": op10_token_store,
        "op11_token_alignment": op11_token_alignment,
        "op12_license_scan": op12_license_scan,
        "op13_periodic_runs": op13_periodic_runs,
    }


# Boilerplate lines, written independently on whole lines instead of hashes.
OP1_SQL = r"""
WITH cut AS (
  SELECT page_id, row_number() OVER () AS rid,
         coalesce(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)', 2)), '') AS host,
         regexp_replace(regexp_replace(regexp_replace(html,
           '(?is)<(script|style|head|noscript)\b[^>]*>.*?</(script|style|head|noscript)\s*>|<!--.*?-->|<!doctype[^>]*>', chr(10), 'g'),
           '(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)(\s[^>]*)?/?>', chr(10), 'g'),
           '<[^>]*>', '', 'g') AS body
  FROM pages),
plain AS (
  SELECT page_id, rid, host,
         replace(replace(replace(replace(replace(replace(coalesce(body, ''), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
           '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS body
  FROM cut),
raw_lines AS (
  SELECT rid, host, unnest(string_split(body, chr(10))) AS line,
         generate_subscripts(string_split(body, chr(10)), 1) AS pos
  FROM plain),
lines AS (
  SELECT rid, host, pos, regexp_replace(line, '^[ \t\r\f]+|[ \t\r\f]+$', '', 'g') AS line
  FROM raw_lines),
shown AS (SELECT * FROM lines WHERE line <> ''),
totals AS (SELECT host, count(*) AS n_pages FROM plain GROUP BY host),
boiler AS (
  SELECT s.host, s.line
  FROM (SELECT host, line, count(DISTINCT rid) AS n FROM shown GROUP BY host, line) s JOIN totals t USING (host)
  WHERE t.n_pages >= 5 AND s.n > 0.3 * t.n_pages),
flagged AS (
  SELECT s.rid, s.pos, s.line, b.line IS NOT NULL AS gone
  FROM shown s LEFT JOIN boiler b ON s.host = b.host AND s.line = b.line),
per_page AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS kept_text
  FROM flagged GROUP BY rid)
SELECT p.page_id, p.host, coalesce(x.n_lines, 0) AS n_lines, coalesce(x.n_removed, 0) AS n_removed,
       coalesce(x.kept_text, '') AS kept_text
FROM plain p LEFT JOIN per_page x USING (rid)
"""


# Temperature mixing: plain bisection in a recursive query, and one running sum
# per source over its whole permutation instead of blocks.
OP4_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, coalesce(source, '') AS source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\v\f\r]+'), lambda x: x <> '')) AS n_tokens,
         md5(coalesce(doc_id::VARCHAR, 'null')) AS place
  FROM documents),
sources AS (
  SELECT source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens) / (SELECT sum(n_tokens) FROM sized) AS share
  FROM sized GROUP BY source HAVING sum(n_tokens) > 0),
goal AS (
  SELECT h + 0.5 * (ln(n) - h) AS target
  FROM (SELECT count(*) AS n, sum(-share * ln(share)) AS h FROM sources)),
halving AS (
  SELECT 0 AS k, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT k + 1, CASE WHEN met THEN low ELSE mid END, CASE WHEN met THEN mid ELSE high END
  FROM (
    SELECT k, low, high, (low + high) / 2 AS mid,
           ln(sum(share ** ((low + high) / 2)))
             - (low + high) / 2 * sum(share ** ((low + high) / 2) * ln(share)) / sum(share ** ((low + high) / 2))
             <= (SELECT target FROM goal) AS met
    FROM halving, sources WHERE k < 50 GROUP BY k, low, high)),
chosen AS (SELECT high AS alpha FROM halving WHERE k = 50),
quotas AS (
  SELECT source, tokens,
         floor(share ** alpha / sum(share ** alpha) OVER () * sum(tokens) OVER ())::BIGINT AS quota
  FROM sources, chosen),
running AS (
  SELECT s.doc_id, s.source, q.quota, q.tokens,
         sum(s.n_tokens) OVER (PARTITION BY s.source ORDER BY s.place RANGE UNBOUNDED PRECEDING) AS paid
  FROM sized s LEFT JOIN quotas q USING (source))
SELECT doc_id, source,
       CASE WHEN tokens IS NULL THEN 1
            ELSE quota // tokens + CASE WHEN paid <= quota - quota // tokens * tokens AND quota % tokens > 0 THEN 1 ELSE 0 END
       END::BIGINT AS n_copies
FROM running
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op4_mixing": OP4_SQL}
