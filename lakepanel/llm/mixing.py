"""Operator 4: mixing sources to target weights (DataFrame functions only).

Temperature mixing: a source with token share ``p`` gets a weight in proportion
to ``p ** alpha``.  The exponent in [0, 1] is bisected until the weights'
entropy meets a target, or until no source is repeated more often than a
limit.  Weights become token quotas of a budget, and quotas become copies:

* a source whose quota is ``e`` times its tokens and ``r`` tokens more has
  each document ``e`` times, and the first ``r`` tokens of its permutation
  once more;
* the permutation orders a source's documents by a hash of their id.  Blocks
  are hash prefixes, so the place where a quota ends is found by running sums
  over at most 4096 blocks of a source, then over at most 4096 blocks of one of
  these, then over the documents of one such small block.  No task sees a whole
  source, however large, and the result is one cut per source.

The bisection evaluates 33 exponents per pass over the table of sources (one
row each), five halvings at once.

Defined results: a null source is the source ``''``, a null text has no
tokens; documents without tokens are copied as their source is; rows that
repeat an id share their place in the permutation; with no tokens at all,
every document has one copy; texts of any length count whole; an empty table
gives an empty result; other columns are kept, also those named like helper
columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import own_names, stored

PASSES = 10
HALVINGS = 5
PREFIX = 3  # hex digits of a block: 4096 blocks


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than space and 0x09-0x0D."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \t\n\u000b\f\r]+")
    return F.size(F.filter(parts, lambda x: x != "")).cast("long")


def place_in_permutation(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))


def _named(source: Column) -> Column:
    return F.coalesce(source.cast("string"), F.lit(""))


def find_exponent(sources: DataFrame, target_entropy: float | None, max_repeats: float | None, budget_share: float | None) -> float:
    """The exponent for a table of ``source, tokens, share``; smallest that meets the limit, or where the entropy is met.

    ``budget_share`` is the budget as a multiple of the tokens there are; None
    is the least budget that uses every source whole.
    """
    low, high = 0.0, 1.0
    steps = 1 << HALVINGS
    for _ in range(PASSES):
        grid = sources.select("share", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("g"))
        alpha = F.lit(low) + F.col("g") * F.lit((high - low) / steps)
        grid = grid.withColumn("alpha", alpha).withColumn("power", F.pow("share", "alpha"))
        rows = (
            grid.groupBy("g", "alpha")
            .agg(
                F.sum("power").alias("z"),
                F.sum(F.col("power") * F.log("share")).alias("y"),
                F.max(F.pow("share", F.col("alpha") - 1)).alias("most"),
                F.max(F.pow("share", 1 - F.col("alpha"))).alias("least"),
            )
            .orderBy("g")
            .collect()  # 33 rows
        )
        met = []
        for r in rows:
            if target_entropy is not None:
                met.append(math.log(r["z"]) - r["alpha"] * r["y"] / r["z"] <= target_entropy)
            elif budget_share is None:
                met.append(r["most"] * r["least"] <= max_repeats)
            else:
                met.append(r["most"] / r["z"] * budget_share <= max_repeats)
        k = next((i for i, ok in enumerate(met) if ok), steps)
        low, high = rows[max(k - 1, 0)]["alpha"], rows[k]["alpha"]
        if k == 0:
            break
    return high


def plan(
    docs: DataFrame,
    evenness: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
    cover: bool = False,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """One row per source: ``source, tokens, weight, quota, epochs, cut``.

    ``evenness`` (0 to 1) sets the target entropy between the shares' own and
    the largest possible; else ``max_repeats`` limits the copies of a source.
    The budget is the corpus's tokens unless given; with ``cover`` it is the
    least at which every source is used whole.
    """
    sized = docs.select(
        _named(F.col(source)).alias("source"),
        word_count(F.col(text)).alias("n_tokens"),
        place_in_permutation(F.col(doc_id)).alias("place"),
    )
    sized = stored(sized, "mixing_sizes")
    totals = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    totals = stored(totals, "mixing_sources")
    total = totals.agg(F.sum("tokens")).first()[0]
    sources = totals.withColumn("share", F.col("tokens") / F.lit(total))
    stats = sources.agg(F.count("*").alias("n"), F.sum(-F.col("share") * F.log("share")).alias("h")).first()
    if not stats["n"]:
        return sources.select(
            "source", "tokens", F.lit(1.0).alias("weight"), F.col("tokens").alias("quota"), F.lit(1).cast("long").alias("epochs"), F.lit("").alias("cut")
        )
    target = None
    if evenness is not None:
        target = stats["h"] + evenness * (math.log(stats["n"]) - stats["h"])
    spend = float(total if budget is None else budget)
    alpha = find_exponent(sources, target, max_repeats, None if cover else spend / total)
    powered = sources.withColumn("power", F.pow("share", F.lit(alpha)))
    sums = powered.agg(F.sum("power").alias("z"), F.max(F.lit(total) * F.pow("share", F.lit(1 - alpha))).alias("spread")).first()
    weight = F.col("power") / F.lit(sums["z"])
    if cover:
        quota = F.greatest(F.floor(weight * F.lit(sums["spread"] * sums["z"])), F.col("tokens"))
    else:
        quota = F.floor(weight * F.lit(spend))
    quotas = powered.select("source", "tokens", weight.alias("weight"), quota.cast("long").alias("quota"))
    quotas = quotas.withColumn("epochs", F.floor(F.col("quota") / F.col("tokens")).cast("long"))
    quotas = stored(quotas.withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens")), "mixing_quotas")
    cuts = quotas.join(_cuts(sized, quotas), "source", "left")
    # Stored, so that its size is known where it meets the documents: below
    # Spark's own broadcast limit no text is dealt out by its source.
    return stored(cuts.select("source", "tokens", "weight", "quota", "epochs", F.coalesce("cut", F.lit("")).alias("cut")), "mixing_plan")


def _end_block(cells: DataFrame, block: Column) -> DataFrame:
    """Per source, the block in which ``rest`` runs out, and what is left of it there."""
    sums = cells.groupBy("source", "rest", block.alias("block")).agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("block")) - F.col("n")
    sums = sums.withColumn("before", before).where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("n") > F.col("rest")))
    return sums.select("source", "block", (F.col("rest") - F.col("before")).alias("rest"))


def _cuts(sized: DataFrame, quotas: DataFrame) -> DataFrame:
    """``source, cut``: the last place of the permutation that the rest of the quota pays for."""
    one = F.substring("place", 1, PREFIX)
    two = F.substring("place", 1, 2 * PREFIX)
    open_ = quotas.where("rest > 0").select("source", "rest")
    first = stored(_end_block(sized.join(open_, "source"), one), "mixing_blocks")
    inside = sized.join(first, "source").where(one == F.col("block")).drop("block")
    second = stored(_end_block(inside, two), "mixing_blocks")
    inside = sized.join(second, "source").where(two == F.col("block"))
    paid = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("place").rangeBetween(Window.unboundedPreceding, 0))
    last = inside.withColumn("paid", paid).where("paid <= rest").groupBy("source").agg(F.max("place").alias("last"))
    return second.join(last, "source", "left").select("source", F.coalesce("last", "block").alias("cut"))


def copies(docs: DataFrame, plan_: DataFrame, doc_id: str = "doc_id", source: str = "source", name: str = "n_copies") -> DataFrame:
    """``docs`` with a column ``name`` (replaced if there is one): how often each row is in the mix."""
    of, epochs, cut, named = own_names(docs, "__source", "__epochs", "__cut", "__named")
    quotas = plan_.select(F.col("source").alias(of), F.col("epochs").alias(epochs), F.col("cut").alias(cut))
    more = (place_in_permutation(F.col(doc_id)) <= F.col(cut)).cast("long")
    return (
        docs.withColumn(named, _named(F.col(source)))
        .join(quotas, F.col(named) == F.col(of), "left")
        .withColumn(name, F.coalesce(F.col(epochs) + more, F.lit(1).cast("long")))
        .drop(of, epochs, cut, named)
    )


def realise(docs: DataFrame, plan_: DataFrame, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix: every row of ``docs`` as often as its copies say, with the same columns."""
    n, copy = own_names(docs, "__copies", "__copy")
    counted = copies(docs, plan_, doc_id, source, n).where(F.col(n) > 0)
    return counted.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*docs.columns)
