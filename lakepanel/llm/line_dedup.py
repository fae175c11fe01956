"""Operator 1: line dedup by site-relative frequency (DataFrame functions only).

A line is boilerplate on a host if the share of the host's pages that contain
it exceeds ``max_ratio``; hosts with fewer than ``min_pages`` pages are left
alone.  All occurrences of such a line are dropped from the host's pages.

Plan: the distinct lines of each page, as 128-bit hashes, are counted per
(host, line) with map-side combining; host totals are a second aggregate.  A
host's boilerplate hashes become one array: since each of them is on more
than ``max_ratio`` of the pages, there are at most ``mean distinct lines per
page / max_ratio`` of them, so the array does not grow with the host.  Lines
and arrays are stored once, so that pages are parsed once and the size of the
arrays is known when they meet in one join: below Spark's own broadcast limit
no line is shuffled, beyond it a hot host's rows are split by adaptive skew
handling.

Defined results: a null page text or url keeps no lines and host ``''``; lines
are trimmed, and blank lines are dropped and never counted; a line repeated
inside a page counts once for it; every input row is a page, repeated rows
included; pages and lines of any length are handled whole; a share equal to the
ratio is not above it; empty tables give empty results; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Elements without visible text, block-level tags (they end a
# line), any other tag, and the entities that are decoded.
HIDDEN = r"(?is)<(script|style|head|noscript)\b[^>]*>.*?</(script|style|head|noscript)\s*>|<!--.*?-->|<!doctype[^>]*>"
BLOCK = r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)(\s[^>]*)?/?>"
TAG = r"<[^>]*>"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)"


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL; '' for null or a value without one."""
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 2)), F.lit(""))


def visible_lines(html: Column) -> Column:
    """The non-blank lines of a page's visible text; null gives no lines."""
    text = F.regexp_replace(html, HIDDEN, "\n")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_replace(x, "^[ \t\r\f]+|[ \t\r\f]+$", ""))
    return F.filter(lines, lambda x: x != "")


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(pages: DataFrame, max_ratio: float, min_pages: int) -> DataFrame:
    """``host, n_pages, boiler`` (line hashes) of hosts that have boilerplate; ``pages`` has host and lines."""
    totals = pages.groupBy("host").agg(F.count("*").alias("n_pages"))
    keys = pages.select("host", F.explode(F.array_distinct(F.transform("lines", _key))).alias("line"))
    counts = keys.groupBy("host", "line").agg(F.count("*").alias("n"))
    # A line on one page can only be boilerplate on hosts too small to look at.
    counts = counts.where(F.col("n") > F.lit(max_ratio) * (min_pages - 1))
    return (
        counts.join(totals.where(F.col("n_pages") >= min_pages), "host")
        .where(F.col("n") > F.lit(max_ratio) * F.col("n_pages"))
        .groupBy("host")
        .agg(F.array_sort(F.collect_list("line")).alias("boiler"))
    )


def drop_boilerplate(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    max_ratio: float = 0.3,
    min_pages: int = 5,
) -> DataFrame:
    """``page_id, host, n_lines, n_removed, kept_text`` per page; kept lines are joined by line feeds."""
    cut = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), visible_lines(F.col(html)).alias("lines"))
    cut = stored(cut, "page_lines")
    found = stored(boilerplate(cut, max_ratio, min_pages), "boilerplate")
    kept = F.when(F.col("boiler").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains("boiler", _key(x)))
    )
    return (
        cut.join(found, "host", "left")
        .withColumn("kept", kept)
        .select(
            "page_id",
            "host",
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
            F.array_join("kept", "\n").alias("kept_text"),
        )
    )
