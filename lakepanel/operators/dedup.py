"""Deterministic de-duplication: one surviving row per key.

``dropDuplicates`` keeps an arbitrary row.  Here the survivor is fixed by an
explicit ordering (e.g. latest ingest first) with every other column as the
final tie-break, so the result does not depend on partitioning or task order.

Plan shape: ``row_number() = 1`` over ``partition by key`` is planned by Spark
as a *partial* WindowGroupLimit before the shuffle and a final one after it,
so each map task forwards at most one row per key; a key holding a third of
all rows is reduced map-side instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir
from ..sources.versions import hadoop_path

OrderSpec = Sequence[Column | str]


def _order_columns(df: DataFrame, keys: Sequence[str], order_by: OrderSpec) -> list[Column]:
    named = set(keys)
    cols: list[Column] = []
    for spec in order_by:
        if isinstance(spec, str):
            desc = spec.startswith("-")
            name = spec[1:] if desc else spec
            named.add(name)
            c = F.col(f"`{name}`")
            cols.append(c.desc_nulls_last() if desc else c.asc_nulls_last())
        else:
            cols.append(spec)
    # Tie-break on every remaining column (in name order) for a total order.
    for name in sorted(c for c in df.columns if c not in named):
        cols.append(F.col(f"`{name}`").asc_nulls_last())
    return cols


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: OrderSpec = (),
    drop_null_keys: bool = True,
) -> DataFrame:
    """Keep the first row per ``keys`` under ``order_by`` (``"-col"`` = descending).

    Rows with a null key are removed first (they could never survive a
    non-null filter afterwards, and would otherwise all hash to one task).
    """
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(f"`{k}`").isNotNull()
            cond = c if cond is None else cond & c
        if cond is not None:
            df = df.filter(cond)
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*_order_columns(df, keys, order_by))
    rn = "__dedup_rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def latest_per_key_of_stored(
    df: DataFrame, keys: Sequence[str], order_by: OrderSpec = (), source: DataFrame | None = None, typed: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """``latest_per_key`` over wide stored rows: only rows of repeated keys are sorted.

    The keys that come more than once are found from the key columns alone and
    stored.  Rows of all other keys pass as they are, unshuffled: told apart by
    the keys, where these are few enough to broadcast, and by the rows' places in
    the stored files, where they are many.  Rows that are no single table's, or
    more than a broadcast of one bit a row can tell apart, take the plain way.
    ``df`` is read up to four times.  Where ``df`` is ``typed(source)``, row by row, the
    places are told apart in ``source``, so that each row is typed once.
    """
    cells = [F.col(f"`{k}`") for k in keys]
    rows = df.dropna(subset=list(keys))
    path = work_dir(df.sparkSession, "repeated_keys")
    rows.select(*cells).groupBy(*cells).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*cells).write.parquet(path)
    target, fs = hadoop_path(df.sparkSession, path)
    as_bytes = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    most = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if most.startswith("-") or fs.getContentSummary(target).getLength() > as_bytes(most):
        return _latest_by_place(rows, keys, order_by, path, source, typed) if not most.startswith("-") else latest_per_key(df, keys, order_by)
    repeated = df.sparkSession.read.schema(df.select(*cells).schema).parquet(path)
    columns = [F.col(f"`{c}`") for c in df.columns]
    single = rows.join(repeated, list(keys), "left_anti").select(*columns)
    several = rows.join(repeated, list(keys), "left_semi").select(*columns)
    return single.unionByName(latest_per_key(several, keys, order_by))


# A page of marks has one bit for each of this many rows of a file.
PAGE_ROWS_LOG2 = 15
# Marks up to this size are broadcast: one bit a row, so about a billion rows.
MOST_MARK_BYTES = 128 << 20


def _latest_by_place(
    rows: DataFrame, keys: Sequence[str], order_by: OrderSpec, repeated_path: str, source: DataFrame | None, typed: Callable[[DataFrame], DataFrame] | None
) -> DataFrame:
    """``latest_per_key`` where rows of repeated keys are marked by file and place.

    Keys and places are shuffled, and of the rows only the marked ones.  Files are
    known by a hash of their path: two with one hash share marks, and a row marked
    without need only takes the plain way.
    """
    spark = rows.sparkSession
    cells = [F.col(f"`{k}`") for k in keys]
    try:
        placed = _with_place(rows)
    except AnalysisException:  # rows of more than one table have no place
        return latest_per_key(rows, keys, order_by)
    repeated = spark.read.schema(rows.select(*cells).schema).parquet(repeated_path)
    path = work_dir(spark, "repeated_places")
    _write_marks(placed.select(*cells, "__file", "__row").join(repeated, list(keys), "left_semi"), path)
    if _too_many_marks(spark, path):
        return latest_per_key(rows, keys, order_by)
    told = [_at_places(rows if source is None else source, path, how) for how in ("left_anti", "left_semi")]
    single, several = told if source is None else [typed(part).dropna(subset=list(keys)) for part in told]
    return single.unionByName(latest_per_key(several, keys, order_by))


# Bits of one word of marks, and words of a page.
_WORD_LOG2 = 6
_MARKED = f"getbit(get(__marks, cast(shiftright(__row & {(1 << PAGE_ROWS_LOG2) - 1}, {_WORD_LOG2}) as int)), cast(__row & 63 as int)) = 1"


def _with_place(df: DataFrame) -> DataFrame:
    """``df`` with the file and the row of the stored table that each row lies at."""
    return df.select("*", F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))


def _write_marks(lost: DataFrame, path: str) -> None:
    """One bit for each ``__file``, ``__row`` of ``lost``, in pages of 2^15 rows."""
    word = F.expr(f"cast(shiftright(__row & {(1 << PAGE_ROWS_LOG2) - 1}, {_WORD_LOG2}) as int)").alias("__word")
    page = F.shiftright("__row", PAGE_ROWS_LOG2).alias("__page")
    words = lost.groupBy("__file", page, word).agg(F.expr("bit_or(shiftleft(1L, cast(__row & 63 as int)))").alias("__bits"))
    at = F.map_from_entries(F.collect_list(F.struct("__word", "__bits"))).alias("__at")
    dense = F.expr(f"transform(sequence(0, {(1 << PAGE_ROWS_LOG2 - _WORD_LOG2) - 1}), w -> coalesce(element_at(__at, w), 0L)) AS __marks")
    words.groupBy("__file", "__page").agg(at).select("__file", "__page", dense).write.parquet(path)


def lost_places(old: DataFrame, fresh: DataFrame, keys: Sequence[str], order_by: OrderSpec = ()) -> str | None:
    """Marks of the rows that ``latest_per_key`` over both tables drops; None where they have no places.

    Both are stored tables of the same columns, each with one row per key.  Keys,
    ``order_by`` columns and places decide; where these may tie, a digest of the whole row
    tells equal rows, of which the old one stays, from rows that differ, and only the
    latter are compared by all their columns.
    """
    spark = old.sparkSession
    if not all(isinstance(spec, str) for spec in order_by):
        return None
    names = [spec.removeprefix("-") for spec in order_by]
    try:
        old, fresh = _with_place(old), _with_place(fresh)
    except AnalysisException:  # rows of no stored table, or of several
        return None
    columns = [F.col(f"`{c}`") for c in old.columns if c not in ("__file", "__row")]
    cells = [*columns, *[c.isNull() for c in columns]]  # a hash passes over nulls

    def decided(digest: Column | None) -> DataFrame:
        """Per key of both tables the place of the row that goes, and whether the rows tie."""
        def narrow(df: DataFrame, tag: str) -> DataFrame:
            order = F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in names])
            cells = [F.col(f"`{k}`") for k in keys]
            told = [] if digest is None else [digest.alias(f"{tag}digest")]
            return df.select(*cells, order.alias(f"{tag}order"), *told,
                             F.col("__file").alias(f"{tag}file"), F.col("__row").alias(f"{tag}row"))

        both = narrow(old, "o_").join(narrow(fresh, "f_"), list(keys))
        tie = F.col("o_order").eqNullSafe(F.col("f_order"))
        if digest is not None:
            tie = tie & (F.col("o_digest") != F.col("f_digest"))

        def side(tag: str, other: str, is_fresh: bool):
            at = [F.lit(is_fresh).alias("__fresh"), F.col(f"{other}file").alias("__lost_file"), F.col(f"{other}row").alias("__lost_row")]
            return F.struct(F.col(f"{tag}order").alias("order"), *at, tie.alias("__tie"))

        rows = both.select(*[F.col(f"`{k}`") for k in keys], F.explode(F.array(side("o_", "f_", False), side("f_", "o_", True))).alias("side"))
        at = ["__fresh", "__lost_file", "__lost_row", "__tie"]
        extra = [F.col(f"side.order.`{c}`").alias(c) for c in names if c not in keys]
        rows = rows.select(*[F.col(f"`{k}`") for k in keys], *extra, *[F.col(f"side.{c}").alias(c) for c in at])
        kept = latest_per_key(rows, keys, order_by)  # of equal rows the old one
        path = work_dir(spark, "shared_keys")
        kept.select(*[F.col(f"`{k}`") for k in keys], "__lost_file", "__lost_row", "__tie").write.parquet(path)
        return spark.read.schema(kept.schema).parquet(path)

    may_tie = not names or _ranges_meet(old, fresh, names[0])
    found = decided(F.struct(F.xxhash64(*cells), F.hash(*cells)) if may_tie else None)
    ties = may_tie and found.where("__tie").limit(1).count()
    lost = found.where("NOT __tie").select(F.col("__lost_file").alias("__file"), F.col("__lost_row").alias("__row"))
    if ties:
        open_keys = found.where("__tie").select(*[F.col(f"`{k}`") for k in keys])
        rows = old.unionByName(fresh).join(open_keys, list(keys), "left_semi")
        order = _order_columns(rows.drop("__file", "__row"), keys, order_by)
        rank = F.row_number().over(Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order, "__file", "__row"))
        lost = lost.unionByName(rows.withColumn("__rank", rank).where("__rank > 1").select("__file", "__row"))
    path = work_dir(spark, "lost_places")
    _write_marks(lost, path)
    return None if _too_many_marks(spark, path) else path


def _ranges_meet(a: DataFrame, b: DataFrame, column: str) -> bool:
    """Whether a column of both tables may hold one value: their ranges overlap, or both hold nulls."""
    c = F.col(f"`{column}`")
    told = [df.agg(F.min(c).alias("low"), F.max(c).alias("high"), F.count_if(c.isNull()).alias("nulls")) for df in (a, b)]
    both = told[0].crossJoin(told[1].withColumnsRenamed({n: f"{n}_b" for n in ("low", "high", "nulls")}))
    meet = F.coalesce((F.col("low") <= F.col("high_b")) & (F.col("low_b") <= F.col("high")), F.lit(False))
    return both.select(meet | ((F.col("nulls") > 0) & (F.col("nulls_b") > 0))).first()[0]


def without_places(df: DataFrame, marks: str) -> DataFrame:
    """The rows of a stored table that ``marks`` (``lost_places``) do not name."""
    return _at_places(df, marks, "left_anti")


def _too_many_marks(spark: SparkSession, path: str) -> bool:
    target, fs = hadoop_path(spark, path)
    return fs.getContentSummary(target).getLength() > MOST_MARK_BYTES


def _at_places(df: DataFrame, marks: str, how: str) -> DataFrame:
    """The rows of a stored table whose places are marked (``left_semi``) or not (``left_anti``)."""
    pages = df.sparkSession.read.schema("__file bigint, __page bigint, __marks array<bigint>").parquet(marks)
    pages = F.broadcast(pages.withColumnsRenamed({"__file": "__in_file"}))
    here = F.expr(f"__file = __in_file AND shiftright(__row, {PAGE_ROWS_LOG2}) = __page AND {_MARKED}")
    return _with_place(df).join(pages, here, how).select(*[F.col(f"`{c}`") for c in df.columns])
