"""Complaint silver: renamed, typed, classified, de-duplicated complaints."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from ..constants import COMPLAINT_RENAMES, INGESTED_AT, SOURCE_FILE
from ..functions import classify, derive, parse
from ..operators.columns import keep_columns, rename_columns
from ..operators.dedup import latest_per_key

DERIVED = ["has_narrative", "year_month", "product_family"]


# Which copy of a complaint survives: the latest load, then the latest file.
SURVIVOR = (f"-{INGESTED_AT}", f"-{SOURCE_FILE}")


def typed_complaints(
    bronze: DataFrame,
    renames: Mapping[str, str] = COMPLAINT_RENAMES,
    precedence: Sequence[str] = SURVIVOR,
) -> tuple[DataFrame, list[str], list[str]]:
    """Typed and classified complaints, the precedence that applies, and the silver columns.

    Raises before any job when a required raw column is missing.  Columns of
    the precedence outside the silver schema are kept behind the silver columns.
    """
    df = rename_columns(bronze, renames, require=True)
    df = df.withColumns({
        "complaint_id": parse.to_long("complaint_id"),
        "date_received": parse.text_date("date_received"),
        "date_sent_to_company": parse.text_date("date_sent_to_company"),
        "timely_response": parse.yes_flag("timely_response"),
        "has_narrative": parse.has_text("narrative"),
        "product_family": classify.product_family("product"),
    })
    df = df.withColumn("year_month", derive.month_key("date_received"))
    keep = [*renames.values(), *DERIVED]
    if INGESTED_AT in df.columns:
        keep.append(INGESTED_AT)
    order = [spec for spec in precedence if spec.lstrip("-") in df.columns]
    ranked = keep_columns(df, [*keep, *(c for c in (s.lstrip("-") for s in order) if c not in keep)])
    return ranked, order, keep


def silver_complaints(
    bronze: DataFrame,
    renames: Mapping[str, str] = COMPLAINT_RENAMES,
    precedence: Sequence[str] = SURVIVOR,
    dedupe: Callable[..., DataFrame] = latest_per_key,
) -> DataFrame:
    """One row per complaint id (null ids removed).

    Survivor per id: first under ``precedence`` (bronze columns, ``-`` for
    descending; those that bronze lacks are skipped), then the remaining
    columns in name order.  Precedence columns outside the silver schema are
    dropped afterwards.
    """
    ranked, order, keep = typed_complaints(bronze, renames, precedence)
    return keep_columns(dedupe(ranked, ["complaint_id"], order), keep)
