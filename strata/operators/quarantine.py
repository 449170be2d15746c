"""Rows that break a table's rules, set apart instead of failing the load.

``tag_rejects`` adds to each row the list of what it breaks: required columns
that are NULL, and named rules (boolean columns) that are not true, NULL
included. It is one projection, so tagging, counting (``reject_counts``, for an
``Observation`` on the write) and writing are one pass over the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "_reject_reasons"
REJECT_SCHEMA = ("target string, run_id string, reasons array<string>, record string, "
                 "rejected_at timestamp")


def tag_rejects(df: DataFrame, required: Sequence[str],
                rules: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` with ``_reject_reasons``: empty for a good row. A reason is the
    rule's name, or ``<column> is null``."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns not found: {missing}")
    if REASONS in df.columns:
        raise ValueError(f"the source has a column {REASONS}")
    broken = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]
    broken += [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
               for name, rule in (rules or {}).items()]
    reasons = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn(REASONS, reasons)


def reject_counts() -> list[Column]:
    """Aggregates over tagged rows: ``rows``, and ``rejected`` among them."""
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(REASONS) > 0).alias("rejected")]


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size(REASONS) == 0).drop(REASONS)


def rejected(tagged: DataFrame, target: str, run_id: str) -> DataFrame:
    """Rows of the quarantine table: the record as JSON (NULL fields kept), so
    that one table holds the rejects of every target and outlives schema changes."""
    columns = [c for c in tagged.columns if c != REASONS]
    return tagged.where(F.size(REASONS) > 0).select(
        F.lit(target).alias("target"), F.lit(run_id).alias("run_id"),
        F.col(REASONS).alias("reasons"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("record"),
        F.current_timestamp().alias("rejected_at"))
