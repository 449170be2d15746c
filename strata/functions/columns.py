"""Column expressions used by the curated and harmonise plans.

All helpers return plain ``Column`` expressions so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Division code -> line-of-business code, and the default for
# anything unmapped. They must equal the reference's mapping.
DIVISION_TO_LOB = {"01": "UP", "02": "DS", "03": "GF"}
UNKNOWN_LOB = "UNKNOWN"


def code_map(col: Column | str, mapping: Mapping[str, str],
             default: str | None) -> Column:
    """CAS-1: map codes through a small fixed dictionary with a default.

    Built as a CASE chain (constant-folded, pushed down by Catalyst when a
    filter on the result follows) rather than a join against a map table.
    """
    c = F.col(col) if isinstance(col, str) else col
    items = list(mapping.items())
    if not items:
        return F.lit(default)
    expr = F.when(c == F.lit(items[0][0]), F.lit(items[0][1]))
    for code, value in items[1:]:
        expr = expr.when(c == F.lit(code), F.lit(value))
    return expr.otherwise(F.lit(default))


def on_time_flag(actual: Column | str, due: Column | str) -> Column:
    """CAS-2: 1 when actual <= due, else 0. A NULL on either side gives 0."""
    a = F.col(actual) if isinstance(actual, str) else actual
    d = F.col(due) if isinstance(due, str) else due
    return F.when(a <= d, F.lit(1)).otherwise(F.lit(0))


def typed_null(data_type: str) -> Column:
    """PRJ-4 / FN-4: a NULL of a given type, keeps the schema stable."""
    return F.lit(None).cast(data_type)


def source_tag(source_id: str) -> Column:
    """PRJ-3: constant source id column."""
    return F.lit(source_id)


def provenance_columns(source_id: str, load_type: str,
                       loaded_at: Column | None = None) -> dict[str, Column]:
    """PRJ-5: the three provenance columns added by the harmonise step."""
    return {
        "_source_id": F.lit(source_id),
        "_loaded_at": loaded_at if loaded_at is not None else F.current_timestamp(),
        "_load_type": F.lit(load_type),
    }


def rename_projection(df: DataFrame, mapping: Mapping[str, str],
                      keep_rest: bool = False) -> DataFrame:
    """PRJ-1 / DCL-6: select ``source AS target`` for every mapping entry.

    With ``keep_rest`` the unmapped columns are carried through unchanged
    (the harmonise pass-through case); otherwise only mapped columns remain.
    """
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"rename map refers to missing columns: {missing}")
    cols = [F.col(src).alias(dst) for src, dst in mapping.items()]
    if keep_rest:
        cols += [F.col(c) for c in df.columns if c not in mapping]
    return df.select(*cols)


_IDENT = re.compile(r"[^A-Za-z0-9_]")
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*$")


def safe_identifier(text: str) -> str:
    """SNK-11: make a run id usable inside a view name."""
    return _IDENT.sub("_", text)


def sql_name(name: str) -> str:
    """Validate a (dotted) table/column/schema name before it is spliced into
    DDL text (views and SQL functions cannot take parameter markers).
    Config values that are not plain identifiers are rejected, so a registry
    or map-table row cannot inject SQL into a secured view."""
    if not isinstance(name, str) or not _NAME.match(name):
        raise ValueError(f"not a plain SQL name: {name!r}")
    return name
