"""Data-contract checks (CHK-1..4).

Checks return DataFrames of findings ``(severity, schema, table, detail)``;
``raise_on_errors`` turns error rows into an exception. The filter-column
check looks at the *columns a table really produces* (not source text, Q21).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.local import config_frame
from strata.sources.registry import logical_schema_col, valid_bindings

class ContractError(RuntimeError):
    pass


def output_columns(spark: SparkSession, outputs: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows ``(schema, table, column)`` from the schemas of produced tables."""
    rows = [(s, t, c) for (s, t), df in outputs.items() for c in df.columns]
    return config_frame(spark, rows, "schema string, table string, column string")


def contract_findings(tables: DataFrame, columns: DataFrame, bindings: DataFrame) -> DataFrame:
    """CHK-1 + CHK-2.

    ``tables``: ``(schema, table)`` under check; ``columns``: ``(schema,
    table, column)`` they produce. Error when a bound table lacks its filter
    column; warning when a table has no binding.
    """
    b = valid_bindings(bindings).select(F.col("schema").alias("__key"),
                                        F.col("table").alias("__t"), "filter_column")
    keyed = tables.withColumn("__k", logical_schema_col(F.col("schema")))
    on = (F.col("__k") == F.col("__key")) & (F.col("table") == F.col("__t"))
    bound = keyed.join(b, on, "inner").select("schema", "table", "filter_column")
    present = columns.select("schema", "table", F.col("column").alias("filter_column"))
    dropped = (bound.join(present, ["schema", "table", "filter_column"], "left_anti")
               .select(F.lit("error").alias("severity"), "schema", "table",
                       F.concat(F.lit("filter column '"), F.col("filter_column"),
                                F.lit("' not produced")).alias("detail")))
    unregistered = (keyed.join(b, on, "left_anti")
                    .select(F.lit("warning").alias("severity"), "schema", "table",
                            F.lit("no row filter binding; confirm none is needed").alias("detail")))
    return dropped.unionByName(unregistered)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """CHK-3: NULL count of each required column, in one aggregate pass.

    Result rows ``(column_name, null_count)``.
    """
    if not columns:
        raise ValueError("no columns to check")
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_count)")


def null_findings(df: DataFrame, schema: str, table: str, columns: Sequence[str]) -> DataFrame:
    """CHK-3 as findings: one error row per required column holding NULLs."""
    return (null_counts(df, columns).where(F.col("null_count") > 0)
            .select(F.lit("error").alias("severity"), F.lit(schema).alias("schema"),
                    F.lit(table).alias("table"),
                    F.concat(F.col("column_name"), F.lit(" has "),
                             F.col("null_count").cast("string"), F.lit(" NULLs"))
                    .alias("detail")))


def require_params(**params) -> None:
    """CHK-3 (parameters): every named argument must be non-empty."""
    missing = [k for k, v in params.items() if not v]
    if missing:
        raise ValueError(f"required parameters missing: {missing}")


def raise_on_errors(findings: DataFrame) -> DataFrame:
    """CHK-4: raise with every error finding when there is one; return the
    findings. There is at most one finding per table and required column."""
    errors = findings.where(F.col("severity") == F.lit("error")).collect()
    if errors:
        lines = [f"{r['schema']}.{r['table']}: {r['detail']}" for r in errors]
        raise ContractError(f"contract check failed, {len(lines)} errors:\n  " + "\n  ".join(lines))
    return findings
