"""Catalog scans: SRC-1 (table by name), SRC-2 (optional), SRC-3 (exists)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def full_name(*parts: str) -> str:
    """Join non-empty name parts: catalog.schema.table (catalog optional)."""
    return ".".join(p for p in parts if p)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-1: scan a catalog table or view by (multi-part) name."""
    return spark.table(name)


def optional_table(spark: SparkSession, schema: str | None,
                   table: str, catalog: str | None = None) -> DataFrame | None:
    """SRC-2: read only when a schema is given, else ``None``."""
    if not schema:
        return None
    return spark.table(full_name(catalog or "", schema, table))


def table_exists(spark: SparkSession, name: str) -> bool:
    """SRC-3: catalog probe (true for tables and views)."""
    return spark.catalog.tableExists(name)


def read_parquet_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Lake-path source (``lake_repoint`` sources read parquet in place)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{table}.parquet")
