"""Keyed upsert through the table format's own MERGE (``DataFrame.mergeInto``).

When the target is a row-level-capable table (a transactional table format
installed on the cluster), the engine's MERGE rewrites only the files that
hold matched rows and commits atomically; that is preferable to a snapshot
rewrite. Plain parquet tables refuse it with ``UNSUPPORTED_FEATURE``; use
``SnapshotSink`` or ``PartitionedSink`` there. The same key checks as
``operators.upsert`` run first, so NULL keys and multiply-matched target rows
fail the same way on every sink.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import sql_name
from strata.operators.upsert import align_source, check_source_keys


@dataclass
class MergeIntoSink:
    spark: SparkSession
    database: str
    fmt: str | None = None  # the row-level format's name; None = session default

    def table(self, name: str) -> str:
        return f"{sql_name(self.database)}.{sql_name(name)}__data"

    def base_view(self, name: str) -> str:
        return self.table(name)

    def public_name(self, name: str) -> str:
        return f"{sql_name(self.database)}.{sql_name(name)}"

    def publish(self, df: DataFrame, name: str, keys=None) -> int:
        """Full load: replace the table's contents and schema in one commit."""
        w = df.write.mode("overwrite").option("overwriteSchema", "true")
        if self.fmt:
            w = w.format(self.fmt)
        w.saveAsTable(self.table(name))
        return 1

    def set_public_view(self, name: str, sql_body: str | None = None) -> str:
        body = sql_body or f"SELECT * FROM {self.table(name)}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.public_name(name)} AS {body}")
        return self.public_name(name)

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.table(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.table(name))

    def upsert(self, source: DataFrame, name: str, keys: Sequence[str],
               null_keys: str = "raise", evolve: bool = False,
               delete_missing: bool = False) -> int:
        """MERGE by the format itself, which may refuse ``evolve`` or
        ``delete_missing``; other options of the upsert operator are errors."""
        target = self.read(name)
        src, _ = align_source(target, source, evolve)
        n = check_source_keys(target, src, list(keys), null_keys)
        table = self.table(name)
        cond = None
        for k in keys:  # target columns are qualified by the table name
            c = F.col(f"{table}.{k}") == F.col(f"__s.{k}")
            cond = c if cond is None else cond & c
        merge = (src.alias("__s").mergeInto(table, cond)
                 .whenMatched().updateAll().whenNotMatched().insertAll())
        if delete_missing:
            merge = merge.whenNotMatchedBySource().delete()
        if evolve:
            merge = merge.withSchemaEvolution()
        merge.merge()
        return n
