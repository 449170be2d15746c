"""Partitioned targets: an upsert rewrites only the partitions it touches.

A snapshot publish rewrites the whole table, which is right for small
tables and full loads but not for a large fact taking a small batch. An
upsert here

1. finds the partition values the batch touches, NULL among them; unless the
   sink is told that a key never moves (``stable_keys``, for a partition
   column derived from the key such as ``key_range``), also those that hold
   the batch's keys now, by a scan of the key columns;
2. merges the batch into those partitions with the usual MERGE semantics (up
   to ``max_pruned_partitions`` ids are a static partition filter, so only
   those partitions of the target are listed and read);
3. writes them back with dynamic partition overwrite: other partitions are
   not read, not written, not even listed. Partitions that lost their last
   row are dropped.

A full load, and a complete source with ``delete_missing``, writes a new data
table and repoints the base view, so it may change the schema and readers
never see a half-written table. ``keep_previous`` data tables are left for
readers that resolved the view before the repoint.

Failure: files of the rewritten partitions are written to a staging folder
and moved in at job commit. A job that dies before commit leaves the table
unchanged; one that dies during the commit can leave some touched partitions
updated and others not. Re-running the same batch converges to the right
result, because the upsert with unique non-NULL keys is idempotent.
"""

from __future__ import annotations

import re
import threading
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import sql_name
from strata.operators.upsert import upsert_counted
from strata.session import stage


_SESSION_MODE_LOCK = threading.Lock()


def key_range(column: str, width: int) -> Column:
    """Partition value = floor(key / width): monotonic keys (new orders,
    new movements) land in the newest partitions, so batches of recent
    activity touch few partitions."""
    return F.floor(F.col(column) / F.lit(width)).cast("long")


@dataclass
class PartitionedSink:
    spark: SparkSession
    database: str
    partition_col: str
    fmt: str = "parquet"
    max_pruned_partitions: int = 10_000
    stable_keys: bool = False
    keep_previous: int = 0
    _locks: dict = field(default_factory=lambda: defaultdict(threading.Lock), repr=False)
    _guard: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def __post_init__(self):
        sql_name(self.database)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")

    def lock(self, name: str) -> threading.Lock:
        """One writer per table from this driver (see SnapshotSink)."""
        with self._guard:
            return self._locks[name]

    def data_table(self, name: str) -> str:
        """The data table that the base view reads (the first one, if none)."""
        first = f"{self.database}.{sql_name(name)}__data"
        if not self.spark.catalog.tableExists(self.base_view(name)):
            return first
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.base_view(name)}").collect()
        text = next((r[1] for r in rows if r[0] == "View Text"), "") or ""
        m = re.search(rf"{re.escape(name)}__data(_\d+)?", text)
        return f"{self.database}.{m.group(0)}" if m else first

    def base_view(self, name: str) -> str:
        return f"{self.database}.{sql_name(name)}__base"

    def public_name(self, name: str) -> str:
        return f"{self.database}.{sql_name(name)}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.base_view(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.base_view(name))

    def _ordered(self, df: DataFrame, name: str) -> DataFrame:
        return df.select(*self.spark.table(self.data_table(name)).columns)

    def publish(self, df: DataFrame, name: str, keys=None) -> int:
        """Full load: write ``df``, with its own columns, as a new data table
        and point the base view at it. Tables before it are dropped then, but for
        the newest ``keep_previous``.
        ``keys`` is what every sink's publish takes; none is needed here."""
        with self.lock(name):
            return self._publish(df, name)

    def _publish(self, df: DataFrame, name: str) -> int:
        if self.partition_col not in df.columns:
            raise ValueError(f"{name}: partition column {self.partition_col!r} missing")
        old = self.data_table(name) if self.exists(name) else None
        version = 1
        if old:
            version = int((re.search(r"__data_(\d+)$", old) or [0, 1])[1]) + 1
        new = f"{self.database}.{sql_name(name)}__data" + (f"_{version}" if version > 1 else "")
        self.spark.sql(f"DROP TABLE IF EXISTS {new}")  # left by a job that died before its repoint
        df.write.format(self.fmt).partitionBy(self.partition_col).saveAsTable(new)
        self._point(name, new)
        if old:
            for _, table in self._data_tables(name, below=version)[self.keep_previous:]:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        return version

    def _data_tables(self, name: str, below: int) -> list[tuple[int, str]]:
        """(version, data table) of the versions under ``below``, newest first."""
        pattern = re.compile(rf"{re.escape(name)}__data(?:_(\d+))?")
        found = (pattern.fullmatch(t.name) for t in self.spark.catalog.listTables(self.database))
        return sorted(((int(m[1] or 1), f"{self.database}.{m[0]}") for m in found
                       if m and int(m[1] or 1) < below), reverse=True)

    def _point(self, name: str, table: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.base_view(name)} AS SELECT * FROM {table}")

    def upsert(self, source: DataFrame, name: str, keys, evolve: bool = False,
               delete_missing: bool = False, **upsert_kwargs) -> int:
        """Merge ``source`` into the partitions it touches; returns its row count."""
        with self.lock(name):
            return self._upsert(source, name, list(keys), evolve, delete_missing, **upsert_kwargs)

    def _upsert(self, source: DataFrame, name: str, keys: list[str], evolve: bool,
                delete_missing: bool, **upsert_kwargs) -> int:
        p = self.partition_col
        if p not in source.columns:
            raise ValueError(f"{name}: source lacks partition column {p!r}")
        table = self.data_table(name)
        target = self.spark.table(table)
        if delete_missing:  # the source is complete: no partition stays as it is
            merged, n = upsert_counted(target, source, keys, evolve=evolve, delete_missing=True,
                                       **upsert_kwargs)
            self._publish(merged, name)
            return int(n or 0)
        if evolve:
            extra = [f for f in source.schema.fields if f.name not in target.columns]
            if extra:
                added = ", ".join(f"{sql_name(f.name)} {f.dataType.simpleString()}" for f in extra)
                self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
                self._point(name, table)
                target = self.spark.table(table)
        touched = source.select(p).distinct()
        if not self.stable_keys:
            now = target.select(*dict.fromkeys([*keys, p])).alias("t").join(
                source.select(*keys).distinct().alias("s"),
                [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "left_semi")
            touched = touched.union(now.select(p)).distinct()
        if touched.count() <= self.max_pruned_partitions:
            # a bounded list of partition ids (not data rows): static
            # partition pruning, so only these partitions are even listed
            values = [r[0] for r in touched.collect()]
            known = [v for v in values if v is not None]
            chosen = F.col(p).isin(known) if known else F.lit(False)
            if len(known) < len(values):
                chosen = chosen | F.col(p).isNull()
            target = target.where(chosen)
        else:
            touched = touched.select(F.col(p).alias("__p"))
            target = target.join(touched, F.col(p).eqNullSafe(F.col("__p")), "left_semi")
        merged, n = upsert_counted(target, source, keys, **upsert_kwargs)
        left = None
        if not self.stable_keys:  # a key that moves may leave a partition empty
            merged = stage(merged, f"{self.database}/{name}__merged")
            left = [r[0] for r in target.select(p).distinct().join(
                merged.select(F.col(p).alias("__q")).distinct(), F.col(p).eqNullSafe(F.col("__q")),
                "left_anti").collect()]
        # Spark accepts overwriting partitions of a table the same job reads
        # only when the *session* is in dynamic mode (files are staged and
        # moved in at commit); set it for this write and restore it. The
        # session setting is shared by all threads, so the window is
        # serialized across tables (parallel jobs would otherwise restore it
        # under each other's writes).
        key = "spark.sql.sources.partitionOverwriteMode"
        with _SESSION_MODE_LOCK:
            previous = self.spark.conf.get(key, None)
            self.spark.conf.set(key, "dynamic")
            try:
                (self._ordered(merged, name).write.mode("overwrite")
                 .insertInto(table))
            finally:
                if previous is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, previous)
        for value in left or []:
            text = str(value).replace("\\", "\\\\").replace("'", "\\'")
            spec = "NULL" if value is None else f"'{text}'"  # cast to the column's type
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({sql_name(p)} = {spec})")
        return int(n or 0)

    def append(self, df: DataFrame, name: str) -> None:
        with self.lock(name):
            self._ordered(df, name).write.insertInto(self.data_table(name))

    def set_public_view(self, name: str, sql_body: str | None = None) -> str:
        body = sql_body or f"SELECT * FROM {self.base_view(name)}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.public_name(name)} AS {body}")
        return self.public_name(name)
