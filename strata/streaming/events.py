"""Append-only event tables from files that come late, out of order and twice.

``harmonise_stream`` merges by key, so every micro-batch reads its target. Of
events a row never changes, and a repeat comes within a stated lateness; so
the keys of that span are kept as event-time state
(``dropDuplicatesWithinWatermark``, on the shared checkpoint folder) and what
is new is appended without a look at the table. The state is as large as the
keys of one lateness span, however large the table grows.

Nothing is lost to the watermark. Spark drops rows that are older than it and
says how many; where it dropped some, the rows of the landing folder that are
not newer than the watermark and whose keys the table lacks are appended
after the stream. So is every row without an event time, which has no place
in the state. A marker in the checkpoint folder stands while a run works: the
run after a lost one cannot tell which of its rows were appended or dropped,
so it compares keys for all of its batches and looks for lost rows at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.harmonise import TableSpec, harmonise
from strata.session import stage
from strata.sinks.audit import RunLog, audited, new_run_id
from strata.streaming.incremental import stream_checkpoint

TIME = "__event_time"
RUNNING = "_events_running"


@dataclass(frozen=True)
class EventLoad:
    """What one run did: rows appended from the stream, rows appended after it
    (too late for the state, or without an event time), and whether it had to
    compare keys with the table throughout."""

    appended: int
    recovered: int
    compared: bool


class _Marker:
    """An empty file on the checkpoint's own file system."""

    def __init__(self, spark: SparkSession, folder: str):
        path = spark._jvm.org.apache.hadoop.fs.Path
        self.commits, self.path = path(f"{folder}/commits"), path(f"{folder}/{RUNNING}")
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def stands(self) -> bool:
        return self.fs.exists(self.path)

    def committed_before(self) -> bool:
        return self.fs.exists(self.commits)

    def set(self) -> None:
        self.fs.create(self.path, True).close()

    def clear(self) -> None:
        self.fs.delete(self.path, False)


def load_events(spark: SparkSession, landing_path: str, spec: TableSpec, event_time: str,
                lateness: str, sink, source_id: str, schema: StructType | None = None,
                fmt: str = "parquet", log: RunLog | None = None, checkpoint: str | None = None,
                max_files_per_trigger: int | None = None) -> EventLoad:
    """Append the events of new landing files to ``spec.target``, each key once.

    ``event_time`` (timestamp, with or without zone, or date) and
    ``spec.keys`` are columns of the landing files. Rows of one key are copies
    of one event; of different ones the first stays. A copy may come in any
    file at any time: within ``lateness`` of the newest event the state knows
    it, after it Spark drops it and the table does. A NULL in a key column
    fails the run before the batch is stored. No new file: no batch, no
    change. ``sink`` needs ``append``."""
    folder = (checkpoint or stream_checkpoint(spark, spec.target)).rstrip("/")
    marker = _Marker(spark, folder)
    unsure = marker.stands() or (sink.exists(spec.target) and not marker.committed_before())
    keys = list(spec.keys)
    stored_keys = [spec.rename.get(k, k) for k in keys]
    if schema is None:
        schema = spark.read.format(fmt).load(landing_path).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    landed = reader.load(landing_path).withColumn(TIME, F.col(event_time).cast("timestamp"))
    stream = (landed.observe("input", F.count_if(F.col(TIME).isNull()).alias("untimed"))
              .where(F.col(TIME).isNotNull()).withWatermark(TIME, lateness)
              .dropDuplicatesWithinWatermark(keys))
    run_id, appended = new_run_id(), [0, 0]

    def refresh() -> None:
        """Batches are stored by the stream's own session: list their files here too."""
        if sink.exists(spec.target):
            spark.catalog.refreshTable(sink.base_view(spec.target))

    def unknown(rows: DataFrame) -> DataFrame:
        """Rows whose keys the table lacks; it is read for its keys alone."""
        if not sink.exists(spec.target):
            return rows
        refresh()
        return rows.join(sink.read(spec.target).select(*stored_keys), stored_keys, "left_anti")

    def store(rows: DataFrame, compare: bool, part: str, which: int) -> None:
        exists = sink.exists(spec.target)
        df, load_type = harmonise(rows.drop(TIME), spec, source_id, "delta", None, target_exists=exists)
        df = stage(unknown(df) if compare else df, f"events/{sink.database}/{spec.target}")

        def body() -> tuple[int, str]:
            n, nulls = df.agg(F.count(F.lit(1)), F.count_if(
                F.greatest(*[F.col(k).isNull() for k in stored_keys], F.lit(False)))).first()
            if nulls:
                raise ValueError(f"{spec.target}: {nulls} rows with a NULL key")
            if n and not exists:
                sink.publish(df, spec.target, keys=stored_keys)
            elif n:
                sink.append(df, spec.target)
            appended[which] += n
            return n, load_type

        if log is None:
            body()
        else:
            audited(log, f"{run_id}:{part}", sink.public_name(spec.target), "delta", body)

    marker.set()
    query = (stream.writeStream.foreachBatch(lambda batch, epoch: store(batch, unsure, str(epoch), 0))
             .option("checkpointLocation", folder).trigger(availableNow=True)
             .queryName(f"events_{spec.target}").start())
    query.awaitTermination()

    refresh()
    progress = query.recentProgress
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if unsure or len(progress) >= kept or _set_aside(progress):
        late = spark.read.format(fmt).schema(schema).load(landing_path).withColumn(
            TIME, F.col(event_time).cast("timestamp"))
        marks = [p.eventTime["watermark"] for p in progress if "watermark" in p.eventTime]
        if marks:  # rows above it were never dropped
            late = late.where(F.col(TIME).isNull() | (F.col(TIME) <= F.lit(max(marks)).cast("timestamp")))
        store(late.dropDuplicates(keys), True, "late", 1)
    if sink.exists(spec.target):
        sink.set_public_view(spec.target)
    marker.clear()
    return EventLoad(appended[0], appended[1], unsure)


def _set_aside(progress) -> bool:
    """Did a batch hold rows that the state did not take?"""
    return any(op.numRowsDroppedByWatermark for p in progress for op in p.stateOperators) or any(
        p.observedMetrics["input"].untimed for p in progress if "input" in p.observedMetrics)
