"""Incremental harmonise as a Structured Streaming job.

The batch harmonise step tracks progress with a high-water mark on a data
column (FLT-1), which loses rows that arrive late with an equal or older
value (Q7). The streaming form tracks progress by *files*: the file source
records which landing files were processed in the query checkpoint, so
every file is loaded exactly once, whatever its watermark column says.

``Trigger.AvailableNow`` processes everything new and stops, so the job runs
on the same schedule as the batch job. Each micro-batch goes through the
same ``harmonise`` + keyed upsert + snapshot publish as the batch path. A
replayed micro-batch (after a failure between publish and checkpoint
commit) is harmless: with unique, non-NULL keys (the upsert checks both) an
upsert applied twice equals one application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.operators.harmonise import TableSpec, harmonise
from strata.session import checkpoint_dir
from strata.sinks.audit import RunLog, audited, new_run_id


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Per-stream checkpoint folder under the cluster's shared checkpoint dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def harmonise_stream(spark: SparkSession, landing_path: str, spec: TableSpec, sink,
                     source_id: str, schema: StructType | None = None, fmt: str = "parquet",
                     log: RunLog | None = None, checkpoint: str | None = None,
                     max_files_per_trigger: int | None = None,
                     wait: bool = True) -> StreamingQuery:
    """Load new landing files of one table into its harmonised snapshot."""
    from strata.plans.jobs import load  # local import: plans depend on operators

    if schema is None:  # file streams need a fixed schema; take it from the data
        schema = spark.read.format(fmt).load(landing_path).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_path)
    run_id = new_run_id()

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        def body() -> tuple[int, str]:
            exists = sink.exists(spec.target)
            df, effective = harmonise(batch, spec, source_id, "delta", None, target_exists=exists)
            rows, eff, _ = load(sink, df, spec.target, spec.keys, effective)
            sink.set_public_view(spec.target)
            return rows, eff

        if log is None:
            body()
        else:  # SNK-6: a failed micro-batch leaves a failed row, then fails the stream
            audited(log, f"{run_id}:{epoch_id}", sink.public_name(spec.target), "delta", body)

    query = (stream.writeStream.foreachBatch(load_batch)
             .option("checkpointLocation", checkpoint or stream_checkpoint(spark, spec.target))
             .trigger(availableNow=True)
             .queryName(f"harmonise_{spec.target}")
             .start())
    if wait:
        query.awaitTermination()
    return query


def harmonise_streams(spark: SparkSession, landing_root: str, specs, sink, source_id: str,
                      fmt: str = "parquet", log: RunLog | None = None,
                      checkpoint_root: str | None = None) -> dict[str, int]:
    """All tables of one source: one AvailableNow stream per landing folder
    ``{landing_root}/{spec.source}``, each with its own checkpoint. Returns
    the number of micro-batches each stream committed in this run."""
    done = {}
    for spec in specs:
        ckpt = (f"{checkpoint_root.rstrip('/')}/{spec.target}" if checkpoint_root
                else stream_checkpoint(spark, spec.target))
        q = harmonise_stream(spark, f"{landing_root.rstrip('/')}/{spec.source}", spec, sink,
                             source_id, fmt=fmt, log=log, checkpoint=ckpt)
        done[spec.target] = len([p for p in q.recentProgress if p.get("numInputRows", 0)])
    return done
