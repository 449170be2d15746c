"""Session helpers.

Library code never overrides what a cluster already configured: every
setting below is applied only when the session has no value for it yet.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on for a good physical plan at scale.
#  - AQE re-plans joins from real shuffle sizes (size-checked broadcast with
#    sort-merge fallback) and splits skewed partitions of inner/left joins.
#  - Session time zone UTC so NTZ literals and audit timestamps agree.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def _is_set(spark: SparkSession, key: str) -> bool:
    try:
        return spark.conf.get(key, None) is not None
    except Exception:  # pragma: no cover - conf lookups on odd keys
        return False


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime defaults where the session has none."""
    for key, value in _DEFAULTS.items():
        if not _is_set(spark, key):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    On a cluster this is ``spark.checkpoint.dir`` (shared storage). Only when
    it is unset (local tests) do we create a private temporary folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name "
                               "a shared folder (a machine-local one would lose data)")
        current = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
        spark.sparkContext.setCheckpointDir(current)
    return current


def local_session(app: str = "strata", cores: int | None = None,
                  shuffle_partitions: int = 8,
                  warehouse: str | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, no server ports).

    ``event_log_dir`` writes Spark's event log there (stage and task times
    without a UI)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEM", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True)
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_defaults(spark)


def stage(df, label: str):
    """Cut lineage: write ``df`` once as parquet under the shared checkpoint
    folder and read it back.

    Used where a plan would otherwise be recomputed by several branches
    (the upsert source feeds its key check, the update join and the insert
    anti join). Columnar staging lets each branch read only its columns.
    The folder is per application and label and overwritten by that
    application's next run, so staging data does not pile up there.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staging/{spark.sparkContext.applicationId}/{label}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
