"""Run audit (SNK-5, SNK-6, AGG-1, AGG-2).

Audit rows are DataFrames with an explicit schema appended to the run log,
so error text with quotes, backslashes or ``--`` needs no escaping. Row
counts come from an ``Observation`` on the write itself: the plan runs once
(the reference counted and then wrote, evaluating the plan twice).
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.control import table_ddl_columns, table_schema
from strata.sources.local import config_frame

RUN_LOG = "pipeline_run_log"


def new_run_id() -> str:
    return uuid.uuid4().hex


def observe_rows(df: DataFrame, name: str = "rows",
                 newest: Column | None = None) -> tuple[DataFrame, Observation]:
    """AGG-1: attach a row counter that fills in when ``df`` is written, and
    the largest ``newest`` of the rows written (DCL-2)."""
    obs = Observation(name)
    more = [] if newest is None else [F.max(newest).cast("string").alias("newest")]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *more), obs


def observed_rows(obs: Observation) -> int:
    return int(obs.get["rows"])


def audit_frame(spark: SparkSession, run_id: str, target: str, load_type: str, rows: int,
                status: str, error: str | None = None) -> DataFrame:
    """One run-log row; ``logged_at`` is stamped by Spark at write time."""
    cols = table_schema(RUN_LOG).rsplit(",", 1)[0]  # all but logged_at
    df = config_frame(spark, [(run_id, target, load_type, int(rows), status, error)], cols)
    return df.withColumn("logged_at", F.current_timestamp())


def last_success(audit_rows: DataFrame, target: str):
    """When the last successful run of ``target`` was logged (or ``None``)."""
    return (audit_rows.where((F.col("target") == F.lit(target))
                             & (F.col("status") == F.lit("success")))
            .agg(F.max("logged_at").alias("t")).first()["t"])


def run_totals(audit_rows: DataFrame) -> DataFrame:
    """AGG-2: total rows per run over its per-table audit rows."""
    return (audit_rows.groupBy("run_id", "status")
            .agg(F.sum("rows").cast("bigint").alias("rows"), F.count(F.lit(1)).alias("tables")))


@dataclass
class RunLog:
    """The run-log table behind a snapshot sink."""

    sink: object  # SnapshotSink

    def ensure(self) -> None:
        with self.sink.lock(RUN_LOG + "__create"):
            if not self.sink.exists(RUN_LOG):
                empty = config_frame(self.sink.spark, [], table_schema(RUN_LOG))
                self.sink.publish(empty, RUN_LOG, ddl_columns=table_ddl_columns(RUN_LOG))

    compact_above: int = 256  # files; appends add one small file each

    def write(self, run_id: str, target: str, load_type: str, rows: int, status: str,
              error: str | None = None) -> None:
        self.ensure()
        self.sink.append(audit_frame(self.sink.spark, run_id, target, load_type, rows,
                                     status, error), RUN_LOG)
        if hasattr(self.sink, "compact") and self.sink.file_count(RUN_LOG) > self.compact_above:
            self.sink.compact(RUN_LOG, ddl_columns=table_ddl_columns(RUN_LOG))

    def read(self) -> DataFrame:
        return self.sink.read(RUN_LOG)


def audited(log: RunLog, run_id: str, target: str, load_type: str,
            body: Callable[[], tuple[int, str]]) -> int:
    """Run ``body`` (returns rows, effective load type) and log the outcome.

    Success -> one ``success`` row; any exception -> one ``failed`` row with
    the error text and 0 rows, then the exception is re-raised (SNK-6).
    """
    try:
        rows, effective = body()
    except Exception as e:
        logging.getLogger("strata.audit").error("%s failed (run %s): %s", target, run_id, e)
        log.write(run_id, target, load_type, 0, "failed", str(e))
        raise
    log.write(run_id, target, effective, rows, "success", None)
    return rows
