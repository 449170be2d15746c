"""Control tables on storage: declared creation, seeds, soft delete, and the
migration ledger (SNK-7..10, SRC-5, JN-8, DCL-1/2).

Migrations are lists of Python actions over DataFrames (no SQL text
splitting, Q2); the ledger records one row per attempt and a failed
migration is retried by the next run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import checks
from strata.operators.control import (CONTROL_TABLES, LOB_REFINERY, LOB_SEED, apply_defaults,
                                      pending_migrations, required_columns, seed_rows_frame,
                                      soft_delete, table_ddl_columns, table_schema)
from strata.sinks.publish import SnapshotSink
from strata.sources.local import config_frame

LEDGER = "migration_history"


def ensure_table(sink: SnapshotSink, table: str) -> bool:
    """SNK-8: create a declared control table if it does not exist yet."""
    if sink.exists(table):
        return False
    empty = config_frame(sink.spark, [], table_schema(table))
    sink.publish(empty, table, ddl_columns=table_ddl_columns(table))
    sink.set_public_view(table)
    return True


def assert_required(df: DataFrame, table: str) -> None:
    """NOT NULL is declared but not enforced by parquet tables: check it."""
    cols = required_columns(table)
    if cols:
        checks.raise_on_errors(checks.null_findings(df, "control", table, cols))


def insert_rows(sink: SnapshotSink, table: str, rows: list[tuple],
                columns: list[str] | None = None) -> int:
    """SNK-9: append seed rows; omitted columns take their defaults."""
    df = seed_rows_frame(sink.spark, table, rows, columns)
    return insert_frame(sink, table, df)


def insert_frame(sink: SnapshotSink, table: str, df: DataFrame) -> int:
    df = apply_defaults(df, table)
    assert_required(df, table)
    ensure_table(sink, table)
    sink.append(df, table)
    return df.count()


def soft_delete_rows(sink: SnapshotSink, table: str, predicate: Column, by: str) -> int:
    """SNK-10 on storage: rewrite as a new snapshot with rows deactivated.
    Returns the number of active rows that it deactivated."""
    with sink.lock(f"{table}__state"):
        current = sink.read(table)
        n = current.where(predicate & F.col("is_active")).count()
        sink.publish(soft_delete(current, predicate, by), table,
                     ddl_columns=table_ddl_columns(table))
    return n


# ── migrations ──────────────────────────────────────────────────────────────

@dataclass(frozen=True)
class Migration:
    sequence: int
    migration_id: str
    actions: Sequence[Callable[[SnapshotSink], object]] = field(default_factory=tuple)
    folder: str = "platform"

    @property
    def filename(self) -> str:
        return f"{self.folder}/{self.migration_id}"


MIGRATION_FOLDERS = ("platform", "euh", "curated")  # fixed values: the three folders


def migration_specs(spark: SparkSession, migrations: Sequence[Migration]) -> DataFrame:
    """SET-1: one spec frame per migration folder, concatenated by name.

    Rollback scripts stay in the specs and are removed by
    ``pending_migrations`` (never auto-applied)."""
    schema = "sequence int, migration_id string, filename string, folder string"
    folders = list(MIGRATION_FOLDERS) + sorted({m.folder for m in migrations}
                                               - set(MIGRATION_FOLDERS))
    out = None
    for folder in folders:
        rows = [(m.sequence, m.migration_id, m.filename, m.folder)
                for m in migrations if m.folder == folder]
        part = config_frame(spark, rows, schema)
        out = part if out is None else out.unionByName(part)
    return out


def ledger_row(spark: SparkSession, m: Migration, env: str, status: str,
               error: str | None) -> DataFrame:
    df = config_frame(spark, [(m.migration_id, m.filename, env, status, error)],
                      "migration_id string, filename string, environment string, "
                      "status string, error_message string")
    return apply_defaults(df.withColumn("applied_at", F.current_timestamp()), LEDGER)


def apply_migrations(sink: SnapshotSink, migrations: Sequence[Migration], env: str) -> list[str]:
    """Apply pending migrations in (sequence, id) order; ledger every attempt.

    The pending set is computed by an anti join of the specs with the
    ledger; the loop runs over migrations (a handful of specs), not data.
    A failure appends a ``failed`` row and re-raises.
    """
    ensure_table(sink, LEDGER)
    by_id = {m.migration_id: m for m in migrations}
    pending = pending_migrations(migration_specs(sink.spark, migrations), sink.read(LEDGER), env)
    applied = []
    for row in pending.select("migration_id").collect():
        m = by_id[row["migration_id"]]
        try:
            for action in m.actions:
                action(sink)
        except Exception as e:
            sink.append(ledger_row(sink.spark, m, env, "failed", str(e)), LEDGER)
            raise
        sink.append(ledger_row(sink.spark, m, env, "success", None), LEDGER)
        applied.append(m.migration_id)
    return applied


_SEED_COLS = ["lob_code", "lob_name", "entra_group_id", "scope", "is_active", "updated_by"]


def platform_migrations() -> list[Migration]:
    """The reference's platform migrations as actions.

    Fixed values: the migration ids are the ones a ledger already holds for
    these changes, so a ledger carried over does not re-apply them. The
    rollback is listed but never applied automatically (``pending``
    excludes ``*_rollback.sql``)."""
    return [
        Migration(1, "0001_create_orchestration_config.sql",
                  (lambda s: ensure_table(s, "orchestration_config"),)),
        Migration(2, "0002_create_lob_group_map.sql",
                  (lambda s: ensure_table(s, "lob_group_map"),)),
        Migration(3, "0003_seed_lob_group_map.sql",
                  (lambda s: insert_rows(s, "lob_group_map", list(LOB_SEED), _SEED_COLS),)),
        Migration(4, "0004_create_legal_entity_asset_group_maps.sql",
                  (lambda s: ensure_table(s, "legal_entity_group_map"),
                   lambda s: ensure_table(s, "asset_group_map"))),
        Migration(5, "0005_add_lob_rf_refinery.sql",
                  (lambda s: insert_rows(s, "lob_group_map", [LOB_REFINERY], _SEED_COLS),)),
        Migration(5, "0005_add_lob_rf_refinery_rollback.sql",
                  (lambda s: soft_delete_rows(s, "lob_group_map",
                                              F.col("lob_code") == F.lit("RF"),
                                              "rollback-0005"),)),
    ]


# ── orchestration config state (DCL-2) ──────────────────────────────────────

def record_watermarks(sink: SnapshotSink, marks: Mapping[str, str]) -> None:
    """Store tables' new high-water marks and mark their first loads complete,
    all in one snapshot, under the table's lock from read to repoint.

    A table without an orchestration row gets one (active, delta, run order 0).
    """
    if not marks:
        return
    ensure_table(sink, "orchestration_config")
    with sink.lock("orchestration_config__state"):
        current = sink.read("orchestration_config")
        known = {r[0] for r in current.where(F.col("table_id").isin(list(marks)))
                 .select("table_id").collect()}
        fresh = []
        for table_id in sorted(set(marks) - known):
            catalog_schema, _, table = table_id.rpartition(".")
            catalog, _, schema = catalog_schema.rpartition(".")
            fresh.append((table_id, catalog or "", schema, table, "delta", True, 0))
        if fresh:
            rows = seed_rows_frame(sink.spark, "orchestration_config", fresh,
                                   ["table_id", "catalog_name", "schema_name", "table_name",
                                    "load_type", "is_active", "run_order"])
            rows = apply_defaults(rows, "orchestration_config")
            current = current.unionByName(rows.select(*current.columns))
        new = config_frame(sink.spark, list(marks.items()), "__id string, __mark string")
        hit = F.col("__id").isNotNull()
        updated = (current.join(F.broadcast(new), F.col("table_id") == F.col("__id"), "left")
                   .withColumns({
                       "watermark_value": F.when(hit, F.col("__mark")).otherwise(F.col("watermark_value")),
                       "first_load_complete": hit | F.col("first_load_complete"),
                       "updated_at": F.when(hit, F.current_timestamp()).otherwise(F.col("updated_at")),
                   }).drop("__id", "__mark"))
        sink.publish(updated, "orchestration_config",
                     ddl_columns=table_ddl_columns("orchestration_config"))


def record_watermark(sink: SnapshotSink, table_id: str, new_value: str | None) -> None:
    """:func:`record_watermarks` for one table."""
    record_watermarks(sink, {table_id: new_value})


__all__ = ["CONTROL_TABLES", "Migration", "apply_migrations", "ensure_table", "insert_rows",
           "insert_frame", "soft_delete_rows", "platform_migrations", "record_watermark",
           "record_watermarks"]
