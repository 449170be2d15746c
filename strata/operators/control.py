"""Control tables as DataFrames: declared shapes, defaults, seeds, soft
delete, migration ledger and the orchestration due-list.

Everything here works on small config tables, but is still written as
DataFrame operations (joins, anti joins, explode) so it runs where the
tables live and never loops over rows in Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.local import config_frame


@dataclass(frozen=True)
class ColumnDef:
    name: str
    type: str
    nullable: bool = True
    default: str | None = None  # SQL expression


def _c(name, type_, nullable=True, default=None):
    return ColumnDef(name, type_, nullable, default)


_NOW = "current_timestamp()"

# The declared control-table shapes (names, types, NOT NULL,
# defaults) of the reference's migrations; pipeline_run_log has no DDL there
# and is declared here by position.
CONTROL_TABLES: dict[str, list[ColumnDef]] = {
    "orchestration_config": [
        _c("table_id", "string", False), _c("catalog_name", "string", False),
        _c("schema_name", "string", False), _c("table_name", "string", False),
        _c("load_type", "string", False), _c("is_active", "boolean", False),
        _c("dependency_tables", "array<string>"), _c("watermark_column", "string"),
        _c("watermark_value", "string"), _c("run_order", "int", False),
        _c("first_load_complete", "boolean", False, "false"),
        _c("feature_flag", "string"), _c("notes", "string"),
        _c("created_at", "timestamp", True, _NOW), _c("updated_at", "timestamp", True, _NOW),
    ],
    "lob_group_map": [
        _c("lob_code", "string", False), _c("lob_name", "string", False),
        _c("entra_group_id", "string", False), _c("scope", "string", False),
        _c("is_active", "boolean", False, "true"),
        _c("created_at", "timestamp", True, _NOW), _c("updated_at", "timestamp", True, _NOW),
        _c("updated_by", "string"),
    ],
    "legal_entity_group_map": [
        _c("company_code", "string", False), _c("entity_name", "string", False),
        _c("entra_group_id", "string", False), _c("scope", "string", False),
        _c("is_active", "boolean", False, "true"),
        _c("created_at", "timestamp", True, _NOW), _c("updated_at", "timestamp", True, _NOW),
        _c("updated_by", "string"),
    ],
    "asset_group_map": [
        _c("asset_id", "string", False), _c("asset_name", "string", False),
        _c("entra_group_id", "string", False), _c("scope", "string", False),
        _c("is_active", "boolean", False, "true"),
        _c("created_at", "timestamp", True, _NOW), _c("updated_at", "timestamp", True, _NOW),
        _c("updated_by", "string"),
    ],
    "migration_history": [
        _c("migration_id", "string", False), _c("filename", "string", False),
        _c("applied_at", "timestamp", False), _c("environment", "string", False),
        _c("status", "string", False), _c("error_message", "string"),
    ],
    "pipeline_run_log": [
        _c("run_id", "string", False), _c("target", "string", False),
        _c("load_type", "string", False), _c("rows", "bigint", False),
        _c("status", "string", False), _c("error", "string"),
        _c("logged_at", "timestamp", False, _NOW),
    ],
}

# LOB seed rows of migration 0003 and the RF row of 0005
# (lob_code, lob_name, entra_group_id, scope, is_active, updated_by). The
# reference leaves group ids as placeholders to be replaced per tenant; ours
# are plain names.
LOB_SEED = [
    ("UP", "Upstream", "grp-lob-up", "LOB", True, "migration-0003"),
    ("DS", "Downstream", "grp-lob-ds", "LOB", True, "migration-0003"),
    ("GF", "Functions", "grp-lob-gf", "LOB", True, "migration-0003"),
    ("GLOBAL", "All LOBs", "grp-lob-global", "GLOBAL", True, "migration-0003"),
]
LOB_REFINERY = ("RF", "Refinery", "grp-lob-rf", "LOB", True, "migration-0005")


def table_ddl_columns(table: str) -> str:
    """Column list for ``CREATE TABLE`` including NOT NULL and DEFAULT."""
    parts = []
    for c in CONTROL_TABLES[table]:
        s = f"{c.name} {c.type.upper()}"
        if not c.nullable:
            s += " NOT NULL"
        if c.default is not None:
            s += f" DEFAULT {c.default}"
        parts.append(s)
    return ",\n    ".join(parts)


def table_schema(table: str) -> str:
    return ", ".join(f"{c.name} {c.type}" for c in CONTROL_TABLES[table])


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """SNK-9: columns omitted from a seed take their declared default (or NULL).

    The result has exactly the declared columns, in declared order, cast to
    the declared types. Unknown columns are an error, as in ``INSERT``.
    """
    defs = CONTROL_TABLES[table]
    names = {c.name for c in defs}
    extra = [c for c in df.columns if c not in names]
    if extra:
        raise ValueError(f"{table}: unknown columns {extra}")
    cols = []
    for c in defs:
        if c.name in df.columns:
            cols.append(F.col(c.name).cast(c.type).alias(c.name))
        elif c.default is not None:
            cols.append(F.expr(c.default).cast(c.type).alias(c.name))
        else:
            cols.append(F.lit(None).cast(c.type).alias(c.name))
    return df.select(*cols)


def seed_rows_frame(spark: SparkSession, table: str, rows: list[tuple],
                    columns: list[str] | None = None) -> DataFrame:
    """Build seed rows over a leading column subset and apply defaults."""
    defs = {c.name: c for c in CONTROL_TABLES[table]}
    if columns is None:
        width = len(rows[0]) if rows else 4
        if width == 6:  # (code, name, group, scope, is_active, updated_by)
            first4 = [c.name for c in CONTROL_TABLES[table]][:4]
            columns = first4 + ["is_active", "updated_by"]
        else:
            columns = [c.name for c in CONTROL_TABLES[table]][:width]
    schema = ", ".join(f"{n} {defs[n].type}" for n in columns)
    return apply_defaults(config_frame(spark, rows, schema), table)


def required_columns(table: str) -> list[str]:
    return [c.name for c in CONTROL_TABLES[table] if not c.nullable]


def soft_delete(df: DataFrame, predicate: Column, by: str,
                at: Column | None = None) -> DataFrame:
    """SNK-10: deactivate matching rows and stamp who/when; never delete."""
    at = at if at is not None else F.current_timestamp()
    hit = F.coalesce(predicate, F.lit(False))
    changes = {
        "is_active": F.when(hit, F.lit(False)).otherwise(F.col("is_active")),
        "updated_at": F.when(hit, at.cast("timestamp")).otherwise(F.col("updated_at")),
        "updated_by": F.when(hit, F.lit(by)).otherwise(F.col("updated_by")),
    }
    return df.withColumns(changes)


# ── migration ledger ────────────────────────────────────────────────────────

ROLLBACK_SUFFIX = "_rollback.sql"


def applied_migrations(ledger: DataFrame, environment: str) -> DataFrame:
    """SRC-5 / FLT-4 / AGG-3: distinct ids applied successfully in one env."""
    return (ledger.where((F.col("environment") == F.lit(environment))
                         & (F.col("status") == F.lit("success")))
            .select("migration_id").distinct())


def pending_migrations(specs: DataFrame, ledger: DataFrame, environment: str) -> DataFrame:
    """SET-1 + JN-8 + SRT-1: migrations not yet applied, rollbacks excluded.

    ``specs`` has ``(sequence, migration_id, ...)``, one row per migration
    from every folder (already unioned). Order is explicit: (sequence, id).
    """
    live = specs.where(~F.col("migration_id").endswith(ROLLBACK_SUFFIX))
    return (live.join(applied_migrations(ledger, environment), "migration_id", "left_anti")
            .orderBy("sequence", "migration_id"))


# ── orchestration due list (DCL-1) ──────────────────────────────────────────

def due_list(config: DataFrame) -> DataFrame:
    """Active tables ordered by run_order with a readiness flag.

    A table is ready when none of its dependencies is an active table whose
    first load is incomplete. Dependencies are exploded and anti-joined; no
    row is collected.
    """
    active = config.where(F.col("is_active") == F.lit(True))
    deps = active.select("table_id", F.explode_outer("dependency_tables").alias("dep"))
    incomplete = active.where(~F.col("first_load_complete")).select(F.col("table_id").alias("dep"))
    blocked = deps.join(incomplete, "dep", "left_semi").select("table_id").distinct()
    blocked = blocked.withColumn("blocked", F.lit(True))
    return (active.join(blocked, "table_id", "left")
            .select("table_id", "run_order", "load_type", "watermark_column", "watermark_value",
                    F.coalesce(F.col("blocked"), F.lit(False)).alias("blocked"))
            .select("table_id", "run_order", "load_type", "watermark_column", "watermark_value",
                    (~F.col("blocked")).alias("ready"))
            .orderBy("run_order", "table_id"))


# ── schema drift (DCL-7) ────────────────────────────────────────────────────

def schema_rows(spark: SparkSession, table: str, df: DataFrame) -> DataFrame:
    """One row per column: (table, column, type)."""
    rows = [(table, f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return config_frame(spark, rows, "table string, column string, type string")


def schema_drift(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Added / removed / retyped columns between two schema-row frames."""
    c = current.select("table", "column", F.col("type").alias("new_type"))
    s = stored.select("table", "column", F.col("type").alias("old_type"))
    j = c.join(s, ["table", "column"], "full")
    change = (F.when(F.col("old_type").isNull(), F.lit("added"))
              .when(F.col("new_type").isNull(), F.lit("removed"))
              .when(F.col("old_type") != F.col("new_type"), F.lit("retyped")))
    return (j.withColumn("change", change).where(F.col("change").isNotNull())
            .select("table", "column", "change", "old_type", "new_type"))
