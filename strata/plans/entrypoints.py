"""The reference's jobs, with the same parameters, as functions and a CLI.

Each job reads its sources by ``catalog.schema.table`` name, builds its plan
with the library operators, loads it (full or keyed upsert), publishes the
public (secured) view and writes the run log; parameters that were notebook
widgets are arguments. ``python -m strata <job> --catalog ... ...`` runs
one from spark-submit.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession

from strata.operators.checks import (contract_findings, output_columns, raise_on_errors,
                                     require_params)
from strata.operators.harmonise import BLP_TABLES, TableSpec
from strata.plans import facts, jobs
from strata.sinks import control_tables
from strata.sinks.audit import RunLog
from strata.sinks.base import Sink
from strata.sinks.merge_into import MergeIntoSink
from strata.sinks.mirror import mirror_schema
from strata.sinks.partitioned import PartitionedSink
from strata.sinks.publish import SnapshotSink
from strata.sources.registry import bindings_frame
from strata.sources.tables import full_name, optional_table, read_table
from strata.session import ensure_defaults

log = logging.getLogger("strata.entrypoints")

PLATFORM_SCHEMA = "platform_config"
CONFIG_SCHEMA = "config"


def _log(spark: SparkSession, catalog: str, platform_schema: str) -> RunLog:
    return RunLog(SnapshotSink(spark, full_name(catalog, platform_schema)))


def _security(spark: SparkSession, catalog: str, domain_schema: str,
              config_schema: str) -> jobs.SecurityConfig:
    return jobs.SecurityConfig(bindings_frame(spark), full_name(catalog, config_schema),
                               schema_name=domain_schema)


def make_sink(spark: SparkSession, database: str, spec: str = "snapshot") -> Sink:
    """The sink that a table's configuration names:

    - ``snapshot``: small tables, and any table where nothing else is set up;
    - ``partitioned:<column>``: large tables; a delta rewrites only the
      partitions it touches;
    - ``merge`` or ``merge:<format>``: tables of a format with row-level
      operations; a delta is the format's own MERGE."""
    kind, _, argument = spec.partition(":")
    if kind == "snapshot" and not argument:
        return SnapshotSink(spark, database)
    if kind == "partitioned" and argument:
        return PartitionedSink(spark, database, argument, keep_previous=1)
    if kind == "merge":
        return MergeIntoSink(spark, database, argument or None)
    raise ValueError(f"unknown sink {spec!r}: snapshot, partitioned:<column> or merge[:<format>]")


def euh_job(spark: SparkSession, catalog: str, landing_schema: str, euh_schema: str,
            load_type: str = "delta", watermark_value: str = "", source_id: str = "BLP",
            specs: Sequence[TableSpec] = BLP_TABLES, max_parallel: int = 1,
            platform_schema: str = PLATFORM_SCHEMA, watermark_format: str = "",
            track_watermarks: bool = False, config_schema: str = CONFIG_SCHEMA,
            sink: str = "snapshot") -> int:
    """Landing -> harmonised for one source (the six BLP tables by default).

    One watermark text applies to every table, as in the reference; it is
    typed per table (cast, or parsed with ``watermark_format``, e.g.
    ``yyyyMMdd``) against each table's own watermark column. With
    ``track_watermarks`` and no ``watermark_value`` each table instead uses
    the mark its orchestration row holds, and the job records the new one.
    """
    require_params(catalog=catalog, landing_schema=landing_schema, euh_schema=euh_schema)
    if watermark_format:
        specs = [replace(sp, watermark_format=watermark_format) for sp in specs]
    target = make_sink(spark, full_name(catalog, euh_schema), sink)
    marks = {s.target: watermark_value for s in specs} if watermark_value else None
    state = SnapshotSink(spark, full_name(catalog, config_schema)) if track_watermarks else None
    return jobs.run_harmonise_job(
        spark, lambda t: read_table(spark, full_name(catalog, landing_schema, t)), target,
        _log(spark, catalog, platform_schema), specs, source_id, load_type, marks,
        max_parallel=max_parallel, state=state)


def fact_mot_job(spark: SparkSession, catalog: str, euh_schema: str, domain_schema: str,
                 load_type: str = "delta", config_schema: str = CONFIG_SCHEMA,
                 platform_schema: str = PLATFORM_SCHEMA, sink: str = "snapshot") -> int:
    """plan.fact_mot from the harmonised delivery, order and material tables."""
    require_params(catalog=catalog, euh_schema=euh_schema, domain_schema=domain_schema)
    euh = lambda t: read_table(spark, full_name(catalog, euh_schema, t))

    def build():
        return facts.material_on_time_fact(euh("likp"), euh("lips"), euh("vbak"), euh("mara"))

    return jobs.run_fact_job(spark, make_sink(spark, full_name(catalog, domain_schema), sink),
                             _log(spark, catalog, platform_schema), "fact_mot", build,
                             facts.MOT_KEYS, load_type,
                             _security(spark, catalog, domain_schema, config_schema))


def fact_spend_job(spark: SparkSession, catalog: str, euh_schema_arb: str, domain_schema: str,
                   euh_schema_clm: str = "", load_type: str = "delta",
                   contract_policy: str = "check", config_schema: str = CONFIG_SCHEMA,
                   platform_schema: str = PLATFORM_SCHEMA, sink: str = "snapshot") -> int:
    """sourcing.fact_spend; the contract source is optional (SRC-2)."""
    require_params(catalog=catalog, euh_schema_arb=euh_schema_arb, domain_schema=domain_schema)

    def build():
        spend = read_table(spark, full_name(catalog, euh_schema_arb, "arb_spend_lines"))
        clm = optional_table(spark, euh_schema_clm, "clm_contract_lines", catalog)
        return facts.spend_fact(spend, clm, contract_policy)

    return jobs.run_fact_job(spark, make_sink(spark, full_name(catalog, domain_schema), sink),
                             _log(spark, catalog, platform_schema), "fact_spend", build,
                             facts.SPEND_KEYS, load_type,
                             _security(spark, catalog, domain_schema, config_schema))


def fact_logistics_job(spark: SparkSession, catalog: str, euh_schema: str, domain_schema: str,
                       load_type: str = "delta", config_schema: str = CONFIG_SCHEMA,
                       platform_schema: str = PLATFORM_SCHEMA, sink: str = "snapshot") -> int:
    """deliver.fact_kabal_logistics from asset movements and assets."""
    require_params(catalog=catalog, euh_schema=euh_schema, domain_schema=domain_schema)

    def build():
        r = lambda t: read_table(spark, full_name(catalog, euh_schema, t))
        return facts.logistics_fact(r("kabal_asset_movements"), r("kabal_assets"))

    return jobs.run_fact_job(spark, make_sink(spark, full_name(catalog, domain_schema), sink),
                             _log(spark, catalog, platform_schema), "fact_kabal_logistics",
                             build, facts.LOGISTICS_KEYS, load_type,
                             _security(spark, catalog, domain_schema, config_schema))


def apply_row_filter_job(spark: SparkSession, catalog: str, schema_name: str,
                         table_name: str, config_schema: str = CONFIG_SCHEMA,
                         sink: str = "snapshot") -> str:
    """SEC-1 on its own: (re)publish a table's public view from the registry.
    ``sink`` is the one that the table is loaded with.

    Returns ``FILTERED`` or ``SKIPPED``; raises if the table no longer has
    its filter column.
    """
    require_params(catalog=catalog, schema_name=schema_name, table_name=table_name)
    table_sink = make_sink(spark, full_name(catalog, schema_name), sink)
    columns = table_sink.read(table_name).columns
    return jobs.publish_public_view(
        table_sink, table_name, _security(spark, catalog, schema_name, config_schema), columns)


def migrate_job(spark: SparkSession, catalog: str, env: str,
                config_schema: str = CONFIG_SCHEMA) -> list[str]:
    """Apply pending platform migrations for one environment (ledgered)."""
    require_params(catalog=catalog, env=env)
    sink = SnapshotSink(spark, full_name(catalog, config_schema))
    return control_tables.apply_migrations(sink, control_tables.platform_migrations(), env)


def mirror_job(spark: SparkSession, catalog: str, source_schema: str, target_schema: str,
               modified: Sequence[str] = (), context: Sequence[str] = (),
               masked: Sequence[str] = (), allowed_group: str = "",
               membership_table: str = "") -> dict:
    """DCL-3/4: mirror a harmonised schema (deep copies of the tables a change
    modifies, views over the rest), with masking views for sensitive columns."""
    require_params(catalog=catalog, source_schema=source_schema, target_schema=target_schema)
    sink = SnapshotSink(spark, full_name(catalog, target_schema))
    kw = {}
    if masked:
        require_params(allowed_group=allowed_group, membership_table=membership_table)
        kw = {"masked": list(masked), "allowed_groups": [allowed_group],
              "membership_table": membership_table}
    return mirror_schema(spark, full_name(catalog, source_schema), sink, list(modified),
                         list(context), **kw)


def contract_check_job(spark: SparkSession, catalog: str,
                       tables: Sequence[tuple[str, str]]) -> int:
    """CHK-1/2/4 over published tables: raise on a dropped filter column,
    log every warning (unregistered tables) and return their number."""
    outputs = {(s, t): read_table(spark, full_name(catalog, s, t + "__base")) for s, t in tables}
    cols = output_columns(spark, outputs)
    findings = raise_on_errors(contract_findings(cols.select("schema", "table").distinct(),
                                                 cols, bindings_frame(spark)))
    warnings = findings.collect()  # one per table at most
    for r in warnings:
        log.warning("%s.%s: %s", r["schema"], r["table"], r["detail"])
    return len(warnings)


def _split(text: str | None) -> list[str]:
    return [t.strip() for t in (text or "").split(",") if t.strip()]


def _mirror_cli(spark: SparkSession, catalog: str, source_schema: str, target_schema: str,
                modified: str = "", context: str = "", masked: str = "",
                allowed_group: str = "", membership_table: str = "") -> dict:
    return mirror_job(spark, catalog, source_schema, target_schema, _split(modified),
                      _split(context), _split(masked), allowed_group, membership_table)


def _contract_check_cli(spark: SparkSession, catalog: str, tables: str) -> int:
    """``--tables plan.fact_mot,deliver.fact_kabal_logistics``."""
    pairs = [tuple(t.strip().rsplit(".", 1)) for t in tables.split(",") if t.strip()]
    return contract_check_job(spark, catalog, pairs)


JOBS = {
    "euh": euh_job, "fact_mot": fact_mot_job, "fact_spend": fact_spend_job,
    "fact_logistics": fact_logistics_job, "apply_row_filter": apply_row_filter_job,
    "migrate": migrate_job, "contract_check": _contract_check_cli, "mirror": _mirror_cli,
}


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="python -m strata")
    p.add_argument("job", choices=sorted(JOBS))
    for opt in ("catalog", "landing_schema", "euh_schema", "euh_schema_arb", "euh_schema_clm",
                "domain_schema", "load_type", "watermark_value", "schema_name", "table_name",
                "env", "config_schema", "platform_schema", "watermark_format", "tables",
                "source_schema", "target_schema", "modified", "context", "masked",
                "allowed_group", "membership_table", "sink"):
        p.add_argument(f"--{opt}", default=None)
    p.add_argument("--track_watermarks", action="store_true", default=None)
    args = {k: v for k, v in vars(p.parse_args(argv)).items() if v is not None}
    job = JOBS[args.pop("job")]
    spark = ensure_defaults(SparkSession.builder.getOrCreate())
    print(job(spark, **args))
