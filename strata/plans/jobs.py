"""Job entry points: what the reference's notebooks do, as functions.

``run_fact_job``: build a curated fact, load it (full or keyed upsert),
publish its secured public view, and audit the run.
``run_harmonise_job``: load every landing table of a source into the
harmonised layer with watermark and provenance, one audit row per table.

Parameters replace notebook widgets; the secured view is published on
*every* run together with the data (fixes the first-run-only binding, Q3).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.checks import require_params
from strata.operators.harmonise import TableSpec, harmonise, typed_watermark
from strata.operators.propagate import JoinGraph, propagate
from strata.operators.quarantine import REJECT_SCHEMA, accepted, reject_counts, rejected, tag_rejects
from strata.operators.reconcile import FINGERPRINT_SCHEMA, differing, fingerprints, row_differences
from strata.operators.security import PATTERNS, FilterColumnMissing, pruned_select_sql, secured_select_sql
from strata.operators.upsert import upsert_counted
from strata.session import stage
from strata.sinks.audit import RunLog, audited, new_run_id, observe_rows, observed_rows
from strata.sinks.control_tables import record_watermarks
from strata.sinks.base import Sink
from strata.sinks.merge_into import MergeIntoSink
from strata.sinks.partitioned import PartitionedSink
from strata.sinks.publish import SnapshotSink
from strata.sources.local import config_frame
from strata.sources.registry import binding_for


log = logging.getLogger("strata.jobs")


@dataclass
class SecurityConfig:
    """Where the binding registry, maps and membership live."""

    bindings: DataFrame
    config_database: str            # holds <map_table> and the membership table
    membership_table: str = "group_membership"
    schema_name: str | None = None  # registry schema (logical domain) of the table


def load(sink: Sink, df: DataFrame, name: str, keys: Sequence[str],
         load_type: str = "delta", stage_source: bool = True,
         **upsert_kwargs) -> tuple[int, str, int]:
    """SNK-12: full load (or first load) vs keyed upsert into a snapshot.

    Returns (rows in the transformed set, effective load type, version).
    Full loads count rows by observing the write (one pass); delta loads
    stage the source once (``session.stage``) so the upsert's branches do
    not recompute it, and take the count from the upsert's key check.
    """
    return load_marked(sink, df, name, keys, load_type, None, stage_source, **upsert_kwargs)[:3]


def load_marked(sink: Sink, df: DataFrame, name: str, keys: Sequence[str],
                load_type: str = "delta", mark_column: str | None = None,
                stage_source: bool = True, **upsert_kwargs) -> tuple[int, str, int, str | None]:
    """:func:`load`, and the largest ``mark_column`` (as text) among the very
    rows that were loaded: from the observed write of a full load, from the
    staged rows of a delta load. The source is never read again for it, so
    rows that arrive meanwhile stay above the mark."""
    if load_type not in ("full", "delta"):
        raise ValueError(f"load_type must be 'full' or 'delta', not {load_type!r}")
    if load_type == "full" or not sink.exists(name):
        observed, obs = observe_rows(df, newest=F.col(mark_column) if mark_column else None)
        version = sink.publish(observed, name, keys=list(keys) or None)
        return observed_rows(obs), "full", version, obs.get.get("newest")
    mark = None
    if stage_source or mark_column:
        df = stage(df, f"{sink.database}/{name}")
    if mark_column:
        mark = df.agg(F.max(mark_column).cast("string")).first()[0]
    if isinstance(sink, (PartitionedSink, MergeIntoSink)):  # touched data only
        return sink.upsert(df, name, keys, **upsert_kwargs), "delta", 0, mark
    merged, n = upsert_counted(sink.read(name), df, keys, **{"one_scan": True, **upsert_kwargs})
    version = sink.publish(merged, name, keys=list(keys) or None)
    return int(n or 0), "delta", version, mark


def publish_public_view(sink: Sink, name: str, security: SecurityConfig | None,
                        columns: Sequence[str], binding: dict | None = None) -> str:
    """SEC-1/SEC-2: the public name is the secured view if the table is bound."""
    if binding is None and security is not None:
        binding = binding_for(security.bindings, security.schema_name or sink.database, name)
    if binding is None:
        sink.set_public_view(name)
        log.warning("%s: no row filter binding; public view is unfiltered (SKIPPED)",
                    sink.public_name(name))
        return "SKIPPED"
    column = binding["filter_column"]
    if column not in columns:
        raise FilterColumnMissing(f"{name}: filter column {column!r} not produced")
    pattern = PATTERNS[binding["row_filter"]]
    # stored by the filter column: readers read their own partitions only
    select_sql = pruned_select_sql if getattr(sink, "partition_col", None) == column else secured_select_sql
    body = select_sql(
        base=sink.base_view(name), column=column,
        map_table=f"{security.config_database}.{pattern.map_table}", map_key=pattern.map_key,
        membership_table=f"{security.config_database}.{security.membership_table}")
    sink.set_public_view(name, body)
    return "FILTERED"


def _binding(spark: SparkSession, sink: Sink, name: str, security: SecurityConfig | None,
             columns: Sequence[str]) -> dict | None:
    """The table's row filter binding; fails before anything is written if its
    secured view could not be built."""
    if security is None:
        return None
    b = binding_for(security.bindings, security.schema_name or sink.database, name)
    if b and b["filter_column"] not in columns:
        raise FilterColumnMissing(f"{name}: filter column {b['filter_column']!r} not produced")
    if b:
        pattern = PATTERNS[b["row_filter"]]
        for t in (pattern.map_table, security.membership_table):
            if not spark.catalog.tableExists(f"{security.config_database}.{t}"):
                raise RuntimeError(f"{name}: security table "
                                   f"{security.config_database}.{t} is missing")
    return b


def run_fact_job(spark: SparkSession, sink: Sink, run_log: RunLog, name: str,
                 build: Callable[[], DataFrame], keys: Sequence[str], load_type: str = "delta",
                 security: SecurityConfig | None = None, run_id: str | None = None) -> int:
    """One curated table: build -> load -> secure -> audit."""
    require_params(name=name, load_type=load_type)
    run_id = run_id or new_run_id()
    target = sink.public_name(name)

    def body():
        df = build()
        b = _binding(spark, sink, name, security, df.columns)
        rows, effective, _ = load(sink, df, name, keys, load_type)
        action = publish_public_view(sink, name, security, df.columns, binding=b)
        log.info("%s: %s load of %d rows, public view %s (run %s)", target, effective, rows,
                 action, run_id)
        return rows, effective

    return audited(run_log, run_id, target, load_type, body)


def run_fact_changes_job(spark: SparkSession, sink: Sink, run_log: RunLog, name: str,
                         build: Callable[[Mapping[str, DataFrame]], DataFrame], graph: JoinGraph,
                         tables: Mapping[str, DataFrame], changes: Mapping[str, DataFrame],
                         security: SecurityConfig | None = None, run_id: str | None = None) -> int:
    """One curated table from what changed in its inputs (``operators.propagate``):
    only fact rows that a changed row of any input reaches are recomputed, and
    rows without inputs are deleted. Returns the rows recomputed.

    A first load builds the whole fact. A sink that merges by key gets the
    recomputed rows alone, as long as no key is to be deleted (its keys must be
    unique, as for any upsert); otherwise the table is published with them.
    """
    require_params(name=name)
    run_id = run_id or new_run_id()
    target = sink.public_name(name)

    def body():
        if not sink.exists(name):
            df = build(tables)
            b = _binding(spark, sink, name, security, df.columns)
            rows, effective, _ = load(sink, df, name, graph.fact_keys, "full")
        else:
            fact = sink.read(name)
            b = _binding(spark, sink, name, security, fact.columns)
            done = propagate(fact, build, graph, tables, changes, f"{sink.database}/{name}")
            rows, effective = done.rows.count() if done else 0, "delta"
            if done and isinstance(sink, (PartitionedSink, MergeIntoSink)) and not done.deletes(fact):
                sink.upsert(done.rows, name, list(graph.fact_keys))
            elif done:
                sink.publish(done.fact, name, keys=list(graph.fact_keys))
        publish_public_view(sink, name, security, sink.read(name).columns, binding=b)
        return rows, effective

    return audited(run_log, run_id, target, "delta", body)


QUARANTINE = "quarantine"
RECONCILIATION = "reconciliation"


class TooManyRejects(RuntimeError):
    """A load was refused because too many of its rows break the table's rules."""


def _append(sink: SnapshotSink, df: DataFrame, name: str, schema: str, run_id: str,
            target: str) -> None:
    """Append a run's rows to a state table, once however often the run is repeated."""
    with sink.lock(name + "__create"):
        if not sink.exists(name):
            sink.publish(config_frame(sink.spark, [], schema), name)
    mine = sink.read(name).where((F.col("run_id") == F.lit(run_id)) & (F.col("target") == F.lit(target)))
    if mine.isEmpty():
        sink.append(df, name)


def run_quarantined_load(spark: SparkSession, sink: Sink, run_log: RunLog, name: str,
                         build: Callable[[], DataFrame], keys: Sequence[str],
                         required: Sequence[str] = (), rules: Mapping[str, Column] | None = None,
                         load_type: str = "delta", max_reject_share: float = 1.0,
                         security: SecurityConfig | None = None,
                         run_id: str | None = None) -> tuple[int, int]:
    """CHK-3, SNK-6: load the rows that keep the table's rules and set the others
    apart, with what each breaks, in the run log's database (table ``quarantine``).

    The source is read once: rows are tagged and staged, and an Observation on that
    write counts both kinds. Key columns are required too. If more than
    ``max_reject_share`` of the rows are rejected nothing is loaded, the run
    fails and is logged as failed; its rejects stay for inspection. Returns (rows
    accepted, rows rejected); the run log gets a row for each of the two.
    """
    require_params(name=name, load_type=load_type, keys=list(keys))
    run_id = run_id or new_run_id()
    target = sink.public_name(name)
    counts: dict[str, int] = {}

    def body():
        tagged = tag_rejects(build(), list(dict.fromkeys([*keys, *required])), rules)
        obs = Observation("quarantine")
        tagged = stage(tagged.observe(obs, *reject_counts()), f"{sink.database}/{name}__tagged")
        counts.update(obs.get)
        b = _binding(spark, sink, name, security, accepted(tagged).columns)
        if counts["rejected"]:
            _append(run_log.sink, rejected(tagged, target, run_id), QUARANTINE, REJECT_SCHEMA, run_id, target)
        if counts["rejected"] > max_reject_share * counts["rows"]:
            raise TooManyRejects(f"{counts['rejected']} of {counts['rows']} rows break the rules of {target}")
        rows, effective, _ = load(sink, accepted(tagged), name, keys, load_type, stage_source=False)
        publish_public_view(sink, name, security, accepted(tagged).columns, binding=b)
        return rows, effective

    rows = audited(run_log, run_id, target, load_type, body)
    run_log.write(run_id, target, load_type, counts["rejected"], "rejected")
    return rows, counts["rejected"]


def run_reconcile_job(spark: SparkSession, run_log: RunLog, name: str, source: DataFrame,
                      target: DataFrame, keys: Sequence[str], partition: Column,
                      columns: Sequence[str] | None = None, run_id: str | None = None) -> DataFrame:
    """AGG-1/AGG-2, DCL-3: compare a copy with its source (``operators.reconcile``).

    Fingerprints of both sides are stored in the run log's database (table
    ``reconciliation``) and compared as stored; the run log gets a row ``matched``
    or ``differs`` with the number of partitions that differ. Returns the
    differing keys, found in those partitions alone."""
    require_params(name=name, keys=list(keys))
    run_id = run_id or new_run_id()
    columns = list(columns or source.columns)
    sides = [fingerprints(df, keys, partition, columns).select(
        F.lit(name).alias("target"), F.lit(run_id).alias("run_id"), F.lit(side).alias("side"), "*")
        for side, df in (("source", source), ("target", target))]
    _append(run_log.sink, sides[0].unionByName(sides[1]), RECONCILIATION,
            "target string, run_id string, side string, " + FINGERPRINT_SCHEMA, run_id, name)
    stored = run_log.sink.read(RECONCILIATION).where(
        (F.col("run_id") == F.lit(run_id)) & (F.col("target") == F.lit(name)))
    found = differing(*[stored.where(F.col("side") == F.lit(s)) for s in ("source", "target")])
    n = found.count()
    run_log.write(run_id, name, "reconcile", n, "differs" if n else "matched")
    return row_differences(source, target, keys, partition, found, columns)


def stored_watermarks(state: SnapshotSink, table_ids: Mapping[str, str]) -> dict[str, str]:
    """DCL-2: the watermark each table's orchestration row holds (target -> value)."""
    if not state.exists("orchestration_config"):
        return {}
    ids = list(table_ids.values())
    rows = (state.read("orchestration_config")
            .where(F.col("table_id").isin(ids) & F.col("watermark_value").isNotNull())
            .select("table_id", "watermark_value").collect())  # one row per table
    by_id = {r["table_id"]: r["watermark_value"] for r in rows}
    return {t: by_id[i] for t, i in table_ids.items() if i in by_id}


def run_harmonise_job(spark: SparkSession, read_landing: Callable[[str], DataFrame],
                      sink: Sink, run_log: RunLog, specs: Sequence[TableSpec],
                      source_id: str, load_type: str = "delta",
                      watermarks: Mapping[str, str] | None = None,
                      run_id: str | None = None, max_parallel: int = 1,
                      state: SnapshotSink | None = None) -> int:
    """Harmonise every spec; one audit row per table (Q17). Returns total rows.

    Tables are independent Spark jobs. With ``max_parallel > 1`` they are
    submitted from a thread pool so small tables run beside large ones
    (Spark schedules concurrent jobs; a FAIR scheduler pool shares the
    cluster between them). Every table is attempted and audited; the first
    failure is re-raised at the end. Sequentially (the default), a failure
    at table k leaves 1..k-1 loaded and stops, as in the reference.
    """
    require_params(source_id=source_id, load_type=load_type)
    run_id = run_id or new_run_id()
    table_ids = {sp.target: sink.public_name(sp.target) for sp in specs}
    from_state = watermarks is None and state is not None
    if from_state:
        watermarks = stored_watermarks(state, table_ids)
    watermarks = watermarks or {}
    marks: dict[str, str] = {}  # one entry per loaded table, stored once at the end

    def one(spec: TableSpec) -> int:
        if from_state:  # a stored mark is the column's own text; a format is for what users type
            spec = replace(spec, watermark_format=None)

        def body():
            exists = sink.exists(spec.target)
            df, effective = harmonise(read_landing(spec.source), spec, source_id, load_type,
                                      watermarks.get(spec.target), target_exists=exists)
            col = None
            if state is not None and spec.watermark_column:
                col = spec.rename.get(spec.watermark_column, spec.watermark_column)
            rows, eff, _, newest = load_marked(sink, df, spec.target, spec.keys, effective, col)
            sink.set_public_view(spec.target)
            if newest is not None:
                # DCL-2: never below the previous mark (an overlap window may
                # re-read older rows); compared in the column's own type
                prev = watermarks.get(spec.target)
                if prev:
                    kind = df.schema[col].dataType
                    newest = spark.range(1).select(F.greatest(
                        F.lit(newest).cast(kind), typed_watermark(df, col, prev, spec.watermark_format)
                    ).cast("string")).first()[0]
                marks[table_ids[spec.target]] = newest
            return rows, eff

        return audited(run_log, run_id, sink.public_name(spec.target), load_type, body)

    try:
        if max_parallel <= 1:
            return sum(one(spec) for spec in specs)
        return _in_parallel(spark, one, specs, max_parallel)
    finally:
        if marks:  # also those of the tables loaded before a failure
            record_watermarks(state, marks)


def _in_parallel(spark: SparkSession, one: Callable[[TableSpec], int],
                 specs: Sequence[TableSpec], max_parallel: int) -> int:
    from concurrent.futures import ThreadPoolExecutor

    def in_pool(spec: TableSpec) -> int:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", "harmonise")
        return one(spec)

    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        futures = [pool.submit(in_pool, spec) for spec in specs]
    errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        raise errors[0]
    return sum(f.result() for f in futures)
