"""Registered queries: each runs a library operator over the test tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose work
grows with the tables. Small config inputs (group maps, membership) are fixed
rows; the data they filter is always the whole table. Queries of the write
path run the jobs into a database of their own under the shared checkpoint
folder and return what a reader finds there.
Non-deterministic columns (load timestamps) are reported as
``has_<col>`` booleans so results can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.sql_functions import create_security_functions
from strata.operators import checks, control, security
from strata.operators.harmonise import TableSpec, harmonise, high_water_mark, watermark_filter
from strata.operators.propagate import changed_rows
from strata.operators.upsert import load_frame, upsert
from strata.plans import facts, jobs
from strata.session import checkpoint_dir
from strata.sinks.audit import RunLog, run_totals
from strata.sinks.mirror import mirror_table
from strata.sinks.partitioned import PartitionedSink, key_range
from strata.sinks.publish import SnapshotSink
from strata.sources import fixtures as fx
from strata.sources.registry import bindings_frame
from strata.sources.tables import optional_table
from strata.streaming.events import load_events

SOFT_DELETE_AT = "2026-01-01 00:00:00"


def _tables(spark: SparkSession, sf_dir: str) -> fx.TestTables:
    return fx.TestTables(spark, sf_dir)


def _database(spark: SparkSession, label: str) -> str:
    """A new database in the shared folder, so that executors can write to it."""
    name = f"strata_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{checkpoint_dir(spark).rstrip('/')}/{name}'")
    return name


def _ts(df: DataFrame, column: str, value: str):
    """A literal of the column's own timestamp type."""
    return F.lit(value).cast(df.schema[column].dataType)


def _stable(df: DataFrame, ts_cols=("_loaded_at",)) -> DataFrame:
    """Replace load timestamps by ``has_<col>`` flags."""
    out = df
    for c in ts_cols:
        if c in out.columns:
            out = out.withColumn(f"has{c}" if c.startswith("_") else f"has_{c}",
                                 F.col(c).isNotNull()).drop(c)
    return out


# ── curated facts ───────────────────────────────────────────────────────────

def material_on_time(spark, sf_dir, exclude_unknown=True):
    t = _tables(spark, sf_dir)
    return facts.material_on_time_fact(fx.delivery_header(t), fx.delivery_items(t),
                                       fx.sales_orders(t), fx.materials(t),
                                       exclude_unknown=exclude_unknown)


def material_on_time_all(spark, sf_dir):
    return material_on_time(spark, sf_dir, exclude_unknown=False)


def material_on_time_hot(spark, sf_dir):
    """JN-1 with the hot-key path taken: deliveries of over eight items."""
    t = _tables(spark, sf_dir)
    return facts.material_on_time_fact(fx.delivery_header(t), fx.delivery_items(t),
                                       fx.sales_orders(t), fx.materials(t), hot_key_rows=8)


def spend_rename(spark, sf_dir):
    return facts.spend_lines_renamed(fx.spend_lines(_tables(spark, sf_dir)))


def spend_with_contract(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return facts.spend_fact(fx.spend_lines(t), fx.contract_lines(t), contract_policy="check")


def spend_without_contract(spark, sf_dir):
    t = _tables(spark, sf_dir)
    # SRC-2: the contract source's schema is not configured -> no scan, None
    contracts = optional_table(spark, "", "clm_contract_lines")
    return facts.spend_fact(fx.spend_lines(t), contracts)


def spend_latest_contract(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return facts.spend_fact(fx.spend_lines(t), fx.repeated_contract_lines(t),
                            contract_policy="latest",
                            contract_order=["signed_at", "contract_id"])


def logistics_on_time(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return facts.logistics_fact(fx.asset_movements(t), fx.assets(t))


# ── harmonise ───────────────────────────────────────────────────────────────

ORDERS_SPEC = TableSpec("orders", "orders", ("o_orderkey",), "o_orderdate")
CUSTOMER_SPEC = TableSpec("customer", "customer", ("c_custkey",))
CUSTOMER_RENAMED = TableSpec("customer", "customer", ("customer_id",), rename={
    "c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "market_segment"})


def watermark_delta(spark, sf_dir):
    t = _tables(spark, sf_dir)
    df, _ = harmonise(t("orders"), ORDERS_SPEC, "BLP", "delta", watermark="2000-01-01")
    return _stable(df)


def harmonise_passthrough(spark, sf_dir):
    df, _ = harmonise(_tables(spark, sf_dir)("customer"), CUSTOMER_SPEC, "BLP", "full")
    return _stable(df)


def harmonise_renamed(spark, sf_dir):
    df, _ = harmonise(_tables(spark, sf_dir)("customer"), CUSTOMER_RENAMED, "BLP", "full")
    return _stable(df)


ORDERS_COMPACT = TableSpec("orders", "orders", ("o_orderkey",), "o_orderdate",
                           watermark_format="yyyyMMdd")


def watermark_compact(spark, sf_dir):
    """FLT-1 with a compact text watermark parsed into the column's type."""
    df, _ = harmonise(_tables(spark, sf_dir)("orders"), ORDERS_COMPACT, "BLP", "delta",
                      watermark="19980601")
    return _stable(df)


EVENTS_SPEC = TableSpec("events", "events", ("event_id",), "ts")


def watermark_events(spark, sf_dir):
    """FLT-1 on a microsecond timestamp: strictly newer events only."""
    df, _ = harmonise(_tables(spark, sf_dir)("events"), EVENTS_SPEC, "APP", "delta",
                      watermark="2024-01-15 12:00:00.5")
    return _stable(df)


WATERMARKED = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))


def high_water_marks(spark, sf_dir):
    """DCL-2: the next watermark of each harmonised table."""
    t = _tables(spark, sf_dir)
    out = None
    for name, col in WATERMARKED:
        hwm = high_water_mark(t(name), col).select(F.lit(name).alias("target"),
                                                   F.col("watermark_value"))
        out = hwm if out is None else out.unionByName(hwm)
    return out


def first_load_then_merge(spark, sf_dir):
    """SNK-12 + Q6: a first delta load writes everything, the next one merges."""
    t = _tables(spark, sf_dir)
    orders = t("orders")
    landing_1 = orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", "2000-01-01"))
    run1, _ = harmonise(landing_1, ORDERS_SPEC, "BLP", "delta", watermark="1999-06-01",
                        target_exists=False)
    state, _ = load_frame(None, run1, ORDERS_SPEC.keys, "delta")
    run2, _ = harmonise(orders, ORDERS_SPEC, "BLP", "delta", watermark="1999-06-01",
                        target_exists=True)
    state, _ = load_frame(state, run2, ORDERS_SPEC.keys, "delta")
    return _stable(state)


# ── upsert ──────────────────────────────────────────────────────────────────

def _orders_batch(orders: DataFrame) -> DataFrame:
    """Orders changed after 1999-06-01: open orders are now fulfilled."""
    return (orders.where(F.col("o_orderdate") > _ts(orders, "o_orderdate", "1999-06-01"))
            .withColumn("o_orderstatus",
                        F.when(F.col("o_orderstatus") == F.lit("O"), F.lit("F"))
                        .otherwise(F.col("o_orderstatus"))))


def upsert_single_key(spark, sf_dir):
    orders = _tables(spark, sf_dir)("orders")
    base = orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", "2000-01-01"))
    return upsert(base, _orders_batch(orders), ["o_orderkey"])


def upsert_composite_key(spark, sf_dir):
    conv = _tables(spark, sf_dir)("conversations")
    base = conv.where(F.col("role") != F.lit("assistant"))
    batch = (conv.where(F.col("role").isin("assistant", "system"))
             .withColumn("text", F.when(F.col("role") == F.lit("system"),
                                        F.concat(F.col("text"), F.lit(" [rev]")))
                         .otherwise(F.col("text"))))
    return upsert(base, batch, ["conv_id", "turn"])


def upsert_evolve(spark, sf_dir):
    """SNK-2 with schema evolution: the batch brings a column the target lacks."""
    orders = _tables(spark, sf_dir)("orders")
    base = (orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", "2000-01-01"))
            .drop("o_orderpriority"))
    return upsert(base, _orders_batch(orders), ["o_orderkey"], evolve=True)


def upsert_events_late(spark, sf_dir):
    """Late events: a batch overlapping the loaded window re-delivers events
    with corrected values and brings new ones (keyed by event_id)."""
    ev = _tables(spark, sf_dir)("events")
    base = ev.where(F.col("ts") < _ts(ev, "ts", "2024-01-20"))
    batch = (ev.where(F.col("ts") > _ts(ev, "ts", "2024-01-10"))
             .withColumn("value", F.col("value") * F.lit(2.0)))
    return upsert(base, batch, ["event_id"])


def upsert_hot_target(spark, sf_dir):
    """SNK-4 by one scan of the target: returned lines, a third of all, share
    one key, and lines without a key match nothing."""
    t = _tables(spark, sf_dir)
    lines = t("lineitem").select(
        F.when(F.col("l_returnflag") == F.lit("R"), F.lit(0))
        .when(F.col("l_quantity") < 49, F.col("l_orderkey") + 1).cast("bigint").alias("line_group"),
        "l_linenumber", "l_quantity", "l_shipdate")
    batch = (t("orders").where(F.col("o_orderstatus") == F.lit("F"))
             .select((F.col("o_orderkey") + 1).alias("line_group"), F.lit(0).alias("l_linenumber"),
                     F.col("o_totalprice").alias("l_quantity"), F.col("o_orderdate").alias("l_shipdate")))
    rest = t("orders").agg(F.max("o_orderdate").alias("l_shipdate")).select(
        F.lit(0).cast("bigint").alias("line_group"), F.lit(9).alias("l_linenumber"),
        F.lit(1.5).alias("l_quantity"), "l_shipdate")
    unnumbered = batch.where("l_quantity > 400000").withColumn("line_group", F.lit(None).cast("bigint"))
    return upsert(lines, batch.unionByName(rest).unionByName(unnumbered), ["line_group"],
                  null_keys="allow", broadcast_limit=0, one_scan=True)


def upsert_null_keys(spark, sf_dir):
    orders = _tables(spark, sf_dir)("orders")
    unnumbered = (orders.where(F.col("o_orderstatus") == F.lit("P"))
                  .withColumn("o_orderkey", F.lit(None).cast("bigint")))
    return upsert(orders, unnumbered, ["o_orderkey"], null_keys="allow")


# ── security ────────────────────────────────────────────────────────────────

def _lob(spark):
    return fx.lob_group_map(spark)


def row_filter_lob(spark, sf_dir):
    return security.row_filter(material_on_time_all(spark, sf_dir), "lob_code", _lob(spark),
                               fx.membership(spark), "ana")


def secured_material_on_time(spark, sf_dir):
    """Flagship: the curated on-time fact as one LOB reader sees it."""
    return security.row_filter(material_on_time(spark, sf_dir), "lob_code", _lob(spark),
                               fx.membership(spark), "ana")


def row_filter_entity(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return security.row_filter(spend_rename(spark, sf_dir), "company_code",
                               fx.legal_entity_group_map(t), fx.membership(spark), "eve")


def row_filter_asset(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return security.row_filter(logistics_on_time(spark, sf_dir), "asset_id",
                               fx.asset_group_map(t), fx.membership(spark), "ash")


def row_filter_global(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return security.row_filter(spend_rename(spark, sf_dir), "company_code",
                               fx.legal_entity_group_map(t), fx.membership(spark), "gil")


def visible_rows_per_principal(spark, sf_dir):
    """FLT-6, FN-6: how many rows of each fact every principal sees, zeros of
    readers without a group or with an inactive mapping included."""
    t = _tables(spark, sf_dir)
    members = fx.membership(spark).unionByName(
        fx.membership(spark).select(F.lit("nobody").alias("principal"),
                                    F.lit("grp-of-no-map").alias("group_id")).distinct())
    out = None
    for table, fact, column, group_map in (
            ("fact_mot", material_on_time_all(spark, sf_dir), "lob_code", _lob(spark)),
            ("fact_spend", _spend_with_nulls(spark, sf_dir), "company_code",
             fx.legal_entity_group_map(t)),
            ("fact_kabal_logistics", logistics_on_time(spark, sf_dir), "asset_id",
             fx.asset_group_map(t))):
        rows = security.visible_rows(fact, column, group_map, members).select(
            F.lit(table).alias("target"), "principal", "visible_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


# groups of the session's user in the queries that read a published view
VIEWER_GROUPS = ["grp-lob-ds", "grp-lob-rf", "grp-entity-r1", "grp-entity-r2", "grp-asset-n3",
                 "grp-asset-n20"]


def _published(spark, sf_dir, schema: str, table: str, build, keys, maps,
               partition_by: str | None = None, groups=VIEWER_GROUPS) -> DataFrame:
    """SEC-1..3: run the fact job with its registry binding and read the
    public name as the session's user, a member of ``groups``. With
    ``partition_by`` the fact is stored by that column."""
    config = _database(spark, "config")
    for name, frame in maps.items():
        frame.write.saveAsTable(f"{config}.{name}")
    me = security.current_principal(spark)
    fx.config_frame(spark, [(me, g) for g in groups], "principal string, group_id string") \
        .write.saveAsTable(f"{config}.group_membership")
    database = _database(spark, schema)
    sink = PartitionedSink(spark, database, partition_by) if partition_by else SnapshotSink(spark, database)
    rules = jobs.SecurityConfig(bindings_frame(spark), config, schema_name=schema)
    jobs.run_fact_job(spark, sink, RunLog(SnapshotSink(spark, config)), table,
                      lambda: build(spark, sf_dir), keys, "delta", rules)
    return spark.table(sink.public_name(table))


def published_fact_mot(spark, sf_dir):
    return _published(spark, sf_dir, "plan", "fact_mot", material_on_time, facts.MOT_KEYS,
                      {"lob_group_map": _lob(spark)})


def published_fact_spend(spark, sf_dir):
    return _published(spark, sf_dir, "sourcing", "fact_spend", spend_with_contract,
                      facts.SPEND_KEYS,
                      {"legal_entity_group_map": fx.legal_entity_group_map(_tables(spark, sf_dir))})


def published_fact_logistics(spark, sf_dir):
    return _published(spark, sf_dir, "deliver", "fact_kabal_logistics", logistics_on_time,
                      facts.LOGISTICS_KEYS,
                      {"asset_group_map": fx.asset_group_map(_tables(spark, sf_dir))})


def pruned_fact_mot(spark, sf_dir):
    """SEC-3, FLT-6: the fact stored by its filter column; a reader's query
    reads the partitions of that reader's codes alone."""
    return _published(spark, sf_dir, "plan", "fact_mot", material_on_time_all, facts.MOT_KEYS,
                      {"lob_group_map": _lob(spark)}, "lob_code")


def pruned_fact_spend(spark, sf_dir):
    return _published(spark, sf_dir, "sourcing", "fact_spend", _spend_with_nulls, facts.SPEND_KEYS,
                      {"legal_entity_group_map": fx.legal_entity_group_map(_tables(spark, sf_dir))},
                      "company_code")


def pruned_fact_spend_global(spark, sf_dir):
    """The same for a GLOBAL reader, who sees the partition of NULL codes too."""
    return _published(spark, sf_dir, "sourcing", "fact_spend", _spend_with_nulls, facts.SPEND_KEYS,
                      {"legal_entity_group_map": fx.legal_entity_group_map(_tables(spark, sf_dir))},
                      "company_code", [*VIEWER_GROUPS, "grp-entity-global"])


def _by_function(spark, sf_dir, function: str, fact: DataFrame, maps) -> DataFrame:
    """UDF-1..3: the fact bound to a persisted catalog function, as the view's
    predicate; the function's body is inlined and decorrelated."""
    config = _database(spark, "config")
    for name, frame in maps.items():
        frame.write.saveAsTable(f"{config}.{name}")
    for name in {p.map_table for p in security.PATTERNS.values()} - set(maps):
        fx.lob_group_map(spark).select(
            F.lit("").alias(next(p.map_key for p in security.PATTERNS.values() if p.map_table == name)),
            "entra_group_id", "scope", "is_active").where(F.lit(False)).write.saveAsTable(f"{config}.{name}")
    me = security.current_principal(spark)
    fx.config_frame(spark, [(me, g) for g in VIEWER_GROUPS], "principal string, group_id string") \
        .write.saveAsTable(f"{config}.group_membership")
    create_security_functions(spark, config, f"{config}.group_membership")
    column = FUNCTION_COLUMNS[function]
    fact.write.saveAsTable(f"{config}.fact")
    spark.sql(f"CREATE VIEW {config}.visible AS SELECT * FROM {config}.fact "
              f"WHERE {config}.{function}({column})")
    return spark.table(f"{config}.visible")


FUNCTION_COLUMNS = {"fn_lob_filter": "lob_code", "fn_legal_entity_filter": "company_code",
                    "fn_asset_filter": "asset_id"}


def function_filter_lob(spark, sf_dir):
    return _by_function(spark, sf_dir, "fn_lob_filter", material_on_time_all(spark, sf_dir),
                        {"lob_group_map": _lob(spark)})


def function_filter_entity(spark, sf_dir):
    return _by_function(spark, sf_dir, "fn_legal_entity_filter", _spend_with_nulls(spark, sf_dir),
                        {"legal_entity_group_map": fx.legal_entity_group_map(_tables(spark, sf_dir))})


def function_filter_asset(spark, sf_dir):
    return _by_function(spark, sf_dir, "fn_asset_filter", logistics_on_time(spark, sf_dir),
                        {"asset_group_map": fx.asset_group_map(_tables(spark, sf_dir))})


# ── facts from what changed ─────────────────────────────────────────────────

def _changes(spark, label: str, graph, build, before: dict, after: dict,
             compared: dict | None = None) -> DataFrame:
    """A fact loaded from the inputs ``before`` and then brought up to date with
    ``after`` by the rows that differ in each. ``compared`` has the (before, after)
    of inputs that are partitioned for that comparison."""
    sink = SnapshotSink(spark, _database(spark, label))
    log = RunLog(sink)
    jobs.run_fact_changes_job(spark, sink, log, label, build, graph, before, {})
    sides = {n: (before[n], after[n]) for n in after} | (compared or {})
    changes = {n: changed_rows(*sides[n]) for n in after}
    jobs.run_fact_changes_job(spark, sink, log, label, build, graph, after, changes)
    return sink.read(label)


def fact_mot_from_changes(spark, sf_dir):
    """JN-1..JN-5, SNK-12: since the fact was loaded, late shipments moved
    headers, urgent orders got another date or were confirmed, small materials
    another division, and items were added, removed and corrected."""
    t = _tables(spark, sf_dir)
    after = {"likp": fx.delivery_header(t), "lips": fx.delivery_items(t),
             "vbak": fx.sales_orders(t), "mara": fx.materials(t)}
    li, orders, part = t("lineitem"), t("orders"), t("part")
    late, confirmed = _ts(li, "l_shipdate", "2001-06-01"), _ts(orders, "o_orderdate", "2001-05-01")

    def earlier(items):
        # the last line of large returns is new, three lines of others are gone: each
        # item's earlier rows, made without a filter that would divide the shuffle
        posnr, lfimg = F.col("POSNR"), F.col("LFIMG")
        rows = F.array(
            F.struct(((posnr < 7) | (lfimg < 40)).alias("kept"), posnr.alias("POSNR"),
                     F.when(lfimg == 13, lfimg + 1).otherwise(lfimg).alias("LFIMG")),
            F.struct(((posnr == 1) & (lfimg > 48)).alias("kept"), F.lit(8).alias("POSNR"), lfimg.alias("LFIMG")))
        return (items.withColumn("__row", F.explode(F.filter(rows, lambda r: r["kept"])))
                .withColumns({"POSNR": F.col("__row.POSNR"), "LFIMG": F.col("__row.LFIMG")}).drop("__row"))

    items = fx.delivery_items(t, compared=True)
    before = {
        "likp": after["likp"].withColumn("WADAT_IST", F.least("WADAT_IST", late)),
        "lips": earlier(after["lips"]),
        "vbak": orders.where(F.col("o_orderstatus") != F.lit("P"))
                .where((F.col("o_orderdate") < confirmed) | (F.col("o_orderpriority") != F.lit("5-LOW")))
                .select(F.col("o_orderkey").alias("VBELN"),
                        F.when(F.col("o_orderpriority") == F.lit("1-URGENT"), F.least("o_orderdate", confirmed))
                        .otherwise(F.col("o_orderdate")).alias("VDATU")),
        "mara": after["mara"].join(part.select(F.col("p_partkey").alias("MATNR"), "p_size"), "MATNR")
                .select("MATNR", F.when(F.col("p_size") <= 2, F.lit("02")).otherwise(F.col("SPART")).alias("SPART")),
    }

    def build(i):
        return facts.material_on_time_fact(i["likp"], i["lips"], i["vbak"], i["mara"], exclude_unknown=False)

    return _changes(spark, "fact_mot", facts.MOT_GRAPH, build, before, after, {"lips": (earlier(items), items)})


def fact_spend_from_changes(spark, sf_dir):
    """The same for PO lines and their contracts: lines repriced, removed and
    moved to another company, contracts signed, ended and of another type."""
    t = _tables(spark, sf_dir)
    after = {"arb_spend_lines": fx.spend_lines(t), "clm_contract_lines": fx.contract_lines(t)}
    orders = t("orders")
    recent = _ts(orders, "o_orderdate", "2001-03-01")
    signed = orders.where((F.col("o_orderstatus") == F.lit("F")) & (F.col("o_orderdate") < recent))
    ended = orders.where((F.col("o_orderstatus") == F.lit("O")) & (F.col("o_orderdate") >= recent))

    def earlier(lines):
        return lines.withColumns({
            "BUKRS": F.when(F.col("MENGE") == 7, F.lit(None)).otherwise(F.col("BUKRS")),
            "NETWR": F.when(F.col("MENGE") == 9, F.col("NETWR") * 2).otherwise(F.col("NETWR"))}) \
            .unionByName(lines.where("MENGE = 50").withColumn("EBELP", F.lit(8)))

    lines = fx.spend_lines(t, compared=True)
    before = {
        "arb_spend_lines": earlier(after["arb_spend_lines"]),
        "clm_contract_lines": signed.unionByName(ended).select(
            F.col("o_orderkey").alias("po_number"),
            F.concat(F.lit("CT-"), F.col("o_orderkey").cast("string")).alias("contract_id"),
            F.when(F.col("o_orderpriority") == F.lit("2-HIGH"), F.lit("3-MEDIUM"))
            .otherwise(F.col("o_orderpriority")).alias("contract_type")),
    }

    def build(i):
        return facts.spend_fact(i["arb_spend_lines"], i["clm_contract_lines"])

    return _changes(spark, "fact_spend", facts.SPEND_GRAPH, build, before, after,
                    {"arb_spend_lines": (earlier(lines), lines)})


def _spend_with_nulls(spark, sf_dir):
    return facts.spend_lines_renamed(fx.spend_lines(_tables(spark, sf_dir)),
                                     keep_null_company=True)


def row_filter_null_code(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return security.row_filter(_spend_with_nulls(spark, sf_dir), "company_code",
                               fx.legal_entity_group_map(t), fx.membership(spark), "eve")


def row_filter_null_code_global(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return security.row_filter(_spend_with_nulls(spark, sf_dir), "company_code",
                               fx.legal_entity_group_map(t), fx.membership(spark), "gil")


MASK_GROUPS = ["uat-business-owners"]


def _masked_mirror(spark, sf_dir, groups: list[str]) -> DataFrame:
    """DCL-3, SEC-4: mirror the customers behind a masking view (a text and a
    numeric column) and read it as the session's user, a member of ``groups``."""
    source, target = _database(spark, "euh"), _database(spark, "mirror")
    _tables(spark, sf_dir)("customer").write.saveAsTable(f"{source}.customer")
    me = security.current_principal(spark)
    fx.config_frame(spark, [(me, g) for g in groups], "principal string, group_id string") \
        .write.saveAsTable(f"{source}.group_membership")
    sink = SnapshotSink(spark, target)
    mirror_table(spark, f"{source}.customer", sink, "customer", deep=True,
                 masked=["c_name", "c_acctbal"], allowed_groups=MASK_GROUPS,
                 membership_table=f"{source}.group_membership")
    return spark.table(sink.public_name("customer"))


def mask_member(spark, sf_dir):
    return _masked_mirror(spark, sf_dir, MASK_GROUPS)


def mask_non_member(spark, sf_dir):
    return _masked_mirror(spark, sf_dir, ["grp-lob-up"])


# ── audit, control, checks ──────────────────────────────────────────────────

AUDITED = (("customer", None), ("orders", "o_orderdate"), ("part", None), ("supplier", None),
           ("lineitem", "l_shipdate"), ("events", "ts"))


def run_audit_totals(spark, sf_dir):
    """AGG-1/AGG-2, SNK-5: harmonise six tables, then their run-log rows and
    the run's total. Counts come from the observed writes."""
    sink = SnapshotSink(spark, _database(spark, "audit"))
    log = RunLog(sink)
    jobs.run_harmonise_job(spark, _tables(spark, sf_dir), sink, log,
                           [TableSpec(n, n, (), w) for n, w in AUDITED], "BLP", "full",
                           max_parallel=3)
    rows = log.read()
    total = run_totals(rows).select(F.lit("TOTAL").alias("target"), "status", "rows")
    per_table = rows.select(F.substring_index("target", ".", -1).alias("target"), "status",
                            F.col("rows").cast("bigint").alias("rows"))
    return per_table.unionByName(total)


def harmonise_then_delta(spark, sf_dir):
    """DCL-2, SNK-4: a first load and a delta from the stored mark, both
    tables in parallel; the tables and their marks as stored."""
    t = _tables(spark, sf_dir)
    sink, state = (SnapshotSink(spark, _database(spark, n)) for n in ("euh", "state"))
    specs = [TableSpec("orders", "orders", ("o_orderkey",), "o_orderdate", watermark_format="yyyyMMdd"),
             TableSpec("events", "events", ("event_id",), "ts")]
    early = {"orders": "1999-01-01", "events": "2024-01-10"}

    def first(name):
        df, col = t(name), {s.source: s.watermark_column for s in specs}[name]
        return df.where(F.col(col) < _ts(df, col, early[name]))

    for read in (first, t):
        jobs.run_harmonise_job(spark, read, sink, RunLog(sink), specs, "BLP", "delta",
                               max_parallel=2, state=state)
    out = None
    for sp in specs:
        rows = sink.read(sp.target).groupBy("_load_type").agg(
            F.count(F.lit(1)).alias("rows"), F.max(sp.watermark_column).cast("string").alias("newest"))
        rows = rows.select(F.lit(sp.target).alias("target"), "_load_type", "rows", "newest")
        out = rows if out is None else out.unionByName(rows)
    marks = state.read("orchestration_config").select(
        F.col("table_name").alias("target"), F.lit("mark").alias("_load_type"),
        F.lit(None).cast("bigint").alias("rows"), F.col("watermark_value").alias("newest"))
    return out.unionByName(marks)


# ── stored loads ────────────────────────────────────────────────────────────

def _full_then_delta(sink, base: DataFrame, batch: DataFrame) -> DataFrame:
    jobs.load(sink, base, "orders", ["o_orderkey"], "full")
    jobs.load(sink, batch, "orders", ["o_orderkey"], "delta", evolve=True)
    return sink.read("orders")


def _dated(df: DataFrame) -> DataFrame:
    """Partition value: the year, NULL for pending orders."""
    return df.withColumn("o_year", F.when(F.col("o_orderstatus") != F.lit("P"), F.year("o_orderdate")))


def load_full_then_delta_partitioned(spark, sf_dir):
    """SNK-1/2 stored: a full load and a delta that brings a column, moves
    orders between partitions and touches the NULL partition."""
    orders = _tables(spark, sf_dir)("orders")
    base = _dated(orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", "2000-01-01")))
    batch = _dated(_orders_batch(orders).withColumn(
        "o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 400 DAYS")).withColumn(
        "o_batch", F.lit("b1")))
    return _full_then_delta(PartitionedSink(spark, _database(spark, "part"), "o_year"), base, batch)


def load_full_then_delta_snapshot(spark, sf_dir):
    orders = _tables(spark, sf_dir)("orders")
    base = orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", "2000-01-01"))
    batch = _orders_batch(orders).withColumn("o_batch", F.lit("b1"))
    return _full_then_delta(SnapshotSink(spark, _database(spark, "snap")), base, batch)


def load_recent_orders_partitioned(spark, sf_dir):
    """SNK-2 stored, keys that never move: a small batch of the newest keys
    rewrites only their ranges."""
    orders = _tables(spark, sf_dir)("orders").withColumn("okr", key_range("o_orderkey", 2000))
    sink = PartitionedSink(spark, _database(spark, "ranges"), "okr", stable_keys=True)
    jobs.load(sink, orders, "orders", ["o_orderkey"], "full")
    recent = orders.where(F.col("o_orderdate") > _ts(orders, "o_orderdate", "2001-06-01"))
    jobs.load(sink, recent.withColumn("o_orderstatus", F.lit("X")), "orders", ["o_orderkey"], "delta")
    return sink.read("orders")


def _entity_map_view(df: DataFrame) -> DataFrame:
    return df.select("company_code", "entity_name", "entra_group_id", "scope", "is_active",
                     "updated_by", F.col("created_at").isNotNull().alias("has_created_at"))


def seed_entity_map(spark, sf_dir):
    return _entity_map_view(fx.legal_entity_group_map(_tables(spark, sf_dir)))


def soft_delete_entity_map(spark, sf_dir):
    t = _tables(spark, sf_dir)
    region = t("region").where(F.col("r_name") == F.lit("EUROPE")).select("r_regionkey")
    europe_groups = region.select(
        F.concat(F.lit("grp-entity-r"), F.col("r_regionkey").cast("string")).alias("g"))
    m = fx.legal_entity_group_map(t)
    m = m.join(europe_groups.withColumn("__hit", F.lit(True)),
               F.col("entra_group_id") == F.col("g"), "left").drop("g")
    m = control.soft_delete(m, F.col("__hit"), by="rollback-europe",
                            at=F.lit(SOFT_DELETE_AT).cast("timestamp")).drop("__hit")
    return m.select("company_code", "entity_name", "entra_group_id", "scope", "is_active",
                    "updated_by",
                    F.when(~F.col("is_active"), F.col("updated_at").cast("string"))
                    .alias("deactivated_at"))


def null_violations(spark, sf_dir):
    return checks.null_counts(_spend_with_nulls(spark, sf_dir),
                              facts.SPEND_KEYS + ["company_code", "vendor_id"])


def quarantine_orders(spark, sf_dir):
    """CHK-3, SNK-6: three loads of orders of which some break the rules; the
    last allows no reject, so it fails. What is stored of each: accepted rows,
    rejected rows with their reasons, and the run log."""
    orders = _dated(_tables(spark, sf_dir)("orders"))
    sink = SnapshotSink(spark, _database(spark, "euh"))
    log = RunLog(SnapshotSink(spark, _database(spark, "state")))
    rules = {"price below 30000": F.col("o_totalprice") >= 30000,
             "low priority in 1999": (F.col("o_orderpriority") != F.lit("5-LOW")) | (F.col("o_year") != 1999)}

    def run(run_id: str, df: DataFrame, load_type: str, share: float = 1.0) -> None:
        jobs.run_quarantined_load(spark, sink, log, "orders", lambda: df, ["o_orderkey"], ["o_year"], rules,
                                  load_type, share, run_id=run_id)

    run("first", orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", "2000-01-01")), "full")
    run("second", orders, "delta")
    try:
        run("third", orders, "delta", 0.0)
    except jobs.TooManyRejects:
        pass  # it is in the run log

    def rows(df, part, run_id=F.lit(None), key=F.lit(None), detail=F.lit(None), n=F.lit(None)) -> DataFrame:
        return df.select(F.lit(part).alias("part"), run_id.cast("string").alias("run_id"),
                         key.cast("bigint").alias("o_orderkey"), detail.cast("string").alias("detail"),
                         n.cast("bigint").alias("rows"))

    return (rows(sink.read("orders"), "accepted", key=F.col("o_orderkey"))
            .unionByName(rows(log.sink.read(jobs.QUARANTINE), "rejected", F.col("run_id"),
                              F.get_json_object("record", "$.o_orderkey"), F.array_join("reasons", "; ")))
            .unionByName(rows(log.read(), "audit", F.col("run_id"), detail=F.col("status"), n=F.col("rows"))))


def reconcile_orders(spark, sf_dir):
    """AGG-1/AGG-2, DCL-3: a copy of the orders in which some were lost, doubled,
    altered and added, compared month by month; then the keys and the run log."""
    orders = _tables(spark, sf_dir)("orders")
    month = F.date_format("o_orderdate", "yyyy-MM")
    copy = (orders.where((month != F.lit("1999-03")) | (F.col("o_orderstatus") != F.lit("O")))
            .withColumn("o_totalprice", F.when((month == F.lit("1998-07")) & (F.col("o_orderstatus") == F.lit("F")),
                                               F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))))
    copy = copy.unionByName(orders.where(month == F.lit("2000-05"))).unionByName(
        orders.where(month == F.lit("2000-02")).withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    source, mirror = (SnapshotSink(spark, _database(spark, n)) for n in ("euh", "mirror"))
    source.publish(orders, "orders")
    mirror.publish(copy, "orders")
    log = RunLog(SnapshotSink(spark, _database(spark, "state")))
    found = jobs.run_reconcile_job(spark, log, "orders", source.read("orders"), mirror.read("orders"),
                                   ["o_orderkey"], month)
    audit = log.read().select(F.lit(None).cast("bigint").alias("o_orderkey"), F.col("status").alias("problem"),
                              F.lit(None).cast("bigint").alias("source_rows"), F.col("rows").alias("target_rows"))
    return found.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint")).unionByName(audit)


def clustered_reads(spark, sf_dir):
    """SRC-1, FLT-1: orders published along a curve over (watermark, key); a read
    above a mark and a read of a key range, each of a part of the row groups."""
    orders = _tables(spark, sf_dir)("orders").withColumn("o_day", F.to_date("o_orderdate"))
    sink = SnapshotSink(spark, _database(spark, "euh"), cluster_by=("o_day", "o_orderkey"))
    jobs.load(sink, orders, "orders", ["o_orderkey"], "full")
    stored = sink.read("orders")
    return (watermark_filter(stored, "o_day", "2000-10-01").withColumn("read", F.lit("delta"))
            .unionByName(stored.where(F.col("o_orderkey").between(300, 500)).withColumn("read", F.lit("keys"))))


def pinned_clone(spark, sf_dir):
    """DCL-4: a shallow clone of a source that was published twice since."""
    customer = _tables(spark, sf_dir)("customer")
    source, target = (SnapshotSink(spark, _database(spark, n), keep=1) for n in ("euh", "uat"))
    source.publish(customer.where(F.col("c_acctbal") > 0), "customer")
    mirror_table(spark, source.base_view("customer"), target, "customer", deep=False, pin_from=source)
    source.publish(customer.where(F.col("c_acctbal") <= 0), "customer")
    source.publish(customer, "customer")
    return spark.table(target.public_name("customer"))


def events_late_twice(spark, sf_dir):
    """FLT-1, SNK-12: events landed in three drops, each loaded as a stream with
    three days of lateness: most of them, then late ones with copies of stored
    ones, then some older than the watermark and some without an event time.
    The table, and the run log's totals."""
    events = _tables(spark, sf_dir)("events")
    landing = f"{checkpoint_dir(spark).rstrip('/')}/landing_{uuid.uuid4().hex[:12]}"
    untimed = F.col("event_type") == F.lit("error")
    day = F.dayofmonth("ts")
    drops = {"late": (day > 18) & (day <= 20) & (F.col("user_id") % 3 == 0),
             "old": (day <= 10) & (F.col("event_id") % 4 == 0)}
    first = events.where((day <= 20) & ~untimed & ~drops["late"] & ~drops["old"])
    copies = first.where(day > 17)
    log = RunLog(SnapshotSink(spark, _database(spark, "state")))
    sink = SnapshotSink(spark, _database(spark, "euh"))
    spec = TableSpec("events", "events", ("event_id",))
    for drop in (first.unionByName(copies),
                 events.where(drops["late"] & ~untimed).unionByName(copies),
                 events.where(drops["old"] | (day > 20) | untimed).withColumn(
                     "ts", F.when(~untimed, F.col("ts"))).unionByName(copies)):
        drop.write.mode("append").parquet(landing)
        load_events(spark, landing, spec, "ts", "3 days", sink, "WEB", schema=events.schema, log=log,
                    checkpoint=f"{landing}_state")
    totals = log.read().select(F.lit(None).cast("bigint").alias("event_id"),
                               F.lit(None).cast(events.schema["ts"].dataType).alias("ts"),
                               F.when(F.col("run_id").endswith(":late"), "recovered").otherwise("appended").alias("event_type"),
                               F.col("rows"))
    stored = sink.read("events").select("event_id", "ts", "event_type", F.lit(None).cast("bigint").alias("rows"))
    return stored.unionByName(
        totals.groupBy("event_id", "ts", "event_type").agg(F.sum("rows").alias("rows")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "material_on_time": material_on_time,
    "material_on_time_all": material_on_time_all,
    "material_on_time_hot": material_on_time_hot,
    "secured_material_on_time": secured_material_on_time,
    "spend_rename": spend_rename,
    "spend_with_contract": spend_with_contract,
    "spend_without_contract": spend_without_contract,
    "spend_latest_contract": spend_latest_contract,
    "logistics_on_time": logistics_on_time,
    "fact_mot_from_changes": fact_mot_from_changes,
    "fact_spend_from_changes": fact_spend_from_changes,
    "watermark_delta": watermark_delta,
    "watermark_compact": watermark_compact,
    "watermark_events": watermark_events,
    "high_water_marks": high_water_marks,
    "harmonise_passthrough": harmonise_passthrough,
    "harmonise_renamed": harmonise_renamed,
    "first_load_then_merge": first_load_then_merge,
    "upsert_single_key": upsert_single_key,
    "upsert_composite_key": upsert_composite_key,
    "upsert_null_keys": upsert_null_keys,
    "upsert_hot_target": upsert_hot_target,
    "upsert_evolve": upsert_evolve,
    "upsert_events_late": upsert_events_late,
    "row_filter_lob": row_filter_lob,
    "row_filter_entity": row_filter_entity,
    "row_filter_asset": row_filter_asset,
    "row_filter_global": row_filter_global,
    "visible_rows_per_principal": visible_rows_per_principal,
    "published_fact_mot": published_fact_mot,
    "published_fact_spend": published_fact_spend,
    "published_fact_logistics": published_fact_logistics,
    "pruned_fact_mot": pruned_fact_mot,
    "pruned_fact_spend": pruned_fact_spend,
    "pruned_fact_spend_global": pruned_fact_spend_global,
    "function_filter_lob": function_filter_lob,
    "function_filter_entity": function_filter_entity,
    "function_filter_asset": function_filter_asset,
    "row_filter_null_code": row_filter_null_code,
    "row_filter_null_code_global": row_filter_null_code_global,
    "mask_member": mask_member,
    "mask_non_member": mask_non_member,
    "run_audit_totals": run_audit_totals,
    "harmonise_then_delta": harmonise_then_delta,
    "load_full_then_delta_partitioned": load_full_then_delta_partitioned,
    "load_full_then_delta_snapshot": load_full_then_delta_snapshot,
    "load_recent_orders_partitioned": load_recent_orders_partitioned,
    "seed_entity_map": seed_entity_map,
    "soft_delete_entity_map": soft_delete_entity_map,
    "null_violations": null_violations,
    "quarantine_orders": quarantine_orders,
    "reconcile_orders": reconcile_orders,
    "clustered_reads": clustered_reads,
    "pinned_clone": pinned_clone,
    "events_late_twice": events_late_twice,
}
