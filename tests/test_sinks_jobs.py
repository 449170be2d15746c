import os
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators.harmonise import BLP_TABLES, TableSpec
from strata.operators.security import current_principal
from strata.plans import facts, jobs
from strata.sinks import control_tables as ct
from strata.sinks.audit import RunLog, run_totals
from strata.sinks.publish import SnapshotSink
from strata.sources import fixtures as fx
from strata.sources.registry import bindings_frame

from conftest import SF001


def db():
    return "t_" + uuid.uuid4().hex[:8]


def test_snapshot_publish_repoint_append_and_expire(spark):
    sink = SnapshotSink(spark, db(), keep=2)
    assert not sink.exists("t")
    v1 = sink.publish(spark.createDataFrame([(1, "a")], "k long, v string"), "t", keys=["k"])
    v2 = sink.publish(sink.read("t").withColumn("v", F.lit("b")), "t", keys=["k"])
    assert (v1, v2) == (1, 2) and [r.v for r in sink.read("t").collect()] == ["b"]
    sink.append(spark.createDataFrame([(2, "c")], "k long, v string"), "t")
    assert sink.read("t").count() == 2
    sink.publish(sink.read("t"), "t")
    assert sink.versions("t") == [2, 3]  # v1 expired
    # a failed write leaves the pointer and the current snapshot untouched
    bad = sink.read("t").withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception):
        sink.publish(bad, "t")
    assert sink.versions("t") == [2, 3] and sink.current_table("t").endswith("__v3")
    assert sink.read("t").count() == 2


def test_bucketed_snapshot_lets_large_upsert_skip_target_shuffle(spark):
    from strata.operators.upsert import upsert
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sink = SnapshotSink(spark, db(), bucket_by_keys=True, buckets=8)
        sink.publish(spark.range(0, 1000).select(F.col("id").alias("k"),
                                                 F.lit("a").alias("v")), "t", keys=["k"])
        src = spark.range(500, 1500).select(F.col("id").alias("k"), F.lit("b").alias("v"))
        plan = upsert(sink.read("t"), src, ["k"], broadcast_limit=0) \
            ._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scans = [i for i, ln in enumerate(lines) if "FileScan" in ln and "__v1" in ln]
        assert scans and all("Bucketed: true" in lines[i] for i in scans)
        for i in scans:  # no exchange directly above a target scan
            assert not any("Exchange" in ln for ln in lines[max(0, i - 3):i])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_run_log_success_and_failure_text(spark):
    sink = SnapshotSink(spark, db())
    log = RunLog(sink)
    log.write("r1", "x.t", "full", 10, "success")
    nasty = "it's a \\ path; -- not a comment"
    with pytest.raises(RuntimeError):
        jobs.audited(log, "r2", "x.t", "delta", lambda: (_ for _ in ()).throw(RuntimeError(nasty)))
    rows = {r.run_id: r for r in log.read().collect()}
    assert rows["r1"].rows == 10 and rows["r1"].status == "success"
    assert rows["r2"].status == "failed" and rows["r2"].error == nasty and rows["r2"].rows == 0
    totals = {r.run_id: r.rows for r in run_totals(log.read()).collect()}
    assert totals == {"r1": 10, "r2": 0}


def test_migrations_ledger_retry_and_rollback(spark):
    sink = SnapshotSink(spark, db())
    migs = ct.platform_migrations()
    boom = ct.Migration(6, "0006_broken.sql", (lambda s: 1 / 0,))
    with pytest.raises(ZeroDivisionError):
        ct.apply_migrations(sink, migs + [boom], "dev")
    ledger = sink.read("migration_history")
    assert {r.status for r in ledger.where(F.col("migration_id") == "0006_broken.sql")
            .collect()} == {"failed"}
    lob = sink.read("lob_group_map")
    assert sorted(r.lob_code for r in lob.collect()) == ["DS", "GF", "GLOBAL", "RF", "UP"]
    assert all(r.is_active for r in lob.collect())  # rollback is never auto-applied
    # second run: only the failed one is pending; fixed version succeeds
    fixed = ct.Migration(6, "0006_broken.sql", ())
    assert ct.apply_migrations(sink, migs + [fixed], "dev") == ["0006_broken.sql"]
    assert ct.apply_migrations(sink, migs + [fixed], "dev") == []
    # other environment starts from scratch
    assert len(ct.apply_migrations(sink, migs + [fixed], "uat")) == 6
    # explicit rollback: soft delete keeps the row
    rollback = [m for m in migs if m.migration_id.endswith("_rollback.sql")][0]
    for action in rollback.actions:
        action(sink)
    rf = sink.read("lob_group_map").where(F.col("lob_code") == "RF").collect()
    assert len(rf) == 2 and {r.is_active for r in rf} == {False}
    assert {r.updated_by for r in rf} == {"rollback-0005"}


def test_not_null_enforced_on_seed(spark):
    sink = SnapshotSink(spark, db())
    with pytest.raises(Exception):
        ct.insert_rows(sink, "lob_group_map", [("UP", None, "g", "LOB")])


def test_fact_job_full_then_delta_with_secured_view(spark):
    sink = SnapshotSink(spark, db())
    cfg = SnapshotSink(spark, db())
    log = RunLog(sink)
    me = current_principal(spark)
    fx.lob_group_map(spark).write.saveAsTable(f"{cfg.database}.lob_group_map")
    spark.createDataFrame([(me, "grp-lob-up")], "principal string, group_id string") \
        .write.saveAsTable(f"{cfg.database}.group_membership")
    security = jobs.SecurityConfig(bindings_frame(spark), cfg.database, schema_name="plan")
    t = fx.TestTables(spark, SF001)

    def build():
        return facts.material_on_time_fact(fx.delivery_header(t), fx.delivery_items(t),
                                           fx.sales_orders(t), fx.materials(t))

    n1 = jobs.run_fact_job(spark, sink, log, "fact_mot", build, facts.MOT_KEYS, "delta",
                           security=security)
    base = sink.read("fact_mot")
    assert n1 == build().count() == base.count() > 0
    public = spark.table(sink.public_name("fact_mot"))
    assert {r.lob_code for r in public.select("lob_code").distinct().collect()} == {"UP"}
    # The test data repeats (l_orderkey, l_linenumber): a delta MERGE on the
    # delivery keys must be rejected, logged as failed, and publish nothing.
    from strata.operators.upsert import MergeKeyError
    with pytest.raises(MergeKeyError):
        jobs.run_fact_job(spark, sink, log, "fact_mot", build, facts.MOT_KEYS, "delta",
                          security=security)
    assert sink.versions("fact_mot") == [1]
    statuses = [(r.load_type, r.status) for r in log.read().orderBy("logged_at").collect()]
    assert statuses == [("full", "success"), ("delta", "failed")]

    def broken():
        return build().drop("lob_code")

    with pytest.raises(Exception):
        jobs.run_fact_job(spark, sink, log, "fact_mot", broken, facts.MOT_KEYS, "full",
                          security=security)
    assert log.read().where(F.col("status") == "failed").count() == 2
    assert sink.versions("fact_mot") == [1]


def test_fact_job_delta_merge_on_unique_key(spark):
    sink = SnapshotSink(spark, db())
    log = RunLog(sink)
    t = fx.TestTables(spark, SF001)

    def build(status_from="O"):
        return t("orders").select(
            "o_orderkey", F.when(F.col("o_orderstatus") == status_from, "F")
            .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "o_totalprice")

    n1 = jobs.run_fact_job(spark, sink, log, "orders_fact", build, ["o_orderkey"], "delta")
    n2 = jobs.run_fact_job(spark, sink, log, "orders_fact", lambda: build("P"),
                           ["o_orderkey"], "delta")
    assert n1 == n2 == t("orders").count() == sink.read("orders_fact").count()
    assert sink.read("orders_fact").where(F.col("o_orderstatus") == "P").count() == 0
    assert [r.load_type for r in log.read().orderBy("logged_at").collect()] == ["full", "delta"]
    # the public name is a plain view when the table is not registered
    assert spark.table(sink.public_name("orders_fact")).count() == n1


def test_harmonise_job_watermark_and_audit(spark):
    sink = SnapshotSink(spark, db())
    log = RunLog(sink)
    t = fx.TestTables(spark, SF001)
    specs = [TableSpec("orders", "orders_h", ("o_orderkey",), "o_orderdate"),
             TableSpec("customer", "customer_h", ("c_custkey",))]
    total = jobs.run_harmonise_job(spark, t, sink, log, specs, "BLP", "delta",
                                   watermarks={"orders_h": "2000-01-01"})
    assert total == t("orders").count() + t("customer").count()  # first load: all rows
    again = jobs.run_harmonise_job(spark, t, sink, log, specs, "BLP", "delta",
                                   watermarks={"orders_h": "2000-01-01"})
    newer = t("orders").where(F.col("o_orderdate") > F.lit("2000-01-01").cast("timestamp_ntz"))
    assert again == newer.count() + t("customer").count()
    assert sink.read("orders_h").count() == t("orders").count()
    assert log.read().count() == 4
    types = {r._load_type for r in sink.read("orders_h").select("_load_type").distinct().collect()}
    assert types == {"full", "delta"}


def test_harmonise_job_parallel(spark):
    sink = SnapshotSink(spark, db())
    log = RunLog(sink)
    log.ensure()
    t = fx.TestTables(spark, SF001)
    specs = [TableSpec(n, n + "_h", (k,)) for n, k in
             (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey"),
              ("supplier", "s_suppkey"))]
    total = jobs.run_harmonise_job(spark, t, sink, log, specs, "BLP", "full", max_parallel=4)
    assert total == sum(t(n).count() for n in ("orders", "customer", "part", "supplier"))
    assert log.read().count() == 4
    bad = specs + [TableSpec("nope", "nope_h", ("k",))]
    with pytest.raises(Exception):
        jobs.run_harmonise_job(spark, t, sink, log, bad, "BLP", "full", max_parallel=4)
    assert log.read().where(F.col("status") == "failed").count() == 1
    assert log.read().where(F.col("status") == "success").count() == 8


def test_orchestration_config_watermark_and_due_list(spark):
    from strata.operators.control import due_list
    from strata.operators.harmonise import high_water_mark
    sink = SnapshotSink(spark, db())
    cols = ["table_id", "catalog_name", "schema_name", "table_name", "load_type", "is_active",
            "dependency_tables", "watermark_column", "run_order"]
    ct.insert_rows(sink, "orchestration_config", [
        ("euh.orders", "c", "euh", "orders", "delta", True, None, "o_orderdate", 1),
        ("plan.fact_mot", "c", "plan", "fact_mot", "delta", True, ["euh.orders"], None, 2),
    ], cols)
    cfg = sink.read("orchestration_config")
    assert {r.table_id: r.first_load_complete for r in cfg.collect()} == \
        {"euh.orders": False, "plan.fact_mot": False}  # DEFAULT false applied
    assert [(r.table_id, r.ready) for r in due_list(cfg).collect()] == \
        [("euh.orders", True), ("plan.fact_mot", False)]
    orders = fx.TestTables(spark, SF001)("orders")
    hwm = high_water_mark(orders, "o_orderdate").first()["watermark_value"]
    ct.record_watermark(sink, "euh.orders", hwm)
    cfg = sink.read("orchestration_config")
    row = cfg.where(F.col("table_id") == "euh.orders").first()
    assert row.watermark_value == hwm and row.first_load_complete is True
    assert [(r.table_id, r.ready) for r in due_list(cfg).collect()] == \
        [("euh.orders", True), ("plan.fact_mot", True)]


def test_binding_failure_leaves_no_unfiltered_public_view(spark):
    sink = SnapshotSink(spark, db())
    log = RunLog(sink)
    empty_cfg = SnapshotSink(spark, db())  # no map tables, no membership
    security = jobs.SecurityConfig(bindings_frame(spark), empty_cfg.database,
                                   schema_name="plan")
    t = fx.TestTables(spark, SF001)

    def build():
        return facts.material_on_time_fact(fx.delivery_header(t), fx.delivery_items(t),
                                           fx.sales_orders(t), fx.materials(t))

    with pytest.raises(RuntimeError, match="security table"):
        jobs.run_fact_job(spark, sink, log, "fact_mot", build, facts.MOT_KEYS, "full",
                          security=security)
    assert not spark.catalog.tableExists(sink.public_name("fact_mot"))
    assert not sink.exists("fact_mot")  # nothing was written
    assert [r.status for r in log.read().collect()] == ["failed"]


def test_publish_survives_task_retries(tmp_path):
    """Tasks fail on their first attempt; the snapshot still holds every row once."""
    import subprocess
    import sys
    import textwrap
    script = tmp_path / "retry.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))!r})
        from pyspark.sql import SparkSession, functions as F, types as T
        from pyspark import TaskContext
        from strata.sinks.publish import SnapshotSink
        spark = (SparkSession.builder.master("local[4,3]")
                 .config("spark.ui.enabled", "false")
                 .config("spark.sql.warehouse.dir", {str(tmp_path / 'wh')!r}).getOrCreate())

        @F.udf(T.LongType())
        def flaky(x):
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("simulated executor loss")
            return x

        sink = SnapshotSink(spark, "retry_db")
        df = spark.range(0, 20000, numPartitions=8).select(flaky("id").alias("k"))
        sink.publish(df, "t")
        out = sink.read("t")
        assert out.count() == 20000, out.count()
        assert out.distinct().count() == 20000
        print("RETRY_OK")
    """))
    res = subprocess.run([sys.executable, str(script)], capture_output=True, text=True,
                         timeout=600)
    assert "RETRY_OK" in res.stdout, res.stderr[-2000:]


def test_append_aligns_columns_by_name(spark):
    sink = SnapshotSink(spark, db())
    sink.publish(spark.createDataFrame([(1, "a")], "k long, v string"), "t")
    sink.append(spark.createDataFrame([("b", 2)], "v string, k long"), "t")
    assert sorted(map(tuple, sink.read("t").collect())) == [(1, "a"), (2, "b")]


def test_incremental_curated_input_since_last_success(spark):
    import time
    from strata.operators.harmonise import harmonise, loaded_since
    from strata.sinks.audit import last_success
    sink = SnapshotSink(spark, db())
    log = RunLog(sink)
    t = fx.TestTables(spark, SF001)
    spec = TableSpec("orders", "orders_h", ("o_orderkey",))
    df, _ = harmonise(t("orders"), spec, "BLP", "full")
    sink.publish(df, "orders_h")
    log.ensure()
    assert last_success(log.read(), "x.fact") is None
    log.write("r1", "x.fact", "full", 1, "success")
    since = last_success(log.read(), "x.fact")
    assert loaded_since(sink.read("orders_h"), since).count() == 0  # nothing newer
    time.sleep(1.1)
    newer, _ = harmonise(t("orders").limit(5), spec, "BLP", "delta")
    sink.append(newer, "orders_h")
    assert loaded_since(sink.read("orders_h"), since).count() == 5
    assert loaded_since(sink.read("orders_h"), None).count() == t("orders").count() + 5


def test_run_log_compacts_small_files(spark):
    sink = SnapshotSink(spark, db())
    log = RunLog(sink, compact_above=3)
    for i in range(5):
        log.write(f"r{i}", "x.t", "full", i, "success")
    assert sink.file_count("pipeline_run_log") <= 3
    assert sorted(r.rows for r in log.read().collect()) == [0, 1, 2, 3, 4]


def test_harmonise_job_keeps_watermarks_in_orchestration_config(spark):
    sink = SnapshotSink(spark, db())
    state = SnapshotSink(spark, db())
    log = RunLog(sink)
    t = fx.TestTables(spark, SF001)
    orders = t("orders")
    early = orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    landing = {"orders": early}
    spec = TableSpec("orders", "orders_h", ("o_orderkey",), "o_orderdate")
    n1 = jobs.run_harmonise_job(spark, lambda n: landing[n], sink, log, [spec], "BLP",
                                "delta", state=state)
    assert n1 == early.count()
    cfg = state.read("orchestration_config").collect()
    assert len(cfg) == 1 and cfg[0].first_load_complete
    mark = cfg[0].watermark_value
    assert mark == early.agg(F.max("o_orderdate").cast("string")).first()[0]
    # next run: all orders land; only rows newer than the stored mark are read
    landing["orders"] = orders
    n2 = jobs.run_harmonise_job(spark, lambda n: landing[n], sink, log, [spec], "BLP",
                                "delta", state=state)
    newer = orders.where(F.col("o_orderdate") > F.lit(mark).cast("timestamp_ntz")).count()
    assert n2 == newer and sink.read("orders_h").count() == orders.count()
    assert state.read("orchestration_config").first().watermark_value == \
        orders.agg(F.max("o_orderdate").cast("string")).first()[0]


# ── watermark state ─────────────────────────────────────────────────────────

def test_parallel_harmonise_keeps_every_mark(spark):
    sink, state = SnapshotSink(spark, db()), SnapshotSink(spark, db())
    landing = fx.blp_landing(fx.TestTables(spark, SF001))
    specs = [TableSpec(s.source, s.target, (), s.watermark_column) for s in BLP_TABLES]
    jobs.run_harmonise_job(spark, landing.__getitem__, sink, RunLog(sink), specs, "BLP", "delta",
                           max_parallel=6, state=state)
    rows = state.read("orchestration_config").collect()
    assert len(rows) == 6 and all(r.watermark_value and r.first_load_complete for r in rows)
    assert len(state.versions("orchestration_config")) <= 2  # the empty table and one publish


def test_rows_that_arrive_during_a_load_are_not_lost(spark):
    """The mark comes from the rows that were written, not from a second read."""
    sink, state = SnapshotSink(spark, db()), SnapshotSink(spark, db())
    name = db()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"), F.col("id").alias("w"))
    rows(0, 10).write.saveAsTable(f"{name}.landing")
    spec = TableSpec("landing", "t", ("k",), "w")

    class Late(SnapshotSink):
        late = 10

        def publish(self, df, table, *a, **kw):
            out = super().publish(df, table, *a, **kw)
            if table == "t":  # rows land once the table is written, before its mark is
                rows(self.late, self.late + 5).write.mode("append").saveAsTable(f"{name}.landing")
                self.late += 5
            return out

    late = Late(spark, sink.database)
    for _ in range(3):
        jobs.run_harmonise_job(spark, lambda n: spark.table(f"{name}.{n}"), late, RunLog(state), [spec],
                               "BLP", "delta", state=state)
    got = sorted(r.k for r in late.read("t").collect())
    assert got == list(range(20))
    assert state.read("orchestration_config").first().watermark_value == "19"


def test_stored_marks_need_no_format(spark):
    sink, state = SnapshotSink(spark, db()), SnapshotSink(spark, db())
    orders = fx.TestTables(spark, SF001)("orders")
    spec = TableSpec("orders", "orders_h", ("o_orderkey",), "o_orderdate", watermark_format="yyyyMMdd")
    early = orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    for frame in (early, orders):
        jobs.run_harmonise_job(spark, lambda n, f=frame: f, sink, RunLog(sink), [spec], "BLP", "delta", state=state)
    assert sink.read("orders_h").count() == orders.count()


def test_soft_delete_counts_what_it_changed(spark):
    sink = SnapshotSink(spark, db())
    ct.apply_migrations(sink, ct.platform_migrations(), "dev")
    hit = F.col("lob_code").isin("UP", "DS", "none")
    assert ct.soft_delete_rows(sink, "lob_group_map", hit, "t") == 2
    assert ct.soft_delete_rows(sink, "lob_group_map", hit, "t") == 0
