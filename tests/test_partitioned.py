import os
import re
import uuid

from pyspark.sql import functions as F

from strata.plans import jobs
from strata.sinks.audit import RunLog
from strata.sinks.partitioned import PartitionedSink, key_range
from strata.sinks.publish import SnapshotSink
from strata.sources.fixtures import TestTables

from conftest import SF001


def _orders(spark):
    return TestTables(spark, SF001)("orders").withColumn("okr", key_range("o_orderkey", 100))


def _files_by_partition(spark, table):
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'") \
        .first()["data_type"].replace("file:", "")
    out = {}
    for d in sorted(os.listdir(loc)):
        if d.startswith("okr="):
            out[d] = sorted(f for f in os.listdir(os.path.join(loc, d)) if f.endswith(".parquet"))
    return out


def test_upsert_rewrites_only_touched_partitions(spark):
    sink = PartitionedSink(spark, "p_" + uuid.uuid4().hex[:8], "okr")
    orders = _orders(spark)
    rows, mode, _ = jobs.load(sink, orders, "orders", ["o_orderkey"], "delta")
    assert mode == "full" and rows == orders.count()
    before = _files_by_partition(spark, sink.data_table("orders"))
    top = orders.agg(F.max("o_orderkey")).first()[0]
    batch = (orders.where(F.col("o_orderkey") > top - 50).withColumn("o_orderstatus", F.lit("Z"))
             .unionByName(orders.where(F.col("o_orderkey") > top - 5)
                          .withColumn("o_orderkey", F.col("o_orderkey") + 1000)
                          .withColumn("okr", key_range("o_orderkey", 100))))
    n, mode, _ = jobs.load(sink, batch, "orders", ["o_orderkey"], "delta")
    assert mode == "delta" and n == batch.count()
    after = _files_by_partition(spark, sink.data_table("orders"))
    changed = {p for p in after if after[p] != before.get(p)}
    touched = {f"okr={r.okr}" for r in batch.select("okr").distinct().collect()}
    assert changed == touched and len(changed) < len(before)  # others untouched
    out = sink.read("orders")
    assert out.count() == orders.count() + 5
    assert out.where(F.col("o_orderstatus") == "Z").count() == 50
    # same result as the snapshot path
    snap = SnapshotSink(spark, "ps_" + uuid.uuid4().hex[:8])
    jobs.load(snap, orders, "orders", ["o_orderkey"], "delta")
    jobs.load(snap, batch, "orders", ["o_orderkey"], "delta")
    cols = sorted(orders.columns)
    assert sorted(map(tuple, out.select(cols).collect())) == \
        sorted(map(tuple, snap.read("orders").select(cols).collect()))


def test_target_scan_is_pruned(spark):
    sink = PartitionedSink(spark, "pp_" + uuid.uuid4().hex[:8], "p")
    sink.publish(spark.range(1000).select("id", (F.col("id") / 100).cast("long").alias("p"),
                                          F.lit("a").alias("v")), "t")
    src = spark.range(950, 1010).select("id", (F.col("id") / 100).cast("long").alias("p"),
                                        F.lit("b").alias("v"))
    sink.upsert(src, "t", ["id"])
    out = sink.read("t")
    assert out.count() == 1010 and out.where("v = 'b'").count() == 60
    target = spark.table(sink.data_table("t")).where(F.col("p").isin([9, 10]))
    plan = target._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[p#\d+L IN \(9,10\)\]", plan)


def test_partitioned_fact_job(spark):
    sink = PartitionedSink(spark, "pj_" + uuid.uuid4().hex[:8], "okr")
    log = RunLog(SnapshotSink(spark, sink.database + "_log"))
    n = jobs.run_fact_job(spark, sink, log, "orders", lambda: _orders(spark), ["o_orderkey"])
    assert n == _orders(spark).count()
    assert jobs.run_fact_job(spark, sink, log, "orders", lambda: _orders(spark),
                             ["o_orderkey"]) == n
    assert spark.table(sink.public_name("orders")).count() == n


def test_parallel_upserts_into_two_partitioned_tables(spark):
    from concurrent.futures import ThreadPoolExecutor
    sink = PartitionedSink(spark, "ppar_" + uuid.uuid4().hex[:8], "p")
    base = spark.range(2000).select("id", (F.col("id") / 100).cast("long").alias("p"),
                                    F.lit("a").alias("v"))
    for name in ("t1", "t2"):
        sink.publish(base, name)
    batch = spark.range(1950, 2050).select("id", (F.col("id") / 100).cast("long").alias("p"),
                                           F.lit("b").alias("v"))
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(lambda n: sink.upsert(batch, n, ["id"]), ["t1", "t2"]))
    assert results == [100, 100]
    for name in ("t1", "t2"):
        out = sink.read(name)
        assert out.count() == 2050 and out.where("v = 'b'").count() == 100
    # the session's overwrite mode is restored after the writes
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_all_sinks_satisfy_the_protocol(spark):
    from strata.sinks.base import Sink
    from strata.sinks.merge_into import MergeIntoSink
    assert isinstance(SnapshotSink(spark, "proto_a"), Sink)
    assert isinstance(PartitionedSink(spark, "proto_b", "p"), Sink)
    assert isinstance(MergeIntoSink(spark, "proto_c"), Sink)


from hypothesis import given, settings, strategies as st  # noqa: E402

batches = st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["x", "y", "z"])),
                   min_size=1, max_size=12, unique_by=lambda r: r[0])


@settings(max_examples=5, deadline=None)
@given(batch=batches)
def test_property_partitioned_equals_snapshot(spark, batch):
    base = spark.range(0, 30).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    src = spark.createDataFrame(batch, "k long, v string")
    with_p = lambda df: df.withColumn("p", key_range("k", 8))
    part = PartitionedSink(spark, "pq_" + uuid.uuid4().hex[:8], "p")
    snap = SnapshotSink(spark, "sq_" + uuid.uuid4().hex[:8])
    part.publish(with_p(base), "t")
    snap.publish(with_p(base), "t")
    part.upsert(with_p(src), "t", ["k"])
    jobs.load(snap, with_p(src), "t", ["k"], "delta")
    cols = ["k", "v", "p"]
    assert sorted(map(tuple, part.read("t").select(cols).collect())) == \
        sorted(map(tuple, snap.read("t").select(cols).collect()))


# ── stored loads that change partitions, columns and whole tables ────────────

def _sink(spark, **kw):
    return PartitionedSink(spark, "px_" + uuid.uuid4().hex[:8], "p", **kw)


def _kvp(spark, rows, schema="k long, v string, p string"):
    return spark.createDataFrame(rows, schema)


def _rows(sink, cols=("k", "v", "p")):
    return sorted(map(str, sink.read("t").select(*cols).collect()))


def _want(spark, rows, schema="k long, v string, p string"):
    return sorted(map(str, spark.createDataFrame(rows, schema).collect()))


import pytest  # noqa: E402


@pytest.mark.parametrize("limits", [{}, {"max_pruned_partitions": 0}])
@pytest.mark.parametrize("stable", [True, False])
def test_null_partition_keeps_its_rows(spark, limits, stable):
    sink = _sink(spark, stable_keys=stable, **limits)
    sink.publish(_kvp(spark, [(1, "a", None), (2, "a", None), (3, "a", "x")]), "t")
    sink.upsert(_kvp(spark, [(2, "b", None), (4, "b", None)]), "t", ["k"])
    assert _rows(sink) == _want(spark, [(1, "a", None), (2, "b", None), (3, "a", "x"), (4, "b", None)])


def test_moved_keys_leave_their_old_partition(spark):
    sink = _sink(spark)
    sink.publish(_kvp(spark, [(1, "a", "x"), (2, "a", "y"), (3, "a", "y"), (4, "a", "o'z"), (5, "a", None)]), "t")
    # 1 leaves x empty, 2 leaves y, 4 leaves a partition with a quote, 5 the NULL partition
    sink.upsert(_kvp(spark, [(1, "b", "y"), (2, "b", "w"), (4, "b", "y"), (5, "b", "y")]), "t", ["k"])
    assert _rows(sink) == _want(spark, [(1, "b", "y"), (2, "b", "w"), (3, "a", "y"), (4, "b", "y"), (5, "b", "y")])


def test_evolve_adds_the_column(spark):
    sink = _sink(spark)
    sink.publish(_kvp(spark, [(1, "a", "x"), (2, "a", "y")]), "t")
    jobs.load(sink, _kvp(spark, [(2, "b", 7, "y"), (3, "b", 8, "z")], "k long, v string, n int, p string"),
              "t", ["k"], "delta", evolve=True)
    assert _rows(sink, ("k", "v", "n", "p")) == _want(
        spark, [(1, "a", None, "x"), (2, "b", 7, "y"), (3, "b", 8, "z")], "k long, v string, n int, p string")


def test_delete_missing_reaches_other_partitions(spark):
    sink = _sink(spark)
    sink.publish(_kvp(spark, [(1, "a", "x"), (2, "a", "y"), (3, "a", None)]), "t")
    assert sink.upsert(_kvp(spark, [(2, "b", "y")]), "t", ["k"], delete_missing=True) == 1
    assert _rows(sink) == _want(spark, [(2, "b", "y")])


def test_full_load_may_change_the_schema(spark):
    sink = _sink(spark)
    for i, schema in enumerate(("k long, v string, p string", "k long, w int, p string", "k long, p string")):
        row = {"k": i, "v": "a", "w": 5, "p": "x"}
        names = [c.split()[0] for c in schema.split(", ")]
        jobs.load(sink, spark.createDataFrame([tuple(row[n] for n in names)], schema), "t", ["k"], "full")
        assert sink.read("t").columns == names and sink.read("t").count() == 1
    assert len([t for t in spark.catalog.listTables(sink.database) if "__data" in t.name]) == 1


def test_failed_full_load_leaves_the_table(spark):
    sink = _sink(spark)
    sink.publish(_kvp(spark, [(1, "a", "x")]), "t")
    bad = _kvp(spark, [(2, "b", "y")]).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        sink.publish(bad, "t")
    assert _rows(sink) == _want(spark, [(1, "a", "x")])
    sink.publish(_kvp(spark, [(3, "c", "z")]), "t")
    assert _rows(sink) == _want(spark, [(3, "c", "z")])


def test_merge_into_refuses_unknown_options(spark):
    from strata.sinks.merge_into import MergeIntoSink
    sink = MergeIntoSink(spark, "mi")
    with pytest.raises(TypeError):
        sink.upsert(spark.range(1), "t", ["id"], broadcast_limit=3)
