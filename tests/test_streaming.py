import os
import tempfile
import uuid

from pyspark.sql import functions as F

from strata.operators.harmonise import TableSpec
from strata.sinks.audit import RunLog
from strata.sinks.publish import SnapshotSink
from strata.sources.fixtures import TestTables
from strata.streaming.incremental import harmonise_stream

from conftest import SF001


def test_stream_loads_each_landing_file_once(spark):
    landing = tempfile.mkdtemp(prefix="landing-")
    ckpt = tempfile.mkdtemp(prefix="ckpt-")
    orders = TestTables(spark, SF001)("orders")
    early = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    early.write.mode("append").parquet(landing)

    sink = SnapshotSink(spark, "s_" + uuid.uuid4().hex[:8])
    log = RunLog(sink)
    spec = TableSpec("orders", "orders_h", ("o_orderkey",), "o_orderdate")
    harmonise_stream(spark, landing, spec, sink, "BLP", log=log, checkpoint=ckpt)
    assert sink.read("orders_h").count() == early.count()

    # second drop: all orders, statuses changed -> updates + inserts
    changed = orders.withColumn("o_orderstatus", F.lit("X"))
    changed.write.mode("append").parquet(landing)
    harmonise_stream(spark, landing, spec, sink, "BLP", log=log, checkpoint=ckpt)
    out = sink.read("orders_h")
    assert out.count() == orders.count()
    assert out.where(F.col("o_orderstatus") != "X").count() == 0

    # nothing new: no batch, no change
    before = sink.versions("orders_h")
    harmonise_stream(spark, landing, spec, sink, "BLP", log=log, checkpoint=ckpt)
    assert sink.versions("orders_h") == before
    assert [r.load_type for r in log.read().orderBy("logged_at").collect()] == ["full", "delta"]
    assert os.path.isdir(os.path.join(ckpt, "offsets"))


def test_streams_for_several_tables(spark):
    from strata.streaming.incremental import harmonise_streams
    root = tempfile.mkdtemp(prefix="landing-root-")
    ckpt = tempfile.mkdtemp(prefix="ckpts-")
    t = TestTables(spark, SF001)
    t("customer").write.parquet(os.path.join(root, "customer_raw"))
    t("part").write.parquet(os.path.join(root, "part_raw"))
    specs = [TableSpec("customer_raw", "customer", ("c_custkey",)),
             TableSpec("part_raw", "part", ("p_partkey",))]
    sink = SnapshotSink(spark, "ms_" + uuid.uuid4().hex[:8])
    done = harmonise_streams(spark, root, specs, sink, "BLP", checkpoint_root=ckpt)
    assert done == {"customer": 1, "part": 1}
    assert sink.read("customer").count() == t("customer").count()
    assert sink.read("part").count() == t("part").count()
    assert harmonise_streams(spark, root, specs, sink, "BLP", checkpoint_root=ckpt) == \
        {"customer": 0, "part": 0}


def test_failed_micro_batch_is_audited(spark):
    import pytest
    landing, ckpt = tempfile.mkdtemp(prefix="landing-"), tempfile.mkdtemp(prefix="ckpt-")
    sink = SnapshotSink(spark, "fs_" + uuid.uuid4().hex[:8])
    log = RunLog(sink)
    spec = TableSpec("t", "t_h", ("k",))
    spark.createDataFrame([(1, "a")], "k long, v string").write.mode("append").parquet(landing)
    harmonise_stream(spark, landing, spec, sink, "BLP", log=log, checkpoint=ckpt)
    spark.createDataFrame([(None, "b")], "k long, v string").write.mode("append").parquet(landing)
    with pytest.raises(Exception):
        harmonise_stream(spark, landing, spec, sink, "BLP", log=log, checkpoint=ckpt)
    rows = log.read().orderBy("logged_at").collect()
    assert [(r.status, r.rows) for r in rows] == [("success", 1), ("failed", 0)]
    assert "NULL key" in rows[1].error


def _events(spark, rows):
    return spark.createDataFrame(rows, "k long, ts timestamp, v string")


def _drop(df, landing):
    df.coalesce(1).write.mode("append").parquet(landing)


def _at(day, hour=0):
    import datetime as dt
    return dt.datetime(2024, 1, day, hour)


def _stored(sink):
    return sorted((r.k, r.v) for r in sink.read("ev").select("k", "v").collect())


def _event_setup(spark):
    from functools import partial

    from strata.streaming.events import load_events
    landing, ckpt = tempfile.mkdtemp(prefix="landing-"), tempfile.mkdtemp(prefix="ckpt-")
    sink = SnapshotSink(spark, "ev_" + uuid.uuid4().hex[:8])
    run = partial(load_events, spark, landing, TableSpec("ev", "ev", ("k",)), "ts", "2 days", sink, "BLP",
                  checkpoint=ckpt, max_files_per_trigger=1)
    return landing, ckpt, sink, run


def test_events_late_and_repeated(spark):
    landing, _, sink, run = _event_setup(spark)
    _drop(_events(spark, [(1, _at(1), "a"), (1, _at(1), "a"), (2, _at(10), "b")]), landing)
    assert run().appended == 2 and _stored(sink) == [(1, "a"), (2, "b")]
    # late but within two days, a repeat, and an event older than the watermark
    _drop(_events(spark, [(3, _at(9), "c"), (2, _at(10), "b"), (4, _at(2), "d"), (4, _at(2), "d"),
                          (1, _at(1), "a")]), landing)
    done = run()
    assert (done.appended, done.recovered, done.compared) == (1, 1, False)
    assert _stored(sink) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    # without an event time: never in the state, found by key, also when repeated
    for _ in range(2):
        _drop(_events(spark, [(5, None, "e"), (6, _at(11), "f")]), landing)
        run()
    assert _stored(sink) == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f")]
    assert run().appended == 0


def test_events_append_without_reading_the_table(spark, monkeypatch):
    landing, _, sink, run = _event_setup(spark)
    _drop(_events(spark, [(1, _at(1), "a")]), landing)
    run()
    _drop(_events(spark, [(2, _at(2), "b")]), landing)
    monkeypatch.setattr(SnapshotSink, "read", lambda *a: (_ for _ in ()).throw(AssertionError("table read")))
    assert run().appended == 1
    monkeypatch.undo()
    assert _stored(sink) == [(1, "a"), (2, "b")]


def test_events_survive_a_lost_run(spark, monkeypatch):
    """The driver is lost after the append and before the batch is committed;
    then also the whole checkpoint folder."""
    import pytest
    landing, ckpt, sink, run = _event_setup(spark)
    _drop(_events(spark, [(1, _at(10), "a")]), landing)
    run()
    append = SnapshotSink.append

    def lost(self, df, name):
        append(self, df, name)
        raise RuntimeError("driver lost")

    _drop(_events(spark, [(2, _at(10), "b"), (3, _at(1), "old")]), landing)
    monkeypatch.setattr(SnapshotSink, "append", lost)
    with pytest.raises(Exception, match="driver lost"):
        run()
    monkeypatch.undo()
    done = run()
    assert done.compared and done.recovered == 1
    assert _stored(sink) == [(1, "a"), (2, "b"), (3, "old")]
    done = run(checkpoint=tempfile.mkdtemp(prefix="ckpt-"))
    assert done.compared and (done.appended, done.recovered) == (0, 0)
    assert _stored(sink) == [(1, "a"), (2, "b"), (3, "old")]


def test_events_null_key_fails_before_it_is_stored(spark):
    import pytest
    landing, _, sink, run = _event_setup(spark)
    _drop(_events(spark, [(None, _at(1), "a"), (1, _at(1), "b")]), landing)
    with pytest.raises(Exception, match="NULL key"):
        run()
    assert not sink.exists("ev")
