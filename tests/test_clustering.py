"""Layout along a Z-order curve."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import clustering as C
from strata.sinks.publish import SnapshotSink
from test_pruned_views import scans

SF = "/root/testdata/sf0.01"


def _read(df):
    return sum(rows for _, _, rows in scans(df))


def test_ranks_and_interleaving(spark):
    df = spark.createDataFrame([(i, -i) for i in range(8)] + [(None, None)], "a int, b int")
    bounds = C.quantile_bounds(df, ["a", "b"], bits=2)
    assert bounds == [[1, 3, 5], [-6, -4, -2]]
    got = df.select("a", C.rank(F.col("a"), bounds[0]).alias("r"), C.rank(F.col("b"), bounds[1]).alias("s"),
                    C.z_value(df, ["a", "b"], bounds, 2).alias("z")).collect()
    for a, r, s, z in got:
        assert (r, s) == ((0, 0) if a is None else (sum(x <= a for x in bounds[0]), sum(x <= -a for x in bounds[1])))
        assert z == (r >> 1) * 8 + (s >> 1) * 4 + (r & 1) * 2 + (s & 1)


def test_strings_keep_their_order(spark):
    words = ["", "a", "ab", "b", "é", "zebra and more", "zebra a"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.orderBy(C.ordered_value(df, "w"), "w").collect()]
    assert got == sorted(words, key=lambda w: (w.encode()[:7], w))


def test_both_columns_skip_rows_and_none_is_lost(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").withColumn("day", F.to_date("o_orderdate"))
    shuffled = orders.orderBy(F.xxhash64("o_orderkey"))
    total = orders.count()
    frames = {}
    for name, by in (("plain", ()), ("curve", ("day", "o_orderkey"))):
        sink = SnapshotSink(spark, f"z_{uuid.uuid4().hex[:8]}", cluster_by=by)
        conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data: keep several files
        try:
            sink.publish(shuffled, "orders")
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", conf)
        frames[name] = sink.read("orders")
    assert frames["curve"].exceptAll(orders).count() == 0 and frames["curve"].count() == total
    high = orders.agg(F.percentile_approx("day", 0.97)).first()[0]
    for condition in (F.col("day") > F.lit(high), F.col("o_orderkey").between(300, 500)):
        want = orders.where(condition).count()
        plain, curve = (frames[n].where(condition) for n in ("plain", "curve"))
        assert curve.count() == want
        assert _read(plain) == total and _read(curve) <= 0.6 * total


def test_hot_values_nulls_and_empty_tables(spark):
    rows = [(None if i % 5 == 0 else 7 if i % 3 else i, f"k{i % 4}") for i in range(200)]
    df = spark.createDataFrame(rows, "a int, s string")
    got = C.cluster(df, ["a", "s"]).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)
    assert C.cluster(df.limit(0), ["a", "s"]).count() == 0
    assert C.cluster(df.select(F.lit(None).cast("int").alias("a")), ["a"]).count() == 200
    for bad in ([], ["a"] * 11):
        with pytest.raises(ValueError):
            C.cluster(df, bad)
    with pytest.raises(ValueError):
        C.cluster(df.select(F.array("a").alias("x")), ["x"])


def test_tables_without_the_columns_are_published_as_they_are(spark):
    sink = SnapshotSink(spark, f"z_{uuid.uuid4().hex[:8]}", cluster_by=("mark", "k"))
    sink.publish(spark.createDataFrame([(1,), (2,)], "k int"), "t")
    assert sink.read("t").count() == 2
