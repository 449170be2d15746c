"""The one-scan upsert, hot keys kept out of the plan, and masks read at
execution."""
import random

import pytest
from pyspark.sql import functions as F

from test_skew import executed, skew_conf  # noqa: F401 (a fixture)
from strata.operators import security as sec
from strata.operators import skew
from strata.operators.upsert import hot_target_keys, upsert


def shown(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("delete_missing", [False, True])
def test_same_rows_as_the_two_scan_plan(spark, seed, delete_missing):
    rng = random.Random(seed)
    target = [(rng.choice([*[0] * 30, None, *range(40)]), rng.choice("ab"), i % 4) for i in range(400)]
    known = {r[:2] for r in target}
    source = [(k, a, 99 + k) for k in range(60) for a in "ab" if rng.random() < .5]
    source += [(200, "a", 1)] * 3 + [(None, "a", 5), (None, None, 6), (3, None, 7)]  # inserted as they are
    t = spark.createDataFrame(target, "k long, a string, v int")
    s = spark.createDataFrame(source, "k long, a string, v int")
    how = dict(null_keys="allow", broadcast_limit=0, delete_missing=delete_missing)
    want = upsert(t, s, ["k", "a"], **how)
    assert shown(upsert(t, s, ["k", "a"], one_scan=True, **how)) == shown(want)
    assert known and hot_target_keys(t, ["k", "a"], 8) is not None


def test_one_scan_of_a_target_with_a_hot_key(spark, skew_conf, tmp_path):  # noqa: F811
    """The target is read and shuffled once; the key with a third of the rows
    lies in many partitions."""
    n = 300_000
    spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                          F.lit("t").alias("v")).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(0, n, 2).select(F.col("id").alias("k"), F.lit("s").alias("v"))
    out = upsert(target, source, ["k"], broadcast_limit=0, one_scan=True)
    assert out.count() == n + (50_000 - 1)
    assert out.where("k = 0 and v = 's'").count() == 100_000
    plan = executed(out).split("== Initial Plan ==")[0]
    assert plan.count(f"{tmp_path}/t") == 1
    assert plan.count("FullOuter") == 1
    parts = out.withColumn("p", F.spark_partition_id()).where("k = 0").groupBy("p").count().collect()
    assert len(parts) >= 5 and max(r["count"] for r in parts) <= 50_000


def test_many_hot_keys_stay_out_of_the_plan(spark):
    """Thousands of keys over a small threshold: a staged table, no literals."""
    df = spark.range(60_000).select((F.col("id") % 5_000).alias("k"))
    hot = skew.find_hot_keys(df, "k", 8)
    assert hot.count() == 5_000
    assert "LocalRelation" not in hot._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in hot._jdf.queryExecution().executedPlan().toString()


def test_mask_is_decided_at_execution(spark, tmp_path):
    path = str(tmp_path / "members")
    spark.createDataFrame([("ann", "g1")], "principal string, group_id string").write.parquet(path)
    members = spark.read.parquet(path)
    df = spark.createDataFrame([(1, "x"), (2, None)], "id long, v string")
    out = sec.mask_columns(df, ["v"], ["g1"], members, "ann")
    assert [r.v for r in out.orderBy("id").collect()] == ["x", None]
    spark.createDataFrame([("bob", "g1")], "principal string, group_id string").write.mode("overwrite").parquet(path)
    spark.catalog.refreshByPath(path)
    later = sec.mask_columns(df, ["v"], ["g1"], spark.read.parquet(path), "ann")
    assert {r.v for r in later.collect()} == {sec.MASK_TEXT}
    spark.sql("CREATE TEMP VIEW mask_data AS SELECT 1 AS id, 'x' AS v")
    spark.sql("CREATE TABLE mask_members (principal STRING, group_id STRING) USING parquet")
    spark.sql("INSERT INTO mask_members VALUES ('ann', 'g1')")
    built = sec.mask_columns(spark.table("mask_data"), ["v"], ["g1"], spark.table("mask_members"), "ann")
    spark.sql("INSERT OVERWRITE mask_members VALUES ('bob', 'g1')")
    assert built.first().v == sec.MASK_TEXT  # revoked after the plan was built
    spark.sql("DROP TABLE mask_members")
