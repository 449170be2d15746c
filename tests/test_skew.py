"""A key holding a third of all rows must be split, never sent to one task.

The plans use only joins AQE can split (inner, left outer, left semi with
the skewed side on the left) and aggregates with partial aggregation. The
test lowers AQE's skew thresholds to test scale and checks the executed
plan really splits the hot partition.
"""

import pytest
from pyspark.sql import functions as F

from strata.plans import facts
from strata.operators.upsert import upsert

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def executed(df):
    df.collect()  # runs this DataFrame's own adaptive plan to its final form
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_items(spark, n=30000):
    # a third of all items belong to delivery 0
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("VBELN"),
        (F.col("id") % 7).cast("int").alias("POSNR"),
        (F.col("id") % 50).alias("MATNR"),
        F.lit(1.0).alias("LFIMG"), F.lit("EA").alias("VRKME"))


def _fact_inputs(spark):
    items = skewed_items(spark)
    header = items.groupBy("VBELN").agg(F.current_timestamp().alias("WADAT_IST")) \
        .select("VBELN", F.col("VBELN").alias("VGBEL"), "WADAT_IST")
    orders = spark.range(30000).select(F.col("id").alias("VBELN"),
                                       F.current_timestamp().alias("VDATU"))
    mats = spark.range(50).select(F.col("id").alias("MATNR"),
                                  F.lit("01").alias("SPART"))
    return header, items, orders, mats


def test_on_time_fact_broadcasts_hot_delivery(spark, skew_conf):
    plain = facts.material_on_time_fact(*_fact_inputs(spark), hot_key_rows=None)
    split = facts.material_on_time_fact(*_fact_inputs(spark), hot_key_rows=1000)
    plan = executed(split)
    # hot rows meet their (broadcast) header where they are: no shuffle
    assert "BroadcastHashJoin" in plan and "Union" in plan
    cols = plain.columns
    assert sorted(map(tuple, plain.select(cols).drop("actual_goods_issue_date",
                                                     "requested_delivery_date").collect())) == \
        sorted(map(tuple, split.select(cols).drop("actual_goods_issue_date",
                                                  "requested_delivery_date").collect()))
    assert split.count() == 30000


def test_no_hot_keys_keeps_single_join(spark):
    split = facts.material_on_time_fact(*_fact_inputs(spark), hot_key_rows=10**9)
    assert "Union" not in split._jdf.queryExecution().executedPlan().toString()


def test_upsert_splits_repeated_hot_target_key(spark, skew_conf):
    target = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.lit("t").alias("v"))
    source = spark.range(0, 300000, 2).select(F.col("id").alias("k"), F.lit("s").alias("v"))
    out = upsert(target, source, ["k"], broadcast_limit=0)
    plan = executed(out)
    assert "skew=true" in plan
    # every target row with key 0 is updated; odd keys untouched
    assert out.where(F.col("k") == 0).where(F.col("v") == "s").count() == 100000
    # inserts: even source keys missing from the target = multiples of 6 except 0
    assert out.count() == 300000 + (50000 - 1)


def test_find_hot_keys_exact_without_key_shuffle(spark):
    from strata.operators.skew import HOT, find_hot_keys
    df = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 1000 == 1, F.lit(8))
        .otherwise(F.col("id")).alias("k"))
    hot = find_hot_keys(df, "k", 50000)
    assert sorted(r[HOT] for r in hot.collect()) == [7]        # key 8 (~300 rows) is not hot
    assert find_hot_keys(df, "k", 10**6) is None               # input smaller than threshold
    flat = spark.range(300000).select((F.col("id") % 150000).alias("k"))
    assert find_hot_keys(flat, "k", 100) is None               # only false-positive candidates


def test_spend_contract_join_splits_hot_po(spark, skew_conf):
    n = 300000
    arb = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("EBELN"),
        (F.col("id") % 10).cast("int").alias("EBELP"), F.lit("C1").alias("BUKRS"),
        F.lit(1).cast("long").alias("LIFNR"), F.lit(1).cast("long").alias("MATNR"),
        F.lit(1.0).alias("MENGE"), F.lit(1.0).alias("NETWR"), F.lit("USD").alias("WAERS"),
        F.current_timestamp().alias("BEDAT"), F.current_timestamp().alias("ERDAT"))
    contracts = spark.range(n).select(F.col("id").alias("po_number"),
                                      F.concat(F.lit("K"), F.col("id").cast("string"))
                                      .alias("contract_id"), F.lit("T").alias("contract_type"))
    fact = facts.spend_fact(arb, contracts, contract_policy="trust")
    assert "skew=true" in executed(fact)


def test_logistics_asset_join_splits_hot_asset(spark, skew_conf):
    n = 300000
    mv = spark.range(n).select(
        F.col("id").cast("string").alias("movement_id"),
        F.when(F.col("id") % 3 == 0, F.lit("A0")).otherwise(F.col("id").cast("string"))
        .alias("asset_id"),
        *[F.lit("x").alias(c) for c in ("movement_type", "origin_location",
                                        "destination_location")],
        *[F.current_timestamp().alias(c) for c in ("planned_departure_dt",
                                                   "actual_departure_dt",
                                                   "planned_arrival_dt", "actual_arrival_dt")],
        F.lit(1.0).alias("cargo_weight_kg"), F.lit(1.0).alias("cargo_volume_m3"))
    assets = spark.range(n).select(F.col("id").cast("string").alias("asset_id"),
                                   F.lit("n").alias("asset_name")) \
        .unionByName(spark.range(1).select(F.lit("A0").alias("asset_id"),
                                           F.lit("hot").alias("asset_name")))
    fact = facts.logistics_fact(mv, assets)
    assert "skew=true" in executed(fact)


def test_hot_keys_below_the_sketch_support(spark):
    """Ten keys of 1,000 rows are found whatever share of the table they are."""
    from strata.operators import skew
    df = spark.range(0, 100_000).select(
        F.when(F.col("id") < 10_000, F.col("id") % 10).otherwise(F.col("id")).alias("k"))
    for least in (skew.LEAST_SUPPORT, 0.5):  # 0.5: as if the table were far larger
        before, skew.LEAST_SUPPORT = skew.LEAST_SUPPORT, least
        try:
            hot = skew.find_hot_keys(df, "k", 500)
        finally:
            skew.LEAST_SUPPORT = before
        assert sorted(r[0] for r in hot.collect()) == list(range(10))
