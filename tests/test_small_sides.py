"""Joins with a short list that an inner join made: the many rows are not shuffled."""
import uuid

import pytest
from pyspark.sql import functions as F

from strata.functions.sql_functions import create_security_functions
from strata.operators import security
from strata.operators.propagate import changed_rows
from strata.operators.sizing import small_side
from strata.plans import facts
from strata.sources import fixtures as fx


@pytest.fixture
def narrow(spark):
    """The planner broadcasts what it takes to be below 200 kB."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "200000")
    yield spark
    spark.conf.set(key, old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark):
    db = f"small_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    me = security.current_principal(spark)
    for name, p in {p.map_table: p for p in security.PATTERNS.values()}.items():
        (spark.range(3000).select(F.col("id").cast("string").alias(p.map_key), F.concat(F.lit("g"), F.col("id") % 5)
                                  .alias("entra_group_id"), F.lit("X").alias("scope"), F.lit(True).alias("is_active"))
         .coalesce(1).write.saveAsTable(f"{db}.{name}"))
    spark.createDataFrame([(me, f"g{i % 3}", "pad" * 20) for i in range(2000)] + [("x", "g4", "")],
                          "principal string, group_id string, note string").coalesce(1).write.saveAsTable(f"{db}.members")
    spark.range(9000).select("id", F.when(F.col("id") % 7 > 0, (F.col("id") % 4000).cast("string")).alias("code")) \
        .write.saveAsTable(f"{db}.fact")
    return db


def test_granted_codes_do_not_shuffle_the_table(narrow):
    spark = narrow
    db = tables(spark)
    create_security_functions(spark, db, f"{db}.members")
    p = security.PATTERNS["fn_asset_filter"]
    want = sorted(i for i in range(9000) if i % 7 and i % 4000 < 3000 and i % 4000 % 5 < 3)
    body = security.secured_select_sql(f"{db}.fact", "code", f"{db}.{p.map_table}", p.map_key, f"{db}.members")
    for df in (spark.sql(body), spark.sql(f"SELECT * FROM {db}.fact WHERE {db}.fn_asset_filter(code)")):
        assert "SortMergeJoin" not in plan(df)
        assert sorted(r.id for r in df.collect()) == want


def test_small_side_is_counted(spark):
    a = spark.range(100)
    assert small_side(a, 10) is a
    assert "BroadcastHashJoin" in plan(spark.range(10).join(small_side(a.hint("merge")), "id"))


def test_lookups_of_facts_do_not_shuffle_the_lines(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        t = fx.TestTables(spark, "/root/testdata/sf0.001")
        found = plan(facts.spend_fact(fx.spend_lines(t), fx.contract_lines(t)))
        assert not any(c in x for x in found.splitlines() if "Exchange hashpart" in x for c in ("l_", "po_number"))
        found = plan(facts.material_on_time_fact(fx.delivery_header(t), fx.delivery_items(t), fx.sales_orders(t),
                                                 fx.materials(t), exclude_unknown=False))
        assert "MATNR" in found and not any("MATNR" in x for x in found.splitlines() if "Exchange hashpart" in x)
    finally:
        spark.conf.set(key, old)


def test_compared_sides_share_one_shuffle(spark):
    t = fx.TestTables(spark, "/root/testdata/sf0.001")
    items = fx.delivery_items(t, compared=True)
    before = items.withColumn("LFIMG", F.col("LFIMG") + (F.col("POSNR") == 2).cast("int"))
    changed = changed_rows(before, items)
    assert changed.count() == 2 * items.where("POSNR = 2").count()
    assert plan(changed).count("Exchange hashpartitioning") <= 2  # one a side, the same one twice
