import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators import security as sec
from strata.operators.control import LOB_SEED, seed_rows_frame, soft_delete

MAP_COLS = ["lob_code", "lob_name", "entra_group_id", "scope", "is_active", "updated_by"]


@pytest.fixture
def lob_map(spark):
    rows = list(LOB_SEED) + [("RF", "Refinery", "grp-rf", "LOB", False, "m")]
    return seed_rows_frame(spark, "lob_group_map", rows, MAP_COLS)


@pytest.fixture
def members(spark):
    return spark.createDataFrame(
        [("up", "grp-lob-up"), ("glob", "grp-lob-global"), ("rf", "grp-rf"),
         ("two", "grp-lob-up"), ("two", "grp-lob-ds")], "principal string, group_id string")


@pytest.fixture
def fact(spark):
    return spark.createDataFrame([("UP", 1), ("DS", 2), ("GF", 3), (None, 4), ("XX", 5)],
                                 "lob_code string, v int")


def vs(df):
    return sorted(r["v"] for r in df.collect())


@pytest.mark.parametrize("who,expected", [
    ("up", [1]), ("two", [1, 2]), ("glob", [1, 2, 3, 4, 5]), ("rf", []), ("nobody", []),
])
def test_row_filter_semantics(fact, lob_map, members, who, expected):
    out = sec.row_filter(fact, "lob_code", lob_map, members, who)
    assert vs(out) == expected
    counts = {r.principal: r.visible_rows for r in
              sec.visible_rows(fact, "lob_code", lob_map, members).collect()}
    assert counts.get(who, 0) == len(expected)


def test_no_leak_through_name_shadowing(fact, lob_map, members):
    # The reference's literal SQL compares the map column with itself; the
    # intended filter must not show a member every row (Q1).
    assert vs(sec.row_filter(fact, "lob_code", lob_map, members, "up")) == [1]


def test_inactive_global_grants_nothing(spark, fact, lob_map, members):
    m = soft_delete(lob_map, F.col("scope") == "GLOBAL", by="t")
    assert vs(sec.row_filter(fact, "lob_code", m, members, "glob")) == []


def test_properties_subset_and_idempotent(fact, lob_map, members):
    once = sec.row_filter(fact, "lob_code", lob_map, members, "two")
    twice = sec.row_filter(once, "lob_code", lob_map, members, "two")
    assert set(vs(once)) <= set(vs(fact))
    assert vs(once) == vs(twice)


def test_missing_filter_column_raises(fact, lob_map, members):
    with pytest.raises(sec.FilterColumnMissing):
        sec.row_filter(fact.drop("lob_code"), "lob_code", lob_map, members, "up")


def test_small_grants_are_broadcast(spark, lob_map, members):
    big = spark.range(0, 3000).select(
        F.element_at(F.array(F.lit("UP"), F.lit("DS"), F.lit("GF")),
                     (F.col("id") % 3 + 1).cast("int")).alias("lob_code"), F.col("id"))
    out = sec.row_filter(big, "lob_code", lob_map, members, "two")
    assert out.count() == 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "ExistenceJoin" not in plan


def test_large_maps_split_a_hot_code(spark):
    """With a map beyond broadcasting, a code holding a third of the fact is
    dealt to several tasks by adaptive execution."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = spark.range(0, 300_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 5000)).alias("code"),
            F.col("id").alias("v"))
        grants = [("hot", "g")] + [(f"c{i}", "g") for i in range(0, 5000, 2)]
        m = spark.createDataFrame(grants, "code string, entra_group_id string").withColumns(
            {"scope": F.lit("LOB"), "is_active": F.lit(True)})
        mem = spark.createDataFrame([("p", "g")], "principal string, group_id string")
        out = sec.row_filter(fact, "code", m, mem, "p")
        n = out.groupBy().count().collect()[0][0]
        assert n == sum(1 for i in range(300_000) if i % 3 == 0 or i % 5000 % 2 == 0)
        df = out.withColumn("w", F.col("v") + 1)
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("n_codes", [1, 5000])
def test_grants_are_read_at_execution(spark, tmp_path, n_codes):
    """A group revoked after the plan was built no longer counts, however many
    codes the reader had."""
    path = str(tmp_path / "members")
    spark.createDataFrame([("p", "g1"), ("p", "g2")], "principal string, group_id string") \
        .write.parquet(path)
    codes = [(f"c{i}", "g1") for i in range(n_codes)] + [("z", "g2")]
    m = spark.createDataFrame(codes, "code string, entra_group_id string").withColumns(
        {"scope": F.lit(None).cast("string"), "is_active": F.lit(True)})  # a mapping without a scope grants its code
    fact = spark.createDataFrame([("c0", 1), ("z", 2), ("y", 3), (None, 4)], "code string, v int")
    build = lambda: sec.row_filter(fact, "code", m, spark.read.parquet(path), "p")
    assert vs(build()) == [1, 2]
    spark.createDataFrame([("p", "g2")], "principal string, group_id string") \
        .write.mode("overwrite").parquet(path)
    assert vs(build()) == [2]


def test_a_built_filter_follows_its_tables(spark, fact, lob_map):
    db = "sec_live"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for rows, mode in (([("p", "grp-lob-up"), ("p", "grp-lob-gf")], "overwrite"),):
        spark.createDataFrame(rows, "principal string, group_id string").write.mode(mode).saveAsTable(f"{db}.m")
    out = sec.row_filter(fact, "lob_code", lob_map, spark.table(f"{db}.m"), "p")
    out.createOrReplaceTempView("sec_live_view")
    assert vs(spark.sql("SELECT * FROM sec_live_view")) == [1, 3]
    spark.createDataFrame([("p", "grp-lob-up")], "principal string, group_id string") \
        .write.mode("overwrite").saveAsTable(f"{db}.m")
    assert vs(sec.row_filter(fact, "lob_code", lob_map, spark.table(f"{db}.m"), "p")) == [1]


def test_mask_member_and_non_member_null(spark, members):
    df = spark.createDataFrame([("alice", 1), (None, 2)], "name string, v int")
    shown = sec.mask_columns(df, ["name"], ["grp-lob-up"], members, "up")
    hidden = sec.mask_columns(df, ["name"], ["grp-lob-up"], members, "glob")
    assert sorted((r["name"] or "") for r in shown.collect()) == ["", "alice"]
    assert [r["name"] for r in hidden.collect()] == [sec.MASK_TEXT, sec.MASK_TEXT]
    for who in ("up", "glob"):  # one type for every reader
        out = sec.mask_columns(df, ["v"], ["grp-lob-up"], members, who)
        assert out.schema["v"].dataType.simpleString() == "string"


def test_secure_dispatch(fact, lob_map, members):
    b = {"schema": "plan", "table": "fact_mot", "row_filter": "fn_lob_filter",
         "filter_column": "lob_code"}
    out, action = sec.secure(fact, b, {"lob_group_map": lob_map}, members, "up")
    assert action == "FILTERED" and vs(out) == [1]
    out, action = sec.secure(fact, None, {}, members, "up")
    assert action == "SKIPPED" and out is fact
    with pytest.raises(sec.FilterColumnMissing):
        sec.secure(fact.drop("lob_code"), b, {"lob_group_map": lob_map}, members, "up")


def test_secured_view_follows_membership(spark, lob_map, fact):
    spark.sql("CREATE DATABASE IF NOT EXISTS sec_t")
    me = sec.current_principal(spark)
    lob_map.write.mode("overwrite").saveAsTable("sec_t.lob_group_map")
    fact.write.mode("overwrite").saveAsTable("sec_t.fact")
    spark.createDataFrame([(me, "grp-lob-up")], "principal string, group_id string") \
        .write.mode("overwrite").saveAsTable("sec_t.members")
    spark.sql(sec.secured_view_sql("sec_t.fact_secured", "sec_t.fact", "lob_code",
                                   "sec_t.lob_group_map", "lob_code", "sec_t.members"))
    assert vs(spark.table("sec_t.fact_secured")) == [1]
    plan = spark.table("sec_t.fact_secured")._jdf.queryExecution().executedPlan().toString()
    assert "ExistenceJoin" not in plan and "BroadcastHashJoin" in plan
    spark.createDataFrame([(me, "grp-lob-global")], "principal string, group_id string") \
        .write.mode("append").saveAsTable("sec_t.members")
    assert vs(spark.table("sec_t.fact_secured")) == [1, 2, 3, 4, 5]


codes = st.sampled_from(["A", "B", "C", None])
map_rows = st.lists(st.tuples(st.sampled_from(["A", "B", "C", "GLOBAL"]),
                              st.sampled_from(["g1", "g2", "g3"]),
                              st.booleans()), max_size=6)
member_rows = st.lists(st.tuples(st.sampled_from(["p", "q"]),
                                 st.sampled_from(["g1", "g2", "g3"])), max_size=4)


@settings(max_examples=12, deadline=None)
@given(mrows=map_rows, members_=member_rows, fact_codes=st.lists(codes, max_size=8))
def test_property_row_filter_matches_brute_force(spark, mrows, members_, fact_codes):
    m = spark.createDataFrame(
        [(c, g, "GLOBAL" if c == "GLOBAL" else "LOB", act) for c, g, act in mrows],
        "lob_code string, entra_group_id string, scope string, is_active boolean")
    mem = spark.createDataFrame(members_, "principal string, group_id string")
    fact = spark.createDataFrame(list(enumerate(fact_codes)), "v int, lob_code string")
    groups = {g for p, g in members_ if p == "p"}
    active = [(c, g) for c, g, act in mrows if act and g in groups]
    if any(c == "GLOBAL" for c, _ in active):
        expected = list(range(len(fact_codes)))
    else:
        ok = {c for c, _ in active}
        expected = [i for i, c in enumerate(fact_codes) if c is not None and c in ok]
    out = sec.row_filter(fact, "lob_code", m, mem, "p")
    assert vs(out) == expected


def test_sql_text_rejects_non_identifier_names():
    from strata.functions.columns import sql_name
    assert sql_name("cat.db.t_1") == "cat.db.t_1"
    for bad in ("t; DROP TABLE x", "a b", "x)--", "1abc", "", None):
        with pytest.raises(ValueError):
            sql_name(bad)
    with pytest.raises(ValueError):
        sec.secured_select_sql("db.t", "lob_code OR 1=1", "db.m", "lob_code", "db.g")
