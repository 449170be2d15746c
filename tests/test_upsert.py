import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators.upsert import (MergeKeyError, SchemaMismatch, load_frame, upsert,
                                     upsert_counted)

SCHEMA = "k long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def test_update_and_insert(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    s = spark.createDataFrame([(2, "B"), (3, "C")], SCHEMA)
    assert rows(upsert(t, s, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]


def test_null_new_value_overwrites(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(1, None)], SCHEMA)
    assert rows(upsert(t, s, ["k"])) == [(1, None)]


def test_duplicate_matched_source_key_raises(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA)
    with pytest.raises(MergeKeyError):
        upsert(t, s, ["k"])


def test_duplicate_unmatched_source_key_inserted_twice(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(5, "x"), (5, "y")], SCHEMA)
    assert rows(upsert(t, s, ["k"])) == [(1, "a"), (5, "x"), (5, "y")]


def test_repeated_target_key_all_rows_updated(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], SCHEMA)
    s = spark.createDataFrame([(1, "z")], SCHEMA)
    assert rows(upsert(t, s, ["k"])) == [(1, "z"), (1, "z"), (2, "c")]


def test_null_keys_raise_by_default_and_insert_when_allowed(spark):
    t = spark.createDataFrame([(1, "a"), (None, "n")], SCHEMA)
    s = spark.createDataFrame([(None, "x")], SCHEMA)
    with pytest.raises(MergeKeyError):
        upsert(t, s, ["k"])
    out = rows(upsert(t, s, ["k"], null_keys="allow"))
    assert out == [(1, "a"), (None, "n"), (None, "x")]


def test_composite_key(spark):
    sch = "a long, b long, v string"
    t = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], sch)
    s = spark.createDataFrame([(1, 2, "Y"), (2, 1, "z")], sch)
    assert rows(upsert(t, s, ["a", "b"])) == [(1, 1, "x"), (1, 2, "Y"), (2, 1, "z")]


def test_missing_column_is_error_extra_is_ignored_or_evolved(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    with pytest.raises(SchemaMismatch):
        upsert(t, spark.createDataFrame([(1,)], "k long"), ["k"])
    s = spark.createDataFrame([(1, "b", 9)], "k long, v string, extra int")
    assert upsert(t, s, ["k"]).columns == ["k", "v"]
    ev = upsert(t, s, ["k"], evolve=True)
    assert ev.columns == ["k", "v", "extra"]
    assert rows(ev) == [(1, "b", 9)]


def test_empty_source_is_identity(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    s = spark.createDataFrame([], SCHEMA)
    out, n = upsert_counted(t, s, ["k"])
    assert n == 0 and rows(out) == rows(t)


def test_large_source_uses_shuffle_path(spark):
    t = spark.range(0, 200).select(F.col("id").alias("k"), F.lit("t").alias("v"))
    s = spark.range(100, 300).select(F.col("id").alias("k"), F.lit("s").alias("v"))
    small = rows(upsert(t, s, ["k"]))
    big = rows(upsert(t, s, ["k"], broadcast_limit=0))
    assert small == big and len(big) == 300


def test_broadcast_plan_does_not_shuffle_target(spark):
    t = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("t").alias("v"))
    s = spark.createDataFrame([(5, "x")], SCHEMA)
    plan = upsert(t, s, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_load_frame_dispatch(spark):
    a = spark.createDataFrame([(1, "a")], SCHEMA)
    b = spark.createDataFrame([(1, "b"), (2, "c")], SCHEMA)
    first, mode = load_frame(None, a, ["k"], "delta")
    assert mode == "full" and rows(first) == [(1, "a")]
    second, mode = load_frame(first, b, ["k"], "delta")
    assert mode == "delta" and rows(second) == [(1, "b"), (2, "c")]
    full, mode = load_frame(second, a, ["k"], "full")
    assert mode == "full" and rows(full) == [(1, "a")]


keyvals = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", "c"])), max_size=8)


@settings(max_examples=15, deadline=None)
@given(target=keyvals, source=keyvals)
def test_property_matches_python_merge_and_is_idempotent(spark, target, source):
    # unique, non-null source keys
    src = list({k: (k, v) for k, v in source}.values())
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(src, SCHEMA)
    once = upsert(t, s, ["k"])
    sk = {k: v for k, v in src}
    expected = [(k, sk.get(k, v)) for k, v in target]
    tk = {k for k, _ in target}
    expected += [(k, v) for k, v in src if k not in tk]
    assert rows(once) == sorted(expected)
    twice = upsert(once, s, ["k"])
    assert rows(twice) == rows(once)


def test_delete_missing_for_full_snapshots(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (3, "c")], SCHEMA)
    s = spark.createDataFrame([(2, "B"), (4, "D")], SCHEMA)
    assert rows(upsert(t, s, ["k"])) == [(1, "a"), (2, "B"), (2, "B"), (3, "c"), (4, "D")]
    assert rows(upsert(t, s, ["k"], delete_missing=True)) == [(2, "B"), (2, "B"), (4, "D")]
    assert rows(upsert(t, s, ["k"], delete_missing=True, broadcast_limit=0)) == \
        [(2, "B"), (2, "B"), (4, "D")]


def test_wide_source_is_not_broadcast_beyond_byte_bound(spark):
    from strata.operators.sizing import size_of
    t = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("t").alias("v"))
    s = spark.range(0, 10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"))
    rows_, size = size_of(s)
    assert rows_ == 10 and size >= 10 * 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # isolate our decision
    try:
        def plan(**kw):
            return upsert(t, s, ["k"], **kw)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan()                       # within both bounds
        assert "BroadcastHashJoin" not in plan(broadcast_bytes=5000)  # too many bytes
        assert rows(upsert(t, s, ["k"], broadcast_bytes=5000)) == rows(upsert(t, s, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


ck = st.lists(st.tuples(st.sampled_from([1, 2, None]), st.sampled_from([1, 2]),
                        st.sampled_from(["a", "b"])), max_size=7)


@settings(max_examples=15, deadline=None)
@given(target=ck, source=ck)
def test_property_composite_and_null_keys_match_python_merge(spark, target, source):
    """MERGE on (a, b): NULL never matches; unmatched rows (incl. NULL keys and
    unmatched duplicates) are inserted; a target row matched twice raises."""
    sch = "a long, b long, v string"
    t = spark.createDataFrame(target, sch)
    s = spark.createDataFrame(source, sch)
    key = lambda r: (r[0], r[1])
    matchable = [r for r in source if r[0] is not None]
    matches = {}
    for r in matchable:
        matches.setdefault(key(r), []).append(r)
    target_keys = {key(r) for r in target if r[0] is not None}
    if any(len(v) > 1 and k in target_keys for k, v in matches.items()):
        with pytest.raises(MergeKeyError):
            upsert(t, s, ["a", "b"], null_keys="allow")
        return
    expected = [(r[0], r[1], matches[key(r)][0][2]) if r[0] is not None and key(r) in matches
                else r for r in target]
    expected += [r for r in source if r[0] is None or key(r) not in target_keys]
    got = rows(upsert(t, s, ["a", "b"], null_keys="allow"))
    assert got == sorted(expected, key=lambda r: tuple((x is None, x) for x in r))
