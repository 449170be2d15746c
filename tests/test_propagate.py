"""Facts from what changed: equal to a rebuild whatever changed, and from a
plan that does not recompute the rest."""
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from strata.operators.propagate import affected_keys, changed_rows, propagate, restrict
from strata.plans import facts, jobs
from strata.sinks.audit import RunLog
from strata.sinks.partitioned import PartitionedSink, key_range
from strata.sinks.publish import SnapshotSink
from strata.sources import fixtures as fx

SCHEMAS = {"lips": "VBELN long, POSNR int, MATNR long, LFIMG double, VRKME string",
           "likp": "VBELN long, VGBEL long, WADAT_IST int", "vbak": "VBELN long, VDATU int",
           "mara": "MATNR long, SPART string"}


def build(i):
    return facts.material_on_time_fact(i["likp"], i["lips"], i["vbak"], i["mara"],
                                       exclude_unknown=False, hot_key_rows=None)


def state(rng):
    maybe = lambda n: rng.choice([None, *range(n)])
    return {"lips": [(rng.choice([*range(12), None]), rng.randrange(3), maybe(6), float(rng.randrange(3)), "EA")
                     for _ in range(40)],
            "likp": [(k, maybe(8), rng.randrange(5)) for k in range(12) if rng.random() < .8],
            "vbak": [(k, rng.randrange(5)) for k in range(8) if rng.random() < .8],
            "mara": [(k, rng.choice(["01", "02", "09", None])) for k in range(6) if rng.random() < .8]}


def frames(spark, rows):
    return {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()}


def shown(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("seed", range(4))
def test_any_change_equals_a_rebuild(spark, seed):
    """Rows inserted, changed, deleted and moved to another key, in some or
    all inputs, with NULL keys and repeated ones."""
    rng = random.Random(seed)
    old, new = state(rng), state(rng)
    keep = rng.sample(sorted(old), seed)  # inputs that did not change
    new |= {n: old[n] for n in keep}
    for n in set(new) - set(keep):  # most rows stay as they are
        key = 2 if n == "lips" else 1
        fresh = {r[:key]: r for r in new[n] if rng.random() < .3}
        new[n] = [fresh.pop(r[:key], r) for r in old[n] if rng.random() < .9] + list(fresh.values())
    before, after = frames(spark, old), frames(spark, new)
    changes = {n: changed_rows(before[n], after[n]) for n in after if n not in keep}
    done = propagate(build(before), build, facts.MOT_GRAPH, after, changes)
    assert shown(done.fact) == shown(build(after))
    assert done.rows.count() < max(2, len(new["lips"]))


def test_nothing_changed(spark):
    tables = frames(spark, state(random.Random(9)))
    assert propagate(build(tables), build, facts.MOT_GRAPH, tables, {}) is None


def test_plan_reads_only_what_the_keys_need(spark):
    """One changed material of all: the items are scanned with the few columns
    of the join and never shuffled; the fact is recomputed for its items alone."""
    t = fx.TestTables(spark, SF001)
    tables = {"likp": fx.delivery_header(t), "lips": fx.delivery_items(t),
              "vbak": fx.sales_orders(t), "mara": fx.materials(t)}
    one = tables["mara"].where(F.col("MATNR") == 5)
    keys = affected_keys(facts.MOT_GRAPH, tables, {"mara": one})
    wanted = tables["lips"].where("MATNR = 5").select("VBELN", "POSNR").distinct()
    assert shown(keys) == shown(wanted) and keys.count() > 0
    part = restrict(facts.MOT_GRAPH, tables, keys)
    assert part["mara"].count() < tables["mara"].count() / 4
    assert part["likp"].count() == wanted.select("VBELN").distinct().count()
    from strata.operators.propagate import touched
    plan = touched(facts.MOT_GRAPH, tables, {"mara": one}, "lips", ["VBELN", "POSNR"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in text


def test_job_with_a_merging_sink(spark):
    """Without deletions only the partitions of recomputed rows are written; a
    deleted row is deleted."""
    old = {"lips": [(k, 1, k % 3, 1.0, "EA") for k in range(40)], "likp": [(k, k % 5, 2) for k in range(40)],
           "vbak": [(k, 3) for k in range(5)], "mara": [(k, "01") for k in range(3)]}
    sink = PartitionedSink(spark, "changes_db", "part", stable_keys=True)
    log = RunLog(SnapshotSink(spark, "changes_log"))

    def with_part(i):
        return build(i).withColumn("part", key_range("delivery_number", 10))

    def run(now, before=None):
        tables = frames(spark, now)
        changes = {} if before is None else {
            n: changed_rows(f, tables[n]) for n, f in frames(spark, before).items() if before[n] != now[n]}
        n = jobs.run_fact_changes_job(spark, sink, log, "fact", with_part, facts.MOT_GRAPH, tables, changes)
        assert shown(sink.read("fact")) == shown(with_part(tables))
        return n

    assert run(old) == 40
    files = set(sink.read("fact").inputFiles())
    new = old | {"likp": [(k, k % 5, 9 if k == 7 else 2) for k in range(40)]}
    assert run(new, old) == 1
    assert len(set(sink.read("fact").inputFiles()) & files) >= 3  # three of four parts as they were
    gone = new | {"lips": new["lips"][1:]}
    assert run(gone, new) == 0
    assert run(gone, gone) == 0
