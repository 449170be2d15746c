"""Secured views over facts stored by their filter column."""

import uuid

import pytest

from oracle_compare import duck, duck_digest, spark_digest

import __spark_entry__ as E
from strata.operators import security as sec
from strata.plans import entrypoints as ep
from strata.plans import jobs
from strata.sinks.audit import RunLog
from strata.sinks.partitioned import PartitionedSink
from strata.sinks.publish import SnapshotSink
from strata.sources.registry import bindings_frame

SF = "/root/testdata/sf0.001"
MAP = [("UP", "g-up", "LOB", True), ("DS", "g-ds", "LOB", True), ("GF", "g-up", "LOB", False),
       ("GLOBAL", "g-all", "GLOBAL", True), (None, "g-up", "LOB", True)]
FACT = [("UP", 1), ("UP", 2), ("DS", 3), ("GF", 4), (None, 5), ("XX", 6)]


def scans(df):
    """(last part of the root path, files read, rows read) of each executed file scan."""
    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(plan.plan())
        out = []
        if kind == "FileSourceScanExec":
            m = plan.metrics()
            out.append((str(plan.tableIdentifier()), m.apply("numFiles").value(), m.apply("numOutputRows").value()))
        for i in range(plan.children().size()):
            out += walk(plan.children().apply(i))
        return out
    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


@pytest.fixture
def published(spark):
    """A fact stored by its filter column behind the view that the job makes;
    call it with the reader's groups."""
    name = f"pruned_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}_config")
    spark.createDataFrame(MAP, "lob_code string, entra_group_id string, scope string, is_active boolean") \
        .write.saveAsTable(f"{name}_config.lob_group_map")
    spark.createDataFrame([], "principal string, group_id string").write.saveAsTable(f"{name}_config.group_membership")
    sink = PartitionedSink(spark, name, "lob_code")
    rules = jobs.SecurityConfig(bindings_frame(spark), f"{name}_config", schema_name="plan")
    fact = spark.createDataFrame(FACT, "lob_code string, v int")
    jobs.run_fact_job(spark, sink, RunLog(SnapshotSink(spark, f"{name}_config")), "fact_mot",
                      lambda: fact, ["v"], "full", rules)
    me = sec.current_principal(spark)

    def read(*groups):
        spark.createDataFrame([(me, g) for g in groups] + [("other", "g-all")],
                              "principal string, group_id string") \
            .write.mode("overwrite").insertInto(f"{name}_config.group_membership")
        return spark.table(f"{name}.fact_mot")
    return read


@pytest.mark.parametrize("groups,rows", [
    (["g-up"], [1, 2]), (["g-up", "g-ds"], [1, 2, 3]), (["g-none"], []), ([], []),
    (["g-all"], [1, 2, 3, 4, 5, 6]), (["g-up", "g-all"], [1, 2, 3, 4, 5, 6])])
def test_rows_of_each_reader(published, groups, rows):
    assert sorted(r["v"] for r in published(*groups).collect()) == rows


def test_scan_reads_permitted_partitions_only(published):
    df = published("g-ds")
    read = [s for s in scans(df) if "fact_mot" in s[0]]
    assert sum(rows for _, _, rows in read) == 1 and sum(files for _, files, _ in read) == 1
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()


def test_global_reader_reads_the_fact_once(published):
    read = [s for s in scans(published("g-all", "g-up")) if "fact_mot" in s[0]]
    assert sum(rows for _, _, rows in read) == len(FACT)


def test_grants_are_read_at_execution(published, spark):
    df = published("g-up")
    published("g-ds")
    assert [r["v"] for r in df.collect()] == [3]


@pytest.mark.parametrize("query", ["pruned_fact_mot", "pruned_fact_spend", "pruned_fact_spend_global"])
def test_queries(spark, query):
    assert spark_digest(E.queries()[query](spark, SF)) == duck_digest(duck(SF), E.oracle_sql()[query])


def test_readers_of_the_previous_data_table(spark):
    """A frame resolved before a second full load can still be read; the table
    before that one is gone."""
    sink = ep.make_sink(spark, f"kept_{uuid.uuid4().hex[:8]}", "partitioned:p")
    frames = []
    for n in range(1, 4):
        sink.publish(spark.createDataFrame([(n, "a")], "k int, p string"), "t")
        frames.append(sink.read("t"))
    assert [r["k"] for r in frames[1].collect()] == [2] and [r["k"] for r in frames[2].collect()] == [3]
    left = [t.name for t in spark.catalog.listTables(sink.database) if "__data" in t.name]
    assert sorted(left) == ["t__data_2", "t__data_3"]


def test_rebinding_follows_the_sink(spark, published):
    """apply_row_filter on a table of the partitioned sink gives the pruned view."""
    assert sorted(r["v"] for r in published("g-up").collect()) == [1, 2]
    name = next(d.name for d in spark.catalog.listDatabases()
                if d.name.startswith("pruned_") and not d.name.endswith("_config")
                and spark.catalog.tableExists(f"{d.name}.fact_mot"))
    sink = ep.make_sink(spark, name, "partitioned:lob_code")
    rules = jobs.SecurityConfig(bindings_frame(spark), f"{name}_config", schema_name="plan")
    assert jobs.publish_public_view(sink, "fact_mot", rules, sink.read("fact_mot").columns) == "FILTERED"
    text = spark.sql(f"SHOW CREATE TABLE {name}.fact_mot").first()[0]
    assert "LEFT SEMI JOIN" in text
