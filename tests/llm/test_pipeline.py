"""The stages on a small corpus with planted cases, and on a given table."""
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from strata.llm import decontaminate, secret_scan, simhash
from strata.llm.queries import source_owner

SF = "/root/testdata/sf0.001"


def test_stage_order_and_names():
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination",
                                        "secret_scan", "packing"]
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is P.run


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in P.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def test_all_but_the_last_return_documents(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns
        assert [f.dataType for f in df.schema] == [f.dataType for f in steps[0].schema]


def test_decisions_take_effect(spark, steps):
    docs, calm, unique, clean, masked, packed = steps
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in steps]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] == ids[4] == ids[5]
    near = simhash.near_duplicates(calm).collect()
    assert ids[2] == {r.component_id for r in near}  # one of each group
    bad = {r.doc_id for r in decontaminate.contamination(
        unique, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
    assert ids[3] == ids[2] - bad
    assert secret_scan.findings(masked, *source_owner()).where("kind != 'owned'").count() == 0
    assert masked.where(F.col("n_chars") != F.length("text")).count() == 0


def test_run_gives_the_last_stage(spark, steps):
    got = P.run(spark, SF).drop("sequence_id")
    # partitions may differ, so sequences may; documents and their tokens do not
    want = steps[-1].groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"))
    assert sorted(map(tuple, got.groupBy("doc_id", "doc_tokens").agg(F.sum("length")).collect())) == sorted(
        map(tuple, want.collect()))


def test_stages_bear_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (2, None, "en", "s", None, 1),
         (3, "a b", None, None, 3, 1), (3, "a b", None, None, 3, 1), (4, "w " * 30_000, "de", "s", 60_000, 1)],
        "doc_id long, text string, lang string, source string, n_chars long, component_id int")
    df = docs
    for _, stage in P.STAGES[:-1]:
        df = stage(spark, df, SF)
        assert df.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect()) == [
        (False, 1), (False, 3), (False, 4), (True, 0)]
    assert P.STAGES[-1][1](spark, df, SF).where("doc_id = 3").count() >= 1
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_the_rest_imports_without_the_subpackage(spark):
    import subprocess
    code = ("import sys; sys.modules['corpus_pipeline'] = None; "
            "import importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('strata.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "del sys.modules['corpus_pipeline']; sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "q = e.queries(); assert q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=sys.path[0] or ".",
                   env={**__import__("os").environ, "PYTHONPATH": ":".join(p for p in sys.path if p)})
