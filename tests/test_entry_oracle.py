import os

import pytest

import __spark_entry__ as E
from oracle_compare import duck, duck_digest, spark_digest

from conftest import SF001
from strata.plans.queries import QUERIES as CORE

ORACLE_SF = os.environ.get("STRATA_ORACLE_SF", SF001)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "lob_code" in df.columns and set(r.lob_code for r in df.collect()) <= {"UP", "GF"}


def test_every_query_has_oracle():
    assert set(CORE) <= set(E.queries())
    assert set(CORE) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(ORACLE_SF)


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, con, name):
    """Same rows as the oracle; no row cap or sample in the analyzed plan (whole
    tables, whole texts) and no Python evaluating data in the executed one."""
    df = E.queries()[name](spark, ORACLE_SF)
    got = spark_digest(df)
    want = duck_digest(con, E.oracle_sql()[name])
    assert got[:2] == want[:2]
    assert got == want
    execution = df._jdf.queryExecution()
    analyzed = execution.analyzed().toString()
    assert "Limit" not in analyzed and "Sample" not in analyzed, analyzed[:2000]
    plan = execution.executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan
