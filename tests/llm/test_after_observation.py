"""Every query in a session whose listeners hold an Observation: what a query
sends to its tasks must not reach the session."""
import pytest
from pyspark.sql import functions as F

from strata.llm.queries import QUERIES
from strata.sinks.audit import observe_rows, observed_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def observed(spark):
    df, seen = observe_rows(spark.range(5))
    df.write.format("noop").mode("overwrite").save()
    assert observed_rows(seen) == 5
    return spark


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_after_an_observation(observed, name):
    df = QUERIES[name](observed, SF)
    assert df.agg(F.count("*")).first()[0] > 0
