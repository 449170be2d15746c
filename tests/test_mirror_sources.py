import tempfile
import uuid

import pytest

from strata.operators.security import MASK_TEXT, current_principal
from strata.sinks.mirror import mirror_schema
from strata.sinks.publish import SnapshotSink
from strata.sources.external import SourceSystem, read_jdbc, read_source_table


def test_deep_and_shallow_mirror_with_masking(spark):
    src = "m_src_" + uuid.uuid4().hex[:6]
    spark.sql(f"CREATE DATABASE {src}")
    spark.createDataFrame([(1, "alice"), (2, None)], "id long, name string") \
        .write.saveAsTable(f"{src}.customer")
    spark.createDataFrame([(1, "x")], "id long, code string").write.saveAsTable(f"{src}.codes")
    me = current_principal(spark)
    spark.createDataFrame([(me, "uat-developers")], "principal string, group_id string") \
        .write.saveAsTable(f"{src}.members")
    sink = SnapshotSink(spark, "m_uat_" + uuid.uuid4().hex[:6])
    names = mirror_schema(spark, src, sink, modified=["customer"], context=["codes"],
                          masked=["name"], allowed_groups=["uat-business-owners"],
                          membership_table=f"{src}.members")
    dev_view = spark.table(names["customer"]).orderBy("id").collect()
    assert [r.name for r in dev_view] == [MASK_TEXT, MASK_TEXT]
    assert sink.versions("customer") == [1] and sink.versions("codes") == []
    # business owner sees real values (membership decided at query time)
    spark.createDataFrame([(me, "uat-business-owners")], "principal string, group_id string") \
        .write.mode("append").saveAsTable(f"{src}.members")
    assert [r.name for r in spark.table(names["customer"]).orderBy("id").collect()] == \
        ["alice", None]
    # shallow mirror follows the source
    spark.createDataFrame([(2, "y")], "id long, code string") \
        .write.mode("append").saveAsTable(f"{src}.codes")
    assert spark.table(sink.base_view("codes")).count() == 2


def test_source_registry_dispatch(spark):
    lake = tempfile.mkdtemp(prefix="lake-")
    spark.range(5).write.mode("overwrite").parquet(f"{lake}/t")
    fin = SourceSystem("FIN", "lake_repoint", {"prod": lake}, "landing_FIN", "euh_FIN")
    assert read_source_table(spark, fin, "prod", "t").count() == 5
    assert fin.schema_names("A59") == ("landing_FIN_A59", "euh_FIN_A59")
    assert fin.schema_names("prod") == ("landing_FIN", "euh_FIN")
    api = SourceSystem("ARB", "api", {"prod": "https://example.invalid"})
    with pytest.raises(NotImplementedError):
        read_source_table(spark, api, "prod", "x")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://x", "t", partition_column="id")


def test_merge_into_sink_refuses_plain_parquet_after_key_checks(spark):
    from strata.operators.upsert import MergeKeyError
    from strata.sinks.merge_into import MergeIntoSink
    sink = MergeIntoSink(spark, "mi_" + uuid.uuid4().hex[:6])
    spark.sql(f"CREATE DATABASE {sink.database}")
    spark.createDataFrame([(1, "a")], "k long, v string").write.saveAsTable(sink.table("t"))
    with pytest.raises(MergeKeyError):  # same key rules as every sink
        sink.upsert(spark.createDataFrame([(None, "x")], "k long, v string"), "t", ["k"])
    with pytest.raises(Exception, match="MERGE"):
        sink.upsert(spark.createDataFrame([(1, "b")], "k long, v string"), "t", ["k"])
