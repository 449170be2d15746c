import uuid

from pyspark.sql import functions as F

from strata.functions.sql_functions import create_security_functions
from strata.operators import security as sec
from strata.sources import fixtures as fx

from conftest import SF001


def test_sql_filter_functions_match_dataframe_filter(spark):
    db = "fn_" + uuid.uuid4().hex[:6]
    spark.sql(f"CREATE DATABASE {db}")
    me = sec.current_principal(spark)
    lob = fx.lob_group_map(spark)
    lob.write.saveAsTable(f"{db}.lob_group_map")
    t = fx.TestTables(spark, SF001)
    fx.legal_entity_group_map(t).write.saveAsTable(f"{db}.legal_entity_group_map")
    fx.asset_group_map(t).write.saveAsTable(f"{db}.asset_group_map")
    members = spark.createDataFrame([(me, "grp-lob-gf"), (me, "grp-entity-r0"),
                                     (me, "uat-business-owners")],
                                    "principal string, group_id string")
    members.write.saveAsTable(f"{db}.members")
    made = create_security_functions(spark, db, f"{db}.members", db, "uat-business-owners")
    assert len(made) == 4

    from strata.plans.queries import material_on_time
    material_on_time(spark, SF001).write.saveAsTable(f"{db}.fact_mot")
    by_sql = spark.sql(f"SELECT * FROM {db}.fact_mot WHERE {db}.fn_lob_filter(lob_code)")
    by_df = sec.row_filter(spark.table(f"{db}.fact_mot"), "lob_code", lob, members, me)
    assert sorted(map(tuple, by_sql.collect())) == sorted(map(tuple, by_df.collect()))
    assert {r.lob_code for r in by_sql.select("lob_code").distinct().collect()} == {"GF"}
    plan = by_sql._jdf.queryExecution().executedPlan().toString()
    assert "ExistenceJoin" in plan and "BroadcastHashJoin" in plan  # inlined

    from strata.plans.queries import spend_rename
    spend_rename(spark, SF001).write.saveAsTable(f"{db}.fact_spend")
    ent = spark.sql(f"SELECT count(*) AS n FROM {db}.fact_spend "
                    f"WHERE {db}.fn_legal_entity_filter(company_code)").first().n
    assert ent == sec.row_filter(spark.table(f"{db}.fact_spend"), "company_code",
                                 spark.table(f"{db}.legal_entity_group_map"), members,
                                 me).count() > 0

    masked = spark.sql(f"SELECT {db}.mask_pii(c_name) AS m FROM parquet.`{SF001}/customer.parquet`")
    assert masked.where(F.col("m") == sec.MASK_TEXT).count() == 0  # member sees values
