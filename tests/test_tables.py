import uuid

from strata.sinks import control_tables as ct
from strata.sources.tables import full_name, optional_table, read_parquet_table, read_table, \
    table_exists

from conftest import SF001


def test_scans_by_name_optional_and_exists(spark):
    db = "tb_" + uuid.uuid4().hex[:6]
    spark.sql(f"CREATE DATABASE {db}")
    spark.range(3).write.saveAsTable(full_name(db, "t"))
    assert full_name("", db, "t") == f"{db}.t" and full_name("c", db, "t") == f"c.{db}.t"
    assert read_table(spark, f"{db}.t").count() == 3
    assert table_exists(spark, f"{db}.t") and not table_exists(spark, f"{db}.nope")
    assert optional_table(spark, "", "t") is None                 # SRC-2: not configured
    assert optional_table(spark, db, "t").count() == 3
    assert read_parquet_table(spark, SF001, "region").count() == 5


def test_migration_specs_concatenate_folders(spark):
    migs = [ct.Migration(2, "0002_x.sql", (), "curated"),
            ct.Migration(1, "0001_y.sql", (), "platform"),
            ct.Migration(1, "0001_y_rollback.sql", (), "platform"),
            ct.Migration(3, "0003_z.sql", (), "euh")]
    specs = ct.migration_specs(spark, migs)
    assert [r.folder for r in specs.collect()] == ["platform", "platform", "euh", "curated"]
    assert specs.count() == 4
