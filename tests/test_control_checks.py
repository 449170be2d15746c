import pytest
from pyspark.sql import functions as F

from strata.operators import checks, control
from strata.sources import registry


def test_seed_defaults_and_soft_delete(spark):
    m = control.seed_rows_frame(spark, "lob_group_map",
                                [("UP", "Upstream", "g1", "LOB")])
    r = m.first()
    assert r.is_active is True and r.updated_by is None and r.created_at is not None
    d = control.soft_delete(m, F.col("lob_code") == "UP", by="rb",
                            at=F.lit("2026-01-01 00:00:00")).first()
    assert d.is_active is False and d.updated_by == "rb"
    keep = control.soft_delete(m, F.col("lob_code") == "XX", by="rb").first()
    assert keep.is_active is True and keep.updated_by is None
    with pytest.raises(ValueError):
        control.apply_defaults(m.withColumn("bogus", F.lit(1)), "lob_group_map")


def test_ddl_text_has_constraints():
    ddl = control.table_ddl_columns("orchestration_config")
    assert "first_load_complete BOOLEAN NOT NULL DEFAULT false" in ddl
    assert "dependency_tables ARRAY<STRING>" in ddl


def test_pending_migrations(spark):
    specs = spark.createDataFrame(
        [(1, "0001_a.sql", "p/0001_a.sql"), (2, "0002_b.sql", "p/0002_b.sql"),
         (3, "0003_c.sql", "p/0003_c.sql"), (3, "0003_c_rollback.sql", "p/x")],
        "sequence int, migration_id string, filename string")
    ledger = spark.createDataFrame(
        [("0001_a.sql", "f", None, "prod", "success", None),
         ("0002_b.sql", "f", None, "prod", "failed", "boom"),
         ("0003_c.sql", "f", None, "uat", "success", None)],
        "migration_id string, filename string, applied_at timestamp, environment string, "
        "status string, error_message string")
    got = [r.migration_id for r in control.pending_migrations(specs, ledger, "prod").collect()]
    assert got == ["0002_b.sql", "0003_c.sql"]  # failed retried, other env ignored


def test_due_list(spark):
    cfg = spark.createDataFrame(
        [("a", True, None, 1, True), ("b", True, ["a"], 2, False), ("c", True, ["b"], 3, False),
         ("d", False, None, 0, False)],
        "table_id string, is_active boolean, dependency_tables array<string>, run_order int, "
        "first_load_complete boolean")
    cfg = cfg.withColumns({"load_type": F.lit("delta"), "watermark_column": F.lit(None),
                           "watermark_value": F.lit(None)})
    got = [(r.table_id, r.ready) for r in control.due_list(cfg).collect()]
    assert got == [("a", True), ("b", True), ("c", False)]


def test_schema_drift(spark):
    a = spark.createDataFrame([], "k long, v string, gone int")
    b = spark.createDataFrame([], "k long, v int, new string")
    drift = control.schema_drift(control.schema_rows(spark, "t", b),
                                 control.schema_rows(spark, "t", a))
    got = sorted((r.column, r.change) for r in drift.collect())
    assert got == [("gone", "removed"), ("new", "added"), ("v", "retyped")]


def test_registry_lookup(spark):
    b = registry.bindings_frame(spark)
    assert registry.valid_bindings(b).count() == 11
    tables = spark.createDataFrame([("plan", "fact_mot"), ("plan", "dim_x"), ("euh_BLP", "*")],
                                   "schema string, table string")
    got = {(r.table, r.action, r.filter_column)
           for r in registry.binding_lookup(tables, b).collect()}
    assert got == {("fact_mot", "BIND", "lob_code"), ("dim_x", "SKIPPED", None),
                   ("*", "SKIPPED", None)}
    assert registry.binding_for(b, "plan", "fact_mot")["row_filter"] == "fn_lob_filter"
    assert registry.binding_for(b, "plan", "nope") is None


def test_environment_schemas_find_prod_bindings(spark):
    b = registry.bindings_frame(spark)
    for schema in ("plan", "stable_plan", "feat_spend_v2_plan"):
        assert registry.binding_for(b, schema, "fact_mot")["filter_column"] == "lob_code"
    assert registry.logical_schema("euh_BLP_A59") == "euh_BLP"
    assert registry.logical_schema("euh_prod_mirror_KBL") == "euh_KBL"
    assert registry.logical_schema("feat_x_unknown") == "feat_x_unknown"
    assert registry.logical_schema("spark_catalog.feat_x_plan") == "plan"  # catalog prefix
    assert registry.binding_for(b, "spark_catalog.plan", "fact_mot")["filter_column"] == \
        "lob_code"
    tables = spark.createDataFrame([("stable_plan", "fact_mot"),
                                    ("cat.feat_a_deliver", "fact_kabal_logistics"),
                                    ("stable_plan", "dim_x")], "schema string, table string")
    got = {(r.schema, r.table, r.action) for r in registry.binding_lookup(tables, b).collect()}
    assert got == {("stable_plan", "fact_mot", "BIND"),
                   ("cat.feat_a_deliver", "fact_kabal_logistics", "BIND"),
                   ("stable_plan", "dim_x", "SKIPPED")}


def test_contract_findings_and_raise(spark):
    b = registry.bindings_frame(spark)
    ok = spark.createDataFrame([], "movement_id string, asset_id string")
    dropped = spark.createDataFrame([], "movement_id string, asset_ref string")
    outputs = {("deliver", "fact_kabal_logistics"): dropped, ("plan", "dim_new"): ok}
    cols = checks.output_columns(spark, outputs)
    tables = cols.select("schema", "table").distinct()
    f = checks.contract_findings(tables, cols, b)
    got = sorted((r.severity, r.table) for r in f.collect())
    assert got == [("error", "fact_kabal_logistics"), ("warning", "dim_new")]
    with pytest.raises(checks.ContractError):
        checks.raise_on_errors(f)
    fixed = checks.output_columns(spark, {("deliver", "fact_kabal_logistics"): ok})
    clean = checks.contract_findings(fixed.select("schema", "table").distinct(), fixed, b)
    assert checks.raise_on_errors(clean).count() == 0


def test_null_counts_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.column_name: r.null_count for r in checks.null_counts(df, ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 2}
    assert checks.null_findings(df, "s", "t", ["a"]).count() == 1
    with pytest.raises(ValueError):
        checks.require_params(catalog="c", schema="")


def test_bindings_from_yaml(spark, tmp_path):
    f = tmp_path / "bindings.yaml"
    f.write_text("table_bindings:\n"
                 "  - schema: plan\n    table: fact_mot\n    row_filter: fn_lob_filter\n"
                 "    filter_column: lob_code\n    domain: plan\n    group: MSC\n"
                 "  - schema: euh_BLP\n    table: \"*\"\n    row_filter: none\n"
                 "    filter_column: none\n    domain: EUH\n    group: MSVC\n")
    b = registry.bindings_from_yaml(spark, str(f))
    assert b.count() == 2 and registry.valid_bindings(b).count() == 1
    assert registry.binding_for(b, "stable_plan", "fact_mot")["row_filter"] == "fn_lob_filter"


def test_every_error_is_reported(spark):
    rows = [("error", "s", f"t{i}", "d") for i in range(30)]
    f = spark.createDataFrame(rows, "severity string, schema string, table string, detail string")
    with pytest.raises(checks.ContractError) as e:
        checks.raise_on_errors(f)
    assert all(f"s.t{i}: d" in str(e.value) for i in range(30)) and "30 errors" in str(e.value)
