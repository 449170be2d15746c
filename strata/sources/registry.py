"""Row-filter binding registry (SRC-4, FLT-5, JN-9).

The registry is a small config table ``(schema, table, row_filter,
filter_column, domain, group, notes)``. It is held as a DataFrame and
joined, never looped over.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.local import config_frame

BINDING_SCHEMA = ("schema string, table string, row_filter string, filter_column string, "
                  "domain string, group string, notes string")

# The reference's binding registry, in its order (schema,
# table, filter function, filter column, domain, group; free-text notes are
# not carried).
DEFAULT_BINDINGS = [
    ("sourcing", "fact_spend", "fn_legal_entity_filter", "company_code", "sourcing",
     "Ariba/CLM", None),
    ("sourcing", "fact_contracts", "fn_legal_entity_filter", "company_code", "sourcing",
     "Ariba/CLM", None),
    ("sourcing", "fact_sourcing_events", "fn_legal_entity_filter", "company_code", "sourcing",
     "Ariba/CLM", None),
    ("sourcing", "fact_po_lines", "fn_legal_entity_filter", "company_code", "sourcing",
     "Spend", None),
    ("plan", "fact_mot", "fn_lob_filter", "lob_code", "plan", "MSC", None),
    ("plan", "fact_demand_plan", "fn_lob_filter", "lob_code", "plan", "MSC", None),
    ("deliver", "fact_rtp_plan", "fn_lob_filter", "lob_code", "deliver", "RTP", None),
    ("deliver", "fact_rtp_actual", "fn_lob_filter", "lob_code", "deliver", "RTP", None),
    ("deliver", "fact_shipments", "fn_lob_filter", "lob_code", "deliver", "RTP", None),
    ("deliver", "fact_kabal_logistics", "fn_asset_filter", "asset_id", "deliver", "Kabal", None),
    ("deliver", "fact_adc_delivery", "fn_asset_filter", "asset_id", "deliver", "ADC", None),
    ("euh_BLP", "*", "none", "none", "EUH", "MSVC", None),
]


# The six curated domains and the environment schema patterns
# (UAT "stable_<domain>", dev "feat_<feature>_<domain>", EUH "euh_<SRC>_<ENV>"
# and the UAT mirror "euh_prod_mirror_<SRC>").
DOMAINS = ("plan", "sourcing", "deliver", "master", "config", "mapping")
_FEAT = re.compile(r"^feat_.+_(" + "|".join(DOMAINS) + r")$")
_EUH_MIRROR = re.compile(r"^euh_prod_mirror_([A-Za-z0-9]+)$")
_EUH_ENV = re.compile(r"^(euh_[A-Za-z0-9]+)_[A-Za-z0-9]+$")


def logical_schema(schema: str) -> str:
    """Registry key of an environment schema (Q4): ``stable_plan`` and
    ``feat_x_plan`` -> ``plan``; ``euh_BLP_A59`` / ``euh_prod_mirror_BLP`` ->
    ``euh_BLP``. Registry lookups use this, so dev/UAT tables find the same
    binding as prod instead of silently skipping their row filter. A catalog
    prefix (``spark_catalog.plan``) is ignored."""
    schema = schema.rsplit(".", 1)[-1]
    if schema.startswith("stable_") and schema[len("stable_"):] in DOMAINS:
        return schema[len("stable_"):]
    m = _FEAT.match(schema)
    if m:
        return m.group(1)
    m = _EUH_MIRROR.match(schema)
    if m:
        return f"euh_{m.group(1)}"
    m = _EUH_ENV.match(schema)
    if m:
        return m.group(1)
    return schema


def logical_schema_col(schema: F.Column) -> F.Column:
    """Column form of :func:`logical_schema` (for joins over many tables)."""
    schema = F.substring_index(schema, ".", -1)
    dom = F.regexp_extract(schema, r"^(?:stable_|feat_.+_)(" + "|".join(DOMAINS) + r")$", 1)
    mirror = F.regexp_extract(schema, _EUH_MIRROR.pattern, 1)
    env = F.regexp_extract(schema, _EUH_ENV.pattern, 1)
    return (F.when(dom != "", dom).when(mirror != "", F.concat(F.lit("euh_"), mirror))
            .when(env != "", env).otherwise(schema))


def bindings_frame(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """SRC-4: the registry as a DataFrame."""
    return config_frame(spark, DEFAULT_BINDINGS if rows is None else rows, BINDING_SCHEMA)


def bindings_from_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Read a registry YAML file (``table_bindings: [...]``) if PyYAML exists."""
    try:
        import yaml  # type: ignore
    except ImportError as e:  # pragma: no cover - optional dependency
        raise RuntimeError("PyYAML is not installed; pass rows to bindings_frame") from e
    with open(path) as f:
        doc = yaml.safe_load(f)
    rows = [(b.get("schema"), b.get("table"), b.get("row_filter"), b.get("filter_column"),
             b.get("domain"), b.get("group"), b.get("notes"))
            for b in doc.get("table_bindings", [])]
    return bindings_frame(spark, rows)


def valid_bindings(bindings: DataFrame) -> DataFrame:
    """FLT-5: bindings with a real filter (not empty, not ``none``)."""
    rf = F.col("row_filter")
    return bindings.where(rf.isNotNull() & (rf != F.lit("")) & (rf != F.lit("none")))


def binding_lookup(tables: DataFrame, bindings: DataFrame) -> DataFrame:
    """JN-9 / SEC-1 decision for many tables at once.

    ``tables`` has ``(schema, table)``; result adds the filter, its column
    and ``action`` = ``BIND`` or ``SKIPPED``.
    """
    b = valid_bindings(bindings).select(F.col("schema").alias("__key"), F.col("table").alias("__t"),
                                        "row_filter", "filter_column")
    keyed = tables.withColumn("__k", logical_schema_col(F.col("schema")))
    return (keyed.join(b, (F.col("__k") == F.col("__key")) & (F.col("table") == F.col("__t")),
                       "left").drop("__k", "__key", "__t")
            .withColumn("action", F.when(F.col("row_filter").isNotNull(), F.lit("BIND"))
                        .otherwise(F.lit("SKIPPED"))))


def binding_for(bindings: DataFrame, schema: str, table: str) -> dict | None:
    """The one binding row of a table (config-sized lookup) or ``None``."""
    schema = logical_schema(schema)
    rows = (valid_bindings(bindings)
            .where((F.col("schema") == F.lit(schema)) & (F.col("table") == F.lit(table)))
            .limit(2).collect())
    if len(rows) > 1:
        raise ValueError(f"{schema}.{table} is registered more than once")
    return rows[0].asDict() if rows else None
