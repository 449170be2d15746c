"""Stand-ins for the reference's source tables, derived from the test tables.

The reference reads ERP, procurement, contract and logistics tables that ship
with no data.
Each function here builds a DataFrame with the same column names from the
driver's TPC-H-like parquet tables, so the real operators run over data
whose size grows with the scale factor. Every derivation is a plain
projection, filter, join or aggregate; nothing is sampled or capped.

| stand-in              | from                         | key            |
|-----------------------|------------------------------|----------------|
| likp delivery header  | lineitem grouped by order    | VBELN          |
| lips delivery item    | lineitem                     | VBELN, POSNR   |
| vbak sales order      | orders, status <> 'P'        | VBELN          |
| mara material         | part, division from brand no | MATNR          |
| arb_spend_lines       | lineitem x supplier x nation | EBELN, EBELP   |
| clm_contract_lines    | orders with status 'F'       | po_number      |
| clm lines (repeated)  | lineitem, returned items     | po_number (n)  |
| asset movements       | lineitem x orders            | movement_id    |
| assets                | supplier                     | asset_id       |
| entity / asset maps   | supplier x nation x region   | code           |
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.control import seed_rows_frame
from strata.operators.sizing import small_side
from strata.sources.local import config_frame

@dataclass
class TestTables:
    """Lazy reader of ``{sf_dir}/{name}.parquet``."""

    __test__ = False  # not a pytest class
    spark: SparkSession
    root: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")


# ── plan domain: material on time ───────────────────────────────────────────

def delivery_header(t: TestTables) -> DataFrame:
    """likp: one delivery per order; goods issue when its last line shipped.

    Partial aggregation on l_orderkey keeps the shuffle to one row per order
    per map task, whatever the skew of the key.
    """
    return (t("lineitem").groupBy("l_orderkey")
            .agg(F.max("l_shipdate").alias("WADAT_IST"))
            .select(F.col("l_orderkey").alias("VBELN"),
                    F.col("l_orderkey").alias("VGBEL"),
                    F.col("WADAT_IST")))


def delivery_items(t: TestTables, compared: bool = False) -> DataFrame:
    """lips: delivery items (``compared``: see :func:`spend_lines`)."""
    li = t("lineitem")
    if compared:
        li = li.repartition("l_orderkey", "l_partkey")
    return li.select(
        F.col("l_orderkey").alias("VBELN"),
        F.col("l_linenumber").alias("POSNR"),
        F.col("l_partkey").alias("MATNR"),
        F.col("l_quantity").alias("LFIMG"),
        F.lit("EA").alias("VRKME"),
    )


def sales_orders(t: TestTables) -> DataFrame:
    """vbak: confirmed sales orders; pending ('P') ones are not yet in ERP."""
    return (t("orders").where(F.col("o_orderstatus") != F.lit("P"))
            .select(F.col("o_orderkey").alias("VBELN"),
                    F.col("o_orderdate").alias("VDATU")))


def materials(t: TestTables) -> DataFrame:
    """mara: division code = two-digit brand number ('Brand#2' -> '02')."""
    return t("part").select(
        F.col("p_partkey").alias("MATNR"),
        F.lpad(F.regexp_extract("p_brand", r"(\d+)", 1), 2, "0").alias("SPART"),
    )


# ── sourcing domain: spend ──────────────────────────────────────────────────

def supplier_company(t: TestTables) -> DataFrame:
    """Supplier -> company code (its nation); NULL for negative balances."""
    return (t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey"),
                    F.when(F.col("s_acctbal") >= 0, F.col("n_name")).alias("BUKRS")))


def spend_lines(t: TestTables, compared: bool = False) -> DataFrame:
    """arb_spend_lines: PO lines with procurement column codes. Lines to be
    ``compared`` with others made from the same ones are partitioned first, by
    columns that do not change: one shuffle serves both sides."""
    li = t("lineitem")
    if compared:
        li = li.repartition("l_orderkey", "l_suppkey")
    return (li.join(small_side(supplier_company(t)), li["l_suppkey"] == F.col("s_suppkey"))
            .select(
                F.col("l_orderkey").alias("EBELN"),
                F.col("l_linenumber").alias("EBELP"),
                F.col("BUKRS"),
                F.col("l_suppkey").alias("LIFNR"),
                F.col("l_partkey").alias("MATNR"),
                F.col("l_quantity").alias("MENGE"),
                F.col("l_extendedprice").alias("NETWR"),
                F.lit("USD").alias("WAERS"),
                F.col("l_shipdate").alias("BEDAT"),
                F.col("l_shipdate").alias("ERDAT"),
            ))


def contract_lines(t: TestTables) -> DataFrame:
    """clm_contract_lines: one contract per fulfilled order (unique po_number)."""
    return (t("orders").where(F.col("o_orderstatus") == F.lit("F"))
            .select(F.col("o_orderkey").alias("po_number"),
                    F.concat(F.lit("CT-"), F.col("o_orderkey").cast("string")).alias("contract_id"),
                    F.col("o_orderpriority").alias("contract_type")))


def repeated_contract_lines(t: TestTables) -> DataFrame:
    """Contract lines with several rows per PO (claims on returned items)."""
    return (t("lineitem").where(F.col("l_returnflag") == F.lit("R"))
            .select(F.col("l_orderkey").alias("po_number"),
                    F.concat_ws("-", F.lit("CL"), F.col("l_orderkey").cast("string"),
                                F.col("l_linenumber").cast("string")).alias("contract_id"),
                    F.col("l_linestatus").alias("contract_type"),
                    F.col("l_shipdate").alias("signed_at")))


# ── deliver domain: asset logistics ─────────────────────────────────────────────────────────────────────────────────

def asset_movements(t: TestTables) -> DataFrame:
    """kabal_asset_movements: each line is a movement by its supplier's asset."""
    li, o = t("lineitem"), t("orders")
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"])
            .select(
                F.concat_ws("-", F.col("l_orderkey").cast("string"),
                            F.col("l_linenumber").cast("string")).alias("movement_id"),
                F.col("l_suppkey").cast("string").alias("asset_id"),
                F.col("l_returnflag").alias("movement_type"),
                F.concat(F.lit("WH-"), F.col("l_linestatus")).alias("origin_location"),
                F.concat(F.lit("CU-"), F.col("o_custkey").cast("string")).alias("destination_location"),
                F.col("o_orderdate").alias("planned_departure_dt"),
                F.col("l_shipdate").alias("actual_departure_dt"),
                F.col("o_orderdate").alias("planned_arrival_dt"),
                F.col("l_shipdate").alias("actual_arrival_dt"),
                F.col("l_quantity").alias("cargo_weight_kg"),
                F.col("l_extendedprice").alias("cargo_volume_m3"),
            ))


def assets(t: TestTables) -> DataFrame:
    """kabal_assets."""
    return t("supplier").select(F.col("s_suppkey").cast("string").alias("asset_id"),
                                F.col("s_name").alias("asset_name"))


# ── group maps and membership ───────────────────────────────────────────────

def lob_group_map(spark: SparkSession, with_refinery: bool = True,
                  refinery_rolled_back: bool = True) -> DataFrame:
    """LOB map as the migrations leave it: 0003 seed, 0005 RF, RF rollback."""
    from strata.operators.control import LOB_SEED, LOB_REFINERY, soft_delete
    rows = list(LOB_SEED) + ([LOB_REFINERY] if with_refinery else [])
    m = seed_rows_frame(spark, "lob_group_map", rows)
    if with_refinery and refinery_rolled_back:
        m = soft_delete(m, F.col("lob_code") == F.lit("RF"), by="rollback-0005",
                        at=F.lit("2026-01-01 00:00:00").cast("timestamp"))
    return m


def legal_entity_group_map(t: TestTables) -> DataFrame:
    """One mapping per legal entity our suppliers belong to (their nation, the
    company code the spend fact carries), granted to the region's group, plus
    GLOBAL. Derived with a distinct over the supplier table."""
    s, n, r = t("supplier"), t("nation"), t("region")
    per_entity = (s.join(n, s["s_nationkey"] == n["n_nationkey"])
                  .join(r, n["n_regionkey"] == r["r_regionkey"])
                  .select(F.col("n_name").alias("company_code"),
                          F.col("n_name").alias("entity_name"),
                          F.concat(F.lit("grp-entity-r"), F.col("r_regionkey").cast("string"))
                          .alias("entra_group_id"),
                          F.lit("ENTITY").alias("scope"))
                  .distinct())
    glob = seed_rows_frame(t.spark, "legal_entity_group_map", [
        ("GLOBAL", "All entities", "grp-entity-global", "GLOBAL")])
    return _with_map_defaults(per_entity, "legal_entity_group_map").unionByName(glob)


def asset_group_map(t: TestTables) -> DataFrame:
    """One mapping per supplier asset, granted to its nation's group, plus GLOBAL."""
    per_asset = t("supplier").select(
        F.col("s_suppkey").cast("string").alias("asset_id"),
        F.col("s_name").alias("asset_name"),
        F.concat(F.lit("grp-asset-n"), F.col("s_nationkey").cast("string")).alias("entra_group_id"),
        F.lit("ASSET").alias("scope"))
    glob = seed_rows_frame(t.spark, "asset_group_map", [
        ("GLOBAL", "All assets", "grp-asset-global", "GLOBAL")])
    return _with_map_defaults(per_asset, "asset_group_map").unionByName(glob)


def _with_map_defaults(df: DataFrame, table: str) -> DataFrame:
    from strata.operators.control import apply_defaults
    return apply_defaults(df, table)


# Membership rows used by the registered queries (principal, group).
MEMBERSHIP = [
    ("ana", "grp-lob-up"), ("ana", "grp-lob-gf"),
    ("gil", "grp-lob-global"), ("gil", "grp-entity-global"), ("gil", "grp-asset-global"),
    ("eve", "grp-entity-r0"), ("eve", "grp-entity-r3"),
    ("ash", "grp-asset-n7"), ("ash", "grp-asset-n11"),
    ("rita", "grp-lob-rf"),
    ("bo", "uat-business-owners"),
]


def membership(spark: SparkSession) -> DataFrame:
    return config_frame(spark, MEMBERSHIP, "principal string, group_id string")



# ── landing tables of the harmonise job ─────────────────────────────────────

def blp_landing(t: TestTables) -> dict[str, DataFrame]:
    """Raw landing tables for the six BLP specs, with their watermark columns
    (AEDAT for purchasing, ERDAT for deliveries and sales orders, LAEDA for
    materials), derived from the test tables."""
    spend = spend_lines(t)
    return {
        "ekko_raw": spend.groupBy("EBELN").agg(F.max("ERDAT").alias("AEDAT")),
        "ekpo_raw": spend.select("EBELN", "EBELP", "MATNR", "MENGE", "NETWR",
                                 F.col("ERDAT").alias("AEDAT")),
        "likp_raw": delivery_header(t).withColumn("ERDAT", F.col("WADAT_IST")),
        "lips_raw": t("lineitem").select(
            F.col("l_orderkey").alias("VBELN"), F.col("l_linenumber").alias("POSNR"),
            F.col("l_partkey").alias("MATNR"), F.col("l_quantity").alias("LFIMG"),
            F.lit("EA").alias("VRKME"), F.col("l_shipdate").alias("ERDAT")),
        "vbak_raw": sales_orders(t).withColumn("ERDAT", F.col("VDATU")),
        "mara_raw": materials(t).withColumn("LAEDA", F.lit("2024-01-01").cast("date")),
    }
