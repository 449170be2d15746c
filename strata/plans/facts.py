"""Curated fact plans: spend, material on time, logistics.

Each function takes the source DataFrames and returns the fact as one lazy
logical plan; loading, securing and auditing are separate steps
(``plans.jobs``). Column names and derivations follow the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import (DIVISION_TO_LOB, UNKNOWN_LOB, code_map,
                                      on_time_flag, source_tag, typed_null)
from strata.operators.propagate import JoinGraph, Link
from strata.operators.sizing import small_side
from strata.operators.skew import (DEFAULT_HOT_KEY_ROWS, find_hot_keys, restrict_to_hot,
                                   split_hot)

# Column code -> business name of the spend fact (PRJ-1).
SPEND_RENAMES = {
    "EBELN": "po_number",
    "EBELP": "po_line_number",
    "BUKRS": "company_code",
    "LIFNR": "vendor_id",
    "MATNR": "material_id",
    "MENGE": "quantity",
    "NETWR": "net_value",
    "WAERS": "currency",
    "BEDAT": "po_date",
    "ERDAT": "created_date",
}

SPEND_KEYS = ["po_number", "po_line_number"]
MOT_KEYS = ["delivery_number", "delivery_item"]
LOGISTICS_KEYS = ["movement_id"]

# The joins of each fact, for loads that read only what changed.
MOT_GRAPH = JoinGraph("lips", ("VBELN", "POSNR"), tuple(MOT_KEYS), {
    "lips": (Link("likp", (("VBELN", "VBELN"),)), Link("mara", (("MATNR", "MATNR"),))),
    "likp": (Link("vbak", (("VGBEL", "VBELN"),)),)})
SPEND_GRAPH = JoinGraph("arb_spend_lines", ("EBELN", "EBELP"), tuple(SPEND_KEYS), {
    "arb_spend_lines": (Link("clm_contract_lines", (("EBELN", "po_number"),)),)})
LOGISTICS_GRAPH = JoinGraph("movements", ("movement_id",), tuple(LOGISTICS_KEYS), {
    "movements": (Link("assets", (("asset_id", "asset_id"),)),)})


class NonUniqueJoinSide(ValueError):
    """The right side of a lookup join repeats a key (would fan out rows)."""


def spend_lines_renamed(arb_spend: DataFrame, keep_null_company: bool = False) -> DataFrame:
    """PRJ-1 + PRJ-3 + FLT-2: procurement codes to business names, tag, drop NULL codes."""
    df = arb_spend.select(*[F.col(src).alias(dst) for src, dst in SPEND_RENAMES.items()],
                          source_tag("ARB").alias("source_id"))
    if keep_null_company:
        return df
    return df.where(F.col("company_code").isNotNull())


def dedupe_latest(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols`` tuple.

    ``max_by`` is an aggregate, so Spark combines map-side before the
    shuffle: a key holding a third of all rows still sends one partial row
    per map task, unlike a window that would sort the whole group in one task.
    """
    others = [c for c in df.columns if c != key]
    packed = F.struct(*[F.col(c) for c in others])
    order = F.struct(*[F.col(c) for c in order_cols + [c for c in others if c not in order_cols]])
    return (df.groupBy(key).agg(F.max_by(packed, order).alias("__row"))
            .select(F.col(key), *[F.col(f"__row.{c}").alias(c) for c in others]))


def assert_unique(df: DataFrame, keys: list[str], what: str) -> None:
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise NonUniqueJoinSide(f"{what}: key {dup[0].asDict()} is not unique")


def spend_fact(arb_spend: DataFrame, contracts: DataFrame | None = None,
               contract_policy: str = "check",
               contract_order: list[str] | None = None) -> DataFrame:
    """sourcing.fact_spend (JN-5, PRJ-4, PRJ-7, SRC-2).

    ``contracts`` is optional (absent source -> typed NULL columns). A
    contract table that repeats a po_number would multiply PO lines (Q8):
    ``contract_policy`` is ``"check"`` (raise, default), ``"latest"`` (keep
    the latest contract per PO by ``contract_order``) or ``"trust"``.
    """
    fact = spend_lines_renamed(arb_spend)
    if contracts is None:
        return fact.withColumns({"contract_id": typed_null("string"),
                                 "contract_type": typed_null("string")})
    if contract_policy == "latest":
        order = contract_order or ["contract_id"]
        right = dedupe_latest(contracts.select("po_number", "contract_id", "contract_type",
                                               *[c for c in order
                                                 if c not in ("po_number", "contract_id",
                                                              "contract_type")]),
                              "po_number", order)
    else:
        if contract_policy == "check":
            assert_unique(contracts, ["po_number"], "contract lines")
            contracts = small_side(contracts.select("po_number", "contract_id", "contract_type"))
        elif contract_policy != "trust":
            raise ValueError(f"unknown contract_policy {contract_policy!r}")
        right = contracts
    right = right.select("po_number", "contract_id", "contract_type")  # PRJ-7
    return fact.join(right, on="po_number", how="left")


def material_on_time_fact(deliveries: DataFrame, delivery_items: DataFrame,
                          orders: DataFrame, materials: DataFrame,
                          exclude_unknown: bool = True,
                          hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS) -> DataFrame:
    """plan.fact_mot (JN-1, JN-3, JN-4, CAS-1, CAS-2, FLT-3, PRJ-2).

    Same rows as header JOIN item LEFT JOIN order LEFT JOIN material, in an
    order that holds up at scale:

    * header LEFT JOIN order first: both are one row per delivery, no skew;
    * item LEFT JOIN material (broadcast where counted small): with FLT-3 it becomes an inner join whose
      pushed-down division filter drops most items before the next shuffle;
    * item x header last, on the delivery number. Deliveries with more than
      ``hot_key_rows`` items are joined by broadcast of their header rows
      (``operators.skew``), so a delivery holding a third of all items is
      never one task. ``hot_key_rows=None`` leaves skew to AQE alone.
    """
    d, i = deliveries.alias("d"), delivery_items.alias("i")
    o, m = orders.alias("o"), small_side(materials.select("MATNR", "SPART")).alias("m")
    dh = d.join(o, F.col("d.VGBEL") == F.col("o.VBELN"), "left").select(
        F.col("d.VBELN").alias("delivery"), F.col("o.VBELN").alias("order_number"),
        F.col("d.WADAT_IST").alias("issued"), F.col("o.VDATU").alias("requested"))
    hot = (find_hot_keys(delivery_items, "VBELN", hot_key_rows, "material_on_time")
           if hot_key_rows else None)

    def build(items: DataFrame, hot_branch: bool) -> DataFrame:
        header = dh
        if hot_branch:
            header = restrict_to_hot(dh, F.col("delivery"), hot)
        return (
            items.join(m, F.col("i.MATNR") == F.col("m.MATNR"), "left")
            .join(header, F.col("delivery") == F.col("i.VBELN"), "inner")
            .select(
                F.col("i.VBELN").alias("delivery_number"),
                F.col("i.POSNR").alias("delivery_item"),
                F.col("order_number"),
                F.col("i.MATNR").alias("material_number"),
                F.col("i.LFIMG").alias("delivered_quantity"),
                F.col("i.VRKME").alias("unit_of_measure"),
                F.col("issued").alias("actual_goods_issue_date"),
                F.col("requested").alias("requested_delivery_date"),
                code_map(F.col("m.SPART"), DIVISION_TO_LOB, UNKNOWN_LOB).alias("lob_code"),
                on_time_flag(F.col("issued"), F.col("requested")).alias("is_on_time"),
                source_tag("BLP").alias("source_id"),
            )
        )

    fact = split_hot(i, F.col("i.VBELN"), hot, build)
    if exclude_unknown:
        fact = fact.where(F.col("lob_code") != F.lit(UNKNOWN_LOB))
    return fact


def logistics_fact(movements: DataFrame, assets: DataFrame) -> DataFrame:
    """deliver-domain asset logistics fact (JN-2, CAS-2, PRJ-8, FLT-2)."""
    return (
        movements.join(assets, "asset_id", "inner")
        .select(
            "movement_id", "asset_id", "asset_name", "movement_type",
            "origin_location", "destination_location",
            "planned_departure_dt", "actual_departure_dt",
            "planned_arrival_dt", "actual_arrival_dt",
            "cargo_weight_kg", "cargo_volume_m3",
            on_time_flag("actual_arrival_dt", "planned_arrival_dt").alias("is_on_time"),
            source_tag("KBL").alias("source_id"),
        )
        .where(F.col("asset_id").isNotNull())
    )
