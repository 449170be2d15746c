"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans: plain SQL over the test tables,
with MERGE expressed as ``LEFT JOIN ... UNION ALL ... NOT EXISTS`` and the
row filters as EXISTS predicates. The config rows are written out here on
their own: nothing is imported from the library, so a wrong seed or
membership on its side shows.
"""

from __future__ import annotations


def _q(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def _values(rows, names) -> str:
    body = ", ".join("(" + ", ".join(_q(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(names)})"


# ── stand-in tables ─────────────────────────────────────────────────────────

LIKP = ("likp AS (SELECT l_orderkey AS VBELN, l_orderkey AS VGBEL, "
        "max(l_shipdate) AS WADAT_IST FROM lineitem GROUP BY l_orderkey)")
LIPS = ("lips AS (SELECT l_orderkey AS VBELN, l_linenumber AS POSNR, l_partkey AS MATNR, "
        "l_quantity AS LFIMG, 'EA' AS VRKME FROM lineitem)")
VBAK = ("vbak AS (SELECT o_orderkey AS VBELN, o_orderdate AS VDATU FROM orders "
        "WHERE o_orderstatus <> 'P')")
MARA = (r"mara AS (SELECT p_partkey AS MATNR, "
        r"lpad(regexp_extract(p_brand, '(\d+)', 1), 2, '0') AS SPART FROM part)")
MOT_ALL = """mot_all AS (
  SELECT i.VBELN AS delivery_number, i.POSNR AS delivery_item, o.VBELN AS order_number,
         i.MATNR AS material_number, i.LFIMG AS delivered_quantity, i.VRKME AS unit_of_measure,
         d.WADAT_IST AS actual_goods_issue_date, o.VDATU AS requested_delivery_date,
         CASE m.SPART WHEN '01' THEN 'UP' WHEN '02' THEN 'DS' WHEN '03' THEN 'GF'
                      ELSE 'UNKNOWN' END AS lob_code,
         CASE WHEN d.WADAT_IST <= o.VDATU THEN 1 ELSE 0 END AS is_on_time,
         'BLP' AS source_id
  FROM likp d JOIN lips i ON d.VBELN = i.VBELN
  LEFT JOIN vbak o ON d.VGBEL = o.VBELN
  LEFT JOIN mara m ON i.MATNR = m.MATNR)"""
MOT = "mot AS (SELECT * FROM mot_all WHERE lob_code <> 'UNKNOWN')"
MOT_CTES = [LIKP, LIPS, VBAK, MARA, MOT_ALL, MOT]

SPEND_CTES = [
    ("sc AS (SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN n_name END AS BUKRS "
     "FROM supplier JOIN nation ON s_nationkey = n_nationkey)"),
    ("arb AS (SELECT l_orderkey AS EBELN, l_linenumber AS EBELP, BUKRS, l_suppkey AS LIFNR, "
     "l_partkey AS MATNR, l_quantity AS MENGE, l_extendedprice AS NETWR, 'USD' AS WAERS, "
     "l_shipdate AS BEDAT, l_shipdate AS ERDAT FROM lineitem JOIN sc ON l_suppkey = s_suppkey)"),
    ("spend_all AS (SELECT EBELN AS po_number, EBELP AS po_line_number, BUKRS AS company_code, "
     "LIFNR AS vendor_id, MATNR AS material_id, MENGE AS quantity, NETWR AS net_value, "
     "WAERS AS currency, BEDAT AS po_date, ERDAT AS created_date, 'ARB' AS source_id FROM arb)"),
    "spend AS (SELECT * FROM spend_all WHERE company_code IS NOT NULL)",
]
CLM = ("clm AS (SELECT o_orderkey AS po_number, 'CT-' || CAST(o_orderkey AS VARCHAR) "
       "AS contract_id, o_orderpriority AS contract_type FROM orders WHERE o_orderstatus = 'F')")
CLM_REPEATED = ("clm_rep AS (SELECT l_orderkey AS po_number, 'CL-' || CAST(l_orderkey AS VARCHAR)"
                " || '-' || CAST(l_linenumber AS VARCHAR) AS contract_id, l_linestatus AS "
                "contract_type, l_shipdate AS signed_at FROM lineitem WHERE l_returnflag = 'R')")

LOGI_CTES = [
    """mv AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
           AS movement_id, CAST(l_suppkey AS VARCHAR) AS asset_id,
         l_returnflag AS movement_type, 'WH-' || l_linestatus AS origin_location,
         'CU-' || CAST(o_custkey AS VARCHAR) AS destination_location,
         o_orderdate AS planned_departure_dt, l_shipdate AS actual_departure_dt,
         o_orderdate AS planned_arrival_dt, l_shipdate AS actual_arrival_dt,
         l_quantity AS cargo_weight_kg, l_extendedprice AS cargo_volume_m3
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "ast AS (SELECT CAST(s_suppkey AS VARCHAR) AS asset_id, s_name AS asset_name FROM supplier)",
    """logi AS (SELECT movement_id, asset_id, asset_name, movement_type, origin_location,
         destination_location, planned_departure_dt, actual_departure_dt, planned_arrival_dt,
         actual_arrival_dt, cargo_weight_kg, cargo_volume_m3,
         CASE WHEN actual_arrival_dt <= planned_arrival_dt THEN 1 ELSE 0 END AS is_on_time,
         'KBL' AS source_id
       FROM mv JOIN ast USING (asset_id) WHERE asset_id IS NOT NULL)""",
]

# ── config tables ───────────────────────────────────────────────────────────

# lob_code, lob_name, entra_group_id, scope, is_active.
_LOB_ROWS = [
    ("UP", "Upstream", "grp-lob-up", "LOB", True),
    ("DS", "Downstream", "grp-lob-ds", "LOB", True),
    ("GF", "Functions", "grp-lob-gf", "LOB", True),
    ("GLOBAL", "All LOBs", "grp-lob-global", "GLOBAL", True),
    ("RF", "Refinery", "grp-lob-rf", "LOB", False),
]
# Principal, group. The viewer is the user who runs the session.
_MEMBERS = [
    ("ana", "grp-lob-up"), ("ana", "grp-lob-gf"),
    ("gil", "grp-lob-global"), ("gil", "grp-entity-global"), ("gil", "grp-asset-global"),
    ("eve", "grp-entity-r0"), ("eve", "grp-entity-r3"),
    ("ash", "grp-asset-n7"), ("ash", "grp-asset-n11"),
    ("rita", "grp-lob-rf"), ("bo", "uat-business-owners"),
    ("nobody", "grp-of-no-map"),
    ("viewer", "grp-lob-ds"), ("viewer", "grp-lob-rf"), ("viewer", "grp-entity-r1"),
    ("viewer", "grp-entity-r2"), ("viewer", "grp-asset-n3"), ("viewer", "grp-asset-n20"),
]
LOB_MAP = "lob_map AS (" + _values(
    _LOB_ROWS, ["lob_code", "lob_name", "entra_group_id", "scope", "is_active"]) + ")"
ENTITY_MAP = """entity_map AS (
  SELECT DISTINCT n_name AS company_code, n_name AS entity_name,
         'grp-entity-r' || CAST(r_regionkey AS VARCHAR) AS entra_group_id,
         'ENTITY' AS scope, true AS is_active, r_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'GLOBAL', 'All entities', 'grp-entity-global', 'GLOBAL', true, NULL)"""
ASSET_MAP = """asset_map AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS asset_id, s_name AS asset_name,
         'grp-asset-n' || CAST(s_nationkey AS VARCHAR) AS entra_group_id,
         'ASSET' AS scope, true AS is_active FROM supplier
  UNION ALL SELECT 'GLOBAL', 'All assets', 'grp-asset-global', 'GLOBAL', true)"""
MEMBERS = "membership AS (" + _values(_MEMBERS, ["principal", "group_id"]) + ")"


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _filtered(fact: str, column: str, map_cte: str, key: str, principal: str) -> str:
    p = _q(principal)
    return f"""SELECT f.* FROM {fact} f
WHERE EXISTS (SELECT 1 FROM {map_cte} m JOIN membership g ON g.group_id = m.entra_group_id
              WHERE m.{key} = f.{column} AND m.is_active AND g.principal = {p})
   OR EXISTS (SELECT 1 FROM {map_cte} m JOIN membership g ON g.group_id = m.entra_group_id
              WHERE m.scope = 'GLOBAL' AND m.is_active AND g.principal = {p})"""


def _merge(target_sql: str, source_sql: str, columns: list[str], keys: list[str],
           ctes: list[str] | None = None) -> str:
    """What MERGE ... UPDATE SET * / INSERT * leaves in the target."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sel = ", ".join(f"t.{c}" if c in keys else
                    f"CASE WHEN s.src_flag_ THEN s.{c} ELSE t.{c} END AS {c}" for c in columns)
    cols = ", ".join(columns)
    body = f"""SELECT {sel} FROM t LEFT JOIN s ON {on}
UNION ALL
SELECT {cols} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {on})"""
    return _with((ctes or []) + [f"t AS ({target_sql})",
                                 f"s AS (SELECT *, true AS src_flag_ FROM ({source_sql}))"], body)


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]
CONV_COLS = ["conv_id", "turn", "role", "text"]
_ORDERS_BATCH = ("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'F' "
                 "ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, "
                 "o_orderpriority FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-01'")
_PROV = "'BLP' AS _source_id, '{lt}' AS _load_type, true AS has_loaded_at"
_MASK = "'***MASKED***'"

_SPEND_BODY = "SELECT * FROM spend"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["material_on_time"] = _with(MOT_CTES, "SELECT * FROM mot")
    q["material_on_time_all"] = _with(MOT_CTES, "SELECT * FROM mot_all")
    q["secured_material_on_time"] = _with(MOT_CTES + [LOB_MAP, MEMBERS],
                                          _filtered("mot", "lob_code", "lob_map", "lob_code",
                                                    "ana"))
    q["material_on_time_hot"] = q["material_on_time"]
    q["spend_rename"] = _with(SPEND_CTES, _SPEND_BODY)
    q["fact_mot_from_changes"] = q["material_on_time_all"]  # a full rebuild
    q["spend_with_contract"] = _with(
        SPEND_CTES + [CLM],
        "SELECT * FROM spend LEFT JOIN (SELECT po_number, contract_id, contract_type FROM clm) c"
        " USING (po_number)")
    q["fact_spend_from_changes"] = q["spend_with_contract"]
    q["spend_without_contract"] = _with(
        SPEND_CTES, "SELECT *, CAST(NULL AS VARCHAR) AS contract_id, "
                    "CAST(NULL AS VARCHAR) AS contract_type FROM spend")
    q["spend_latest_contract"] = _with(
        SPEND_CTES + [CLM_REPEATED, """latest AS (
  SELECT po_number, contract_id, contract_type FROM (
    SELECT *, row_number() OVER (PARTITION BY po_number
      ORDER BY signed_at DESC, contract_id DESC, contract_type DESC) AS rn FROM clm_rep)
  WHERE rn = 1)"""],
        "SELECT * FROM spend LEFT JOIN latest USING (po_number)")
    q["logistics_on_time"] = _with(LOGI_CTES, "SELECT * FROM logi")

    q["watermark_delta"] = (f"SELECT *, {_PROV.format(lt='delta')} FROM orders "
                            "WHERE o_orderdate > TIMESTAMP '2000-01-01'")
    q["watermark_compact"] = q["watermark_delta"].replace("2000-01-01", "1998-06-01")
    q["watermark_events"] = ("SELECT *, 'APP' AS _source_id, 'delta' AS _load_type, "
                             "true AS has_loaded_at FROM events "
                             "WHERE ts > TIMESTAMP '2024-01-15 12:00:00.5'")
    q["high_water_marks"] = " UNION ALL ".join(
        f"SELECT '{t}' AS target, CAST(max({c}) AS VARCHAR) AS watermark_value FROM {t}"
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")))
    q["harmonise_passthrough"] = f"SELECT *, {_PROV.format(lt='full')} FROM customer"
    q["harmonise_renamed"] = (
        "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS "
        f"market_segment, c_nationkey, c_acctbal, {_PROV.format(lt='full')} FROM customer")
    prov_cols = ORDERS_COLS + ["_source_id", "_load_type", "has_loaded_at"]
    q["first_load_then_merge"] = _merge(
        f"SELECT *, {_PROV.format(lt='full')} FROM orders "
        "WHERE o_orderdate < TIMESTAMP '2000-01-01'",
        f"SELECT *, {_PROV.format(lt='delta')} FROM orders "
        "WHERE o_orderdate > TIMESTAMP '1999-06-01'",
        prov_cols, ["o_orderkey"])

    q["upsert_single_key"] = _merge(
        "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'", _ORDERS_BATCH,
        ORDERS_COLS, ["o_orderkey"])
    q["upsert_composite_key"] = _merge(
        "SELECT * FROM conversations WHERE role <> 'assistant'",
        "SELECT conv_id, turn, role, CASE WHEN role = 'system' THEN text || ' [rev]' "
        "ELSE text END AS text FROM conversations WHERE role IN ('assistant', 'system')",
        CONV_COLS, ["conv_id", "turn"])
    q["upsert_evolve"] = _merge(
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
        "CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders "
        "WHERE o_orderdate < TIMESTAMP '2000-01-01'", _ORDERS_BATCH,
        ORDERS_COLS, ["o_orderkey"])
    q["upsert_events_late"] = _merge(
        "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'",
        "SELECT event_id, ts, user_id, event_type, value * 2.0 AS value, props FROM events "
        "WHERE ts > TIMESTAMP '2024-01-10'",
        ["event_id", "ts", "user_id", "event_type", "value", "props"], ["event_id"])
    q["upsert_null_keys"] = _merge(
        "SELECT * FROM orders",
        "SELECT CAST(NULL AS BIGINT) AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
        "o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'P'",
        ORDERS_COLS, ["o_orderkey"])

    line_cols = ["line_group", "l_linenumber", "l_quantity", "l_shipdate"]
    fulfilled = ("SELECT o_orderkey + 1 AS line_group, 0 AS l_linenumber, o_totalprice AS l_quantity, "
                 "o_orderdate AS l_shipdate FROM orders WHERE o_orderstatus = 'F'")
    q["upsert_hot_target"] = _merge(
        "SELECT CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_quantity < 49 THEN l_orderkey + 1 END AS line_group, "
        "l_linenumber, l_quantity, l_shipdate FROM lineitem",
        f"{fulfilled} UNION ALL SELECT 0, 9, 1.5, max(o_orderdate) FROM orders UNION ALL "
        f"SELECT NULL, l_linenumber, l_quantity, l_shipdate FROM ({fulfilled}) WHERE l_quantity > 400000",
        line_cols, ["line_group"])

    lob = MOT_CTES + [LOB_MAP, MEMBERS]
    q["row_filter_lob"] = _with(lob, _filtered("mot_all", "lob_code", "lob_map", "lob_code",
                                               "ana"))
    ent = SPEND_CTES + [ENTITY_MAP, MEMBERS]
    q["row_filter_entity"] = _with(ent, _filtered("spend", "company_code", "entity_map",
                                                  "company_code", "eve"))
    q["row_filter_asset"] = _with(LOGI_CTES + [ASSET_MAP, MEMBERS],
                                  _filtered("logi", "asset_id", "asset_map", "asset_id", "ash"))
    q["row_filter_global"] = _with(ent, _filtered("spend", "company_code", "entity_map",
                                                  "company_code", "gil"))
    q["function_filter_lob"] = _with(lob, _filtered("mot_all", "lob_code", "lob_map", "lob_code", "viewer"))
    q["function_filter_entity"] = _with(ent, _filtered("spend_all", "company_code", "entity_map",
                                                       "company_code", "viewer"))
    q["function_filter_asset"] = _with(LOGI_CTES + [ASSET_MAP, MEMBERS],
                                       _filtered("logi", "asset_id", "asset_map", "asset_id", "viewer"))
    counted = []
    for table, fact, column, map_cte, key in (
            ("fact_mot", "mot_all", "lob_code", "lob_map", "lob_code"),
            ("fact_spend", "spend_all", "company_code", "entity_map", "company_code"),
            ("fact_kabal_logistics", "logi", "asset_id", "asset_map", "asset_id")):
        counted.append(f"""SELECT '{table}' AS target, p.principal, count(f.{column}_row) AS visible_rows
FROM (SELECT DISTINCT principal FROM membership WHERE principal <> 'viewer') p
LEFT JOIN (SELECT *, 1 AS {column}_row FROM {fact}) f ON EXISTS (
    SELECT 1 FROM {map_cte} m JOIN membership g ON g.group_id = m.entra_group_id
    WHERE m.is_active AND g.principal = p.principal
      AND (m.{key} = f.{column} OR m.scope = 'GLOBAL'))
GROUP BY p.principal""")
    q["visible_rows_per_principal"] = _with(
        MOT_CTES + SPEND_CTES + LOGI_CTES + [LOB_MAP, ENTITY_MAP, ASSET_MAP, MEMBERS],
        "\nUNION ALL\n".join(counted))
    q["published_fact_mot"] = _with(lob, _filtered("mot", "lob_code", "lob_map", "lob_code",
                                                   "viewer"))
    q["published_fact_spend"] = _with(
        SPEND_CTES + [CLM, ENTITY_MAP, MEMBERS, "spend_c AS (SELECT * FROM spend LEFT JOIN (SELECT po_number, "
                      "contract_id, contract_type FROM clm) c USING (po_number))"],
        _filtered("spend_c", "company_code", "entity_map", "company_code", "viewer"))
    q["published_fact_logistics"] = _with(
        LOGI_CTES + [ASSET_MAP, MEMBERS], _filtered("logi", "asset_id", "asset_map", "asset_id", "viewer"))
    q["pruned_fact_mot"] = _with(lob, _filtered("mot_all", "lob_code", "lob_map", "lob_code", "viewer"))
    q["pruned_fact_spend"] = _with(ent, _filtered("spend_all", "company_code", "entity_map",
                                                  "company_code", "viewer"))
    q["pruned_fact_spend_global"] = _with(ent, "SELECT * FROM spend_all")
    q["row_filter_null_code"] = _with(ent, _filtered("spend_all", "company_code", "entity_map",
                                                     "company_code", "eve"))
    q["row_filter_null_code_global"] = _with(ent, _filtered("spend_all", "company_code",
                                                            "entity_map", "company_code", "gil"))

    q["mask_member"] = ("SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal, "
                        "c_mktsegment FROM customer")
    q["mask_non_member"] = (f"SELECT c_custkey, {_MASK} AS c_name, c_nationkey, {_MASK} AS c_acctbal, "
                            "c_mktsegment FROM customer")

    q["run_audit_totals"] = _with(
        ["per_table AS (" + " UNION ALL ".join(
            f"SELECT '{t}' AS target, 'success' AS status, count(*) AS rows FROM {t}"
            for t in ("customer", "orders", "part", "supplier", "lineitem", "events")) + ")"],
        "SELECT target, status, rows FROM per_table UNION ALL "
        "SELECT 'TOTAL', 'success', CAST(sum(rows) AS BIGINT) FROM per_table")
    loaded = []
    for t, c, first in (("orders", "o_orderdate", "1999-01-01"), ("events", "ts", "2024-01-10")):
        split = f"CASE WHEN {c} < TIMESTAMP '{first}' THEN 'full' ELSE 'delta' END"
        loaded.append(f"SELECT '{t}' AS target, {split} AS _load_type, count(*) AS rows, "
                      f"CAST(max({c}) AS VARCHAR) AS newest FROM {t} GROUP BY 2")
        loaded.append(f"SELECT '{t}', 'mark', CAST(NULL AS BIGINT), CAST(max({c}) AS VARCHAR) FROM {t}")
    q["harmonise_then_delta"] = " UNION ALL ".join(loaded)
    batch = _ORDERS_BATCH.replace("o_orderpriority FROM", "o_orderpriority, 'b1' AS o_batch FROM")
    q["load_full_then_delta_snapshot"] = _merge(
        "SELECT *, CAST(NULL AS VARCHAR) AS o_batch FROM orders "
        "WHERE o_orderdate < TIMESTAMP '2000-01-01'", batch, ORDERS_COLS + ["o_batch"], ["o_orderkey"])
    year = "SELECT *, CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) END AS o_year FROM ({})"
    q["load_full_then_delta_partitioned"] = _merge(
        year.format("SELECT *, CAST(NULL AS VARCHAR) AS o_batch FROM orders "
                    "WHERE o_orderdate < TIMESTAMP '2000-01-01'"),
        year.format(batch.replace("o_orderdate, o", "o_orderdate + INTERVAL 400 DAYS AS o_orderdate, o")),
        ORDERS_COLS + ["o_batch", "o_year"], ["o_orderkey"])
    q["load_recent_orders_partitioned"] = (
        "SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate > TIMESTAMP '2001-06-01' THEN 'X' "
        "ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, "
        "o_orderkey // 2000 AS okr FROM orders")
    q["seed_entity_map"] = _with(
        [ENTITY_MAP], "SELECT company_code, entity_name, entra_group_id, scope, is_active, "
                      "CAST(NULL AS VARCHAR) AS updated_by, true AS has_created_at "
                      "FROM entity_map")
    q["soft_delete_entity_map"] = _with(
        [ENTITY_MAP],
        "SELECT company_code, entity_name, entra_group_id, scope, "
        "CASE WHEN r_name = 'EUROPE' THEN false ELSE is_active END AS is_active, "
        "CASE WHEN r_name = 'EUROPE' THEN 'rollback-europe' END AS updated_by, "
        "CASE WHEN r_name = 'EUROPE' THEN '2026-01-01 00:00:00' END AS deactivated_at "
        "FROM entity_map")
    q["null_violations"] = _with(
        SPEND_CTES, " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count "
            "FROM spend_all"
            for c in ("po_number", "po_line_number", "company_code", "vendor_id")))
    q["quarantine_orders"] = """WITH tagged AS (
  SELECT *, concat_ws('; ', CASE WHEN o_orderstatus = 'P' THEN 'o_year is null' END,
    CASE WHEN o_totalprice < 30000 THEN 'price below 30000' END,
    CASE WHEN o_orderpriority = '5-LOW' AND (o_orderstatus = 'P' OR year(o_orderdate) = 1999)
         THEN 'low priority in 1999' END) AS reasons FROM orders),
runs AS (
  SELECT 'first' AS run_id, * FROM tagged WHERE o_orderdate < TIMESTAMP '2000-01-01'
  UNION ALL SELECT 'second', * FROM tagged UNION ALL SELECT 'third', * FROM tagged)
SELECT 'accepted' AS part, CAST(NULL AS VARCHAR) AS run_id, CAST(o_orderkey AS BIGINT) AS o_orderkey,
  CAST(NULL AS VARCHAR) AS detail, CAST(NULL AS BIGINT) AS rows FROM tagged WHERE reasons = ''
UNION ALL SELECT 'rejected', run_id, o_orderkey, reasons, NULL FROM runs WHERE reasons <> ''
UNION ALL SELECT 'audit', run_id, NULL, CASE WHEN reasons = '' THEN 'success' ELSE 'rejected' END, count(*)
FROM runs WHERE run_id <> 'third' GROUP BY 2, 4
UNION ALL SELECT 'audit', 'third', NULL, 'failed', 0"""
    q["reconcile_orders"] = """WITH o AS (
  SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus AS s, strftime(o_orderdate, '%Y-%m') AS m FROM orders),
found AS (
  SELECT m, o_orderkey, 'lost' AS problem, 1 AS source_rows, 0 AS target_rows FROM o WHERE m = '1999-03' AND s = 'O'
  UNION ALL SELECT m, o_orderkey, 'altered', 1, 1 FROM o WHERE m = '1998-07' AND s = 'F'
  UNION ALL SELECT m, o_orderkey, 'doubled', 1, 2 FROM o WHERE m = '2000-05'
  UNION ALL SELECT m, -o_orderkey - 1, 'extra', 0, 1 FROM o WHERE m = '2000-02')
SELECT o_orderkey, problem, CAST(source_rows AS BIGINT) AS source_rows, CAST(target_rows AS BIGINT) AS target_rows FROM found
UNION ALL SELECT NULL, CASE WHEN count(*) = 0 THEN 'matched' ELSE 'differs' END, NULL, count(DISTINCT m) FROM found"""
    q["clustered_reads"] = ("SELECT *, CAST(o_orderdate AS DATE) AS o_day, 'delta' AS read FROM orders "
                            "WHERE CAST(o_orderdate AS DATE) > DATE '2000-10-01' "
                            "UNION ALL SELECT *, CAST(o_orderdate AS DATE), 'keys' FROM orders WHERE o_orderkey BETWEEN 300 AND 500")
    q["pinned_clone"] = "SELECT * FROM customer WHERE c_acctbal > 0"
    q["events_late_twice"] = """WITH e AS (
  SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS ts, event_type,
         event_type = 'error' OR (day(ts) <= 10 AND event_id % 4 = 0) AS recovered FROM events)
SELECT event_id, ts, event_type, CAST(NULL AS BIGINT) AS rows FROM e
UNION ALL SELECT NULL, NULL, CASE WHEN recovered THEN 'recovered' ELSE 'appended' END, count(*) FROM e GROUP BY 3"""
    return q
