"""Row filters and column masks driven by group-mapping tables.

The reference binds SQL functions to tables in a governed catalog. Open
Spark has no engine-enforced row filters and no group-membership builtin, so
the same rules are expressed as DataFrame plans over:

* a **group map** ``(key, entra_group_id, scope, is_active, ...)``: which
  group may see which code; ``scope = 'GLOBAL'`` rows grant everything;
* a **membership** frame ``(principal, group_id)``: who is in which group.

Semantics are the stated intent of the reference filters (SURVEY Q1): a row
is visible when an *active* mapping for the row's own code names a group of
the reader, or when any active GLOBAL mapping names a group of the reader.
NULL codes are visible only through GLOBAL. Inactive mappings grant nothing.

Scale notes. The fact is the only large input. There is one form for every
number of codes, and map and membership are read each time it is executed: a
left join of the fact with the reader's distinct codes, and a scalar subquery
for GLOBAL. Codes are unique on the right, so the join adds no rows; Spark
broadcasts them while the map is small, by its size at that execution, and
beyond that a left join is one whose hot partitions adaptive execution splits
(an existence join's are not).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import sql_name

# Fixed values from the reference: the global scope marker and the text a
# non-member sees in place of a masked value.
GLOBAL_SCOPE = "GLOBAL"
MASK_TEXT = "***MASKED***"


@dataclass(frozen=True)
class FilterPattern:
    """SEC-3: one row-filter pattern = map table + its key column."""

    function: str
    map_table: str
    map_key: str


# The three filter functions of the reference and the map
# table / key column each of them reads.
PATTERNS = {
    "fn_lob_filter": FilterPattern("fn_lob_filter", "lob_group_map", "lob_code"),
    "fn_legal_entity_filter": FilterPattern(
        "fn_legal_entity_filter", "legal_entity_group_map", "company_code"),
    "fn_asset_filter": FilterPattern("fn_asset_filter", "asset_group_map", "asset_id"),
}


class FilterColumnMissing(ValueError):
    """A registered table no longer produces its filter column."""


def current_principal(spark: SparkSession) -> str:
    return spark.sql("SELECT current_user() AS u").first()["u"]


def reader_groups(membership: DataFrame, principal: str) -> DataFrame:
    """FN-6: groups of one reader (replaces ``is_account_group_member``)."""
    return (membership.where(F.col("principal") == F.lit(principal))
            .select(F.col("group_id")).distinct())


def granted_mappings(group_map: DataFrame, membership: DataFrame,
                     principal: str) -> DataFrame:
    """FLT-6 + FN-6: active map rows whose group contains the reader."""
    groups = reader_groups(membership, principal)
    return (group_map.where(F.col("is_active") == F.lit(True))
            .join(groups, F.col("entra_group_id") == F.col("group_id"), "left_semi"))


def permitted_keys(granted: DataFrame, map_key: str) -> DataFrame:
    """Distinct codes that the reader's active mappings name.

    They are made distinct together with their hash, which keeps the rows as
    they are but not the partitioning: a join by code then shuffles this side
    once more (it is small), and only a join of two plain shuffles has its hot
    partitions split by adaptive execution."""
    code = F.col(map_key)
    return (granted.where(code.isNotNull())
            .select(code.alias("__permitted_key"), F.hash(code).alias("__h")).distinct()
            .select("__permitted_key"))


def row_filter(df: DataFrame, column: str, group_map: DataFrame,
               membership: DataFrame, principal: str, map_key: str | None = None) -> DataFrame:
    """UDF-1/2/3: keep rows the principal may see.

    Nothing is resolved while the plan is built: a group granted or revoked
    later counts at the next execution, however many codes the reader has.
    """
    if column not in df.columns:
        raise FilterColumnMissing(f"filter column {column!r} not in {df.columns}")
    granted = granted_mappings(group_map, membership, principal)
    keys = permitted_keys(granted, map_key or column)
    everything = granted.where(F.col("scope") == F.lit(GLOBAL_SCOPE)).exists()
    f = df.alias("__secured")
    joined = f.join(keys, F.col(f"__secured.{column}") == F.col("__permitted_key"), "left")
    return (joined.where(F.col("__permitted_key").isNotNull() | everything)
            .select(*[F.col(f"__secured.{c}") for c in df.columns]))


def visible_rows(df: DataFrame, column: str, group_map: DataFrame, membership: DataFrame,
                 map_key: str | None = None) -> DataFrame:
    """``(principal, visible_rows)`` of every principal in ``membership``, zeros
    included: what :func:`row_filter` would leave each of them.

    The fact is read once and reduced to a count per code on the map side; the
    counts, not the rows, meet the grants."""
    map_key = map_key or column
    counts = df.groupBy(F.col(column).alias("__code")).agg(F.count(F.lit(1)).alias("__rows"))
    total = counts.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("__total"))
    active = group_map.where(F.col("is_active") == F.lit(True))
    grants = (membership.join(active, F.col("group_id") == F.col("entra_group_id"))
              .select("principal", F.col(map_key).alias("__key"),
                      (F.col("scope") == F.lit(GLOBAL_SCOPE)).alias("__global")).distinct())
    own = (grants.select("principal", "__key").distinct()
           .join(counts, F.col("__key") == F.col("__code"))
           .groupBy("principal").agg(F.sum("__rows").alias("__own")))
    everything = grants.where("__global").select("principal", F.lit(True).alias("__all")).distinct()
    return (membership.select("principal").distinct()
            .join(own, "principal", "left").join(everything, "principal", "left").join(total)
            .select("principal", F.when(F.col("__all"), F.col("__total"))
                    .otherwise(F.coalesce("__own", F.lit(0))).cast("long").alias("visible_rows")))


def is_member(membership: DataFrame, principal: str, groups: list[str]) -> bool:
    return bool(membership.where((F.col("principal") == F.lit(principal))
                                 & F.col("group_id").isin(list(groups)))
                .limit(1).count())


def mask_columns(df: DataFrame, columns: list[str], allowed_groups: list[str],
                 membership: DataFrame, principal: str) -> DataFrame:
    """UDF-4 / SEC-4: members of ``allowed_groups`` see values, others the mask.

    A NULL is masked for non-members too (Q12). Membership is a scalar
    subquery, read at each execution (a grant revoked after the plan was built
    no longer counts); the plan over the data stays a single projection. Masked
    columns are strings for every reader.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"mask columns not found: {missing}")
    member = membership.where((F.col("principal") == F.lit(principal))
                              & F.col("group_id").isin(list(allowed_groups))).exists()
    masked = set(columns)
    return df.select(*[
        (F.when(member, F.col(c).cast("string")).otherwise(F.lit(MASK_TEXT)).alias(c)
         if c in masked else F.col(c)) for c in df.columns
    ])


def secure(df: DataFrame, binding: dict | None, maps: dict[str, DataFrame],
           membership: DataFrame, principal: str, **kwargs) -> tuple[DataFrame, str]:
    """SEC-1: apply the registered filter; unregistered tables are SKIPPED.

    ``binding`` is the registry row for the table (see ``sources.registry``)
    or ``None``. Returns the DataFrame and the action taken.
    """
    if not binding or binding.get("row_filter") in (None, "", "none"):
        return df, "SKIPPED"
    pattern = PATTERNS[binding["row_filter"]]
    column = binding["filter_column"]
    if column not in df.columns:
        raise FilterColumnMissing(
            f"{binding.get('schema')}.{binding.get('table')}: filter column "
            f"{column!r} missing")
    return (row_filter(df, column, maps[pattern.map_table], membership, principal,
                       map_key=pattern.map_key, **kwargs), "FILTERED")


def _granted_sql(map_table: str, membership_table: str) -> str:
    """:func:`granted_mappings` as SQL. A semi join is taken to be no larger than the
    map, an inner join as large as the product of both: with that the planner would
    shuffle the whole table that meets the codes, however few they are."""
    return f"""FROM {map_table} m LEFT SEMI JOIN {membership_table} g
      ON g.group_id = m.entra_group_id AND g.principal = current_user()
    WHERE m.is_active = true"""


def secured_select_sql(base: str, column: str, map_table: str, map_key: str,
                       membership_table: str) -> str:
    """SQL body of a secured view: :func:`row_filter` as SQL, evaluated per query.

    The reader is ``current_user()``, so a membership or mapping change takes
    effect on the next query without rebuilding anything; if the base loses
    the filter column the view fails closed (unresolved column).
    """
    base, column, map_table, map_key, membership_table = map(
        sql_name, (base, column, map_table, map_key, membership_table))
    granted = _granted_sql(map_table, membership_table)
    return f"""SELECT b.* FROM {base} b
LEFT JOIN (
    SELECT permitted_key FROM (
      SELECT DISTINCT m.{map_key} AS permitted_key, hash(m.{map_key}) AS h {granted})) k
  ON k.permitted_key = b.{column}
WHERE k.permitted_key IS NOT NULL
   OR EXISTS (
    SELECT 1 {granted} AND m.scope = '{GLOBAL_SCOPE}')"""


def pruned_select_sql(base: str, column: str, map_table: str, map_key: str,
                      membership_table: str) -> str:
    """:func:`secured_select_sql` for a base that is partitioned by ``column``: a
    reader's query lists and reads only the partitions that reader may see.

    The two kinds of reader are two branches, and only one of them has rows. A
    semi join on the partition column lets dynamic partition pruning reach the
    scan (the left join of the general form cannot be pruned); the codes are empty
    for a GLOBAL reader, so adaptive execution drops that branch. The branch of
    everything, NULL codes included, hangs on a scalar subquery alone, which is a
    partition filter: it reads no file unless the reader is GLOBAL."""
    base, column, map_table, map_key, membership_table = map(
        sql_name, (base, column, map_table, map_key, membership_table))
    granted = _granted_sql(map_table, membership_table)
    everything = f"EXISTS (SELECT 1 {granted} AND m.scope = '{GLOBAL_SCOPE}')"
    return f"""SELECT b.* FROM {base} b
LEFT SEMI JOIN (SELECT DISTINCT m.{map_key} AS permitted_key {granted}
    AND m.{map_key} IS NOT NULL AND NOT {everything}) k ON k.permitted_key = b.{column}
UNION ALL
SELECT b.* FROM {base} b WHERE {everything}"""


def masked_select_sql(base: str, all_columns: list[str], masked: list[str],
                      allowed_groups: list[str], membership_table: str) -> str:
    """SQL body of a masking view: members of ``allowed_groups`` see values.

    Evaluated per query against ``current_user()`` (UDF-4 as a view); NULLs
    are masked for non-members too (Q12).
    """
    base, membership_table = sql_name(base), sql_name(membership_table)
    all_columns = [sql_name(c) for c in all_columns]
    groups = ", ".join("'" + g.replace("'", "''") + "'" for g in allowed_groups)
    member = (f"EXISTS (SELECT 1 FROM {membership_table} g WHERE g.principal = current_user() "
              f"AND g.group_id IN ({groups}))")
    cols = [(f"CASE WHEN {member} THEN CAST(b.{c} AS STRING) ELSE '{MASK_TEXT}' END AS {c}"
             if c in masked else f"b.{c}") for c in all_columns]
    return f"SELECT {', '.join(cols)} FROM {base} b"


def secured_view_sql(view: str, base: str, column: str, map_table: str,
                     map_key: str, membership_table: str) -> str:
    """``CREATE OR REPLACE VIEW`` text for :func:`secured_select_sql`."""
    view = sql_name(view)
    body = secured_select_sql(base, column, map_table, map_key, membership_table)
    return f"CREATE OR REPLACE VIEW {view} AS\n{body}"
