"""The row-filter and masking functions as persisted Spark SQL functions.

SQL users keep calling ``config.fn_lob_filter(lob_code)`` or
``platform_config.mask_pii(col)`` in their own queries and views. Spark 4
inlines SQL functions, so the EXISTS bodies plan as (broadcast) existence
joins against the small map and membership tables, like the DataFrame forms
in ``operators.security``.

The parameter is named ``code`` (not the map's column name), so the
comparison ``m.<key> = code`` cannot bind to the map's own column: the
reference's shadowing leak (every active member sees every row) is not
reproduced. The reader is ``current_user()``, looked up in a membership
table ``(principal, group_id)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from strata.functions.columns import sql_name
from strata.operators.security import GLOBAL_SCOPE, MASK_TEXT, PATTERNS


def filter_function_sql(function: str, config_db: str, membership_table: str) -> str:
    """``CREATE OR REPLACE FUNCTION`` text of one filter pattern."""
    p = PATTERNS[function]
    config_db, membership_table = sql_name(config_db), sql_name(membership_table)
    m, g = f"{config_db}.{p.map_table}", membership_table
    return f"""
CREATE OR REPLACE FUNCTION {config_db}.{p.function}(code STRING)
RETURNS BOOLEAN
RETURN EXISTS (
    SELECT 1 FROM {m} m LEFT SEMI JOIN {g} g ON g.group_id = m.entra_group_id AND g.principal = current_user()
    WHERE m.{p.map_key} = code AND m.is_active = true)
  OR EXISTS (
    SELECT 1 FROM {m} m LEFT SEMI JOIN {g} g ON g.group_id = m.entra_group_id AND g.principal = current_user()
    WHERE m.scope = '{GLOBAL_SCOPE}' AND m.is_active = true)
"""


def mask_function_sql(schema: str, allowed_group: str, membership_table: str) -> str:
    """``mask_pii(val)``: members of ``allowed_group`` see ``val``, others the mask."""
    schema, membership_table = sql_name(schema), sql_name(membership_table)
    grp = allowed_group.replace("'", "''")
    return f"""
CREATE OR REPLACE FUNCTION {schema}.mask_pii(val STRING)
RETURNS STRING
RETURN CASE
  WHEN EXISTS (SELECT 1 FROM {membership_table} g
               WHERE g.principal = current_user() AND g.group_id = '{grp}') THEN val
  ELSE '{MASK_TEXT}'
END
"""


def create_security_functions(spark: SparkSession, config_db: str, membership_table: str,
                              mask_schema: str | None = None,
                              mask_group: str | None = None) -> list[str]:
    """Create the three filter functions (and ``mask_pii`` if asked)."""
    created = []
    for fn in PATTERNS:
        spark.sql(filter_function_sql(fn, config_db, membership_table))
        created.append(f"{config_db}.{fn}")
    if mask_schema and mask_group:
        spark.sql(mask_function_sql(mask_schema, mask_group, membership_table))
        created.append(f"{mask_schema}.mask_pii")
    return created
