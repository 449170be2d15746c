"""Size bounds for broadcast decisions.

A broadcast needs a bound on *bytes*, not only rows: a million wide rows can
be gigabytes. ``size_columns`` returns aggregate expressions that compute,
in the same pass as a caller's other checks, the row count and an upper
estimate of the bytes the rows take once hashed for a broadcast: fixed-width
columns at their width, strings and binaries at their actual byte length, and
a per-row overhead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024  # 256 MB per broadcast side
# the most that is broadcast unasked: a lookup side that the planner cannot size
DEFAULT_LOOKUP_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 16

_FIXED = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16,
}


def _width(dt: T.DataType, col: Column) -> Column:
    for t, w in _FIXED.items():
        if isinstance(dt, t):
            return F.lit(w)
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0))
    # nested or other types: their serialized text length bounds them loosely
    return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))


def row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of one row of ``df``."""
    width = F.lit(_ROW_OVERHEAD)
    for f in df.schema.fields:
        width = width + _width(f.dataType, F.col(f"`{f.name}`"))
    return width


def size_columns(df: DataFrame, prefix: str = "__size") -> list[Column]:
    """``[count(*) AS <prefix>_rows, sum(row bytes) AS <prefix>_bytes]``."""
    return [F.count(F.lit(1)).alias(f"{prefix}_rows"),
            F.sum(row_bytes(df)).alias(f"{prefix}_bytes")]


def size_of(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) of ``df`` in one aggregate job."""
    r = df.agg(*size_columns(df)).first()
    return int(r[0] or 0), int(r[1] or 0)


def small_side(df: DataFrame, most: int = DEFAULT_LOOKUP_BYTES) -> DataFrame:
    """``df`` to be broadcast by a join if its counted size allows it, else as it
    is. The planner sizes an inner join as the product of its inputs, so that it
    shuffles all rows that meet even a short list made by one."""
    return F.broadcast(df) if size_of(df)[1] <= most else df
