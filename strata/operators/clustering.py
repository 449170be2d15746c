"""Rows laid out along a space-filling curve, so that scans skip row groups.

A table sorted by its watermark serves ``mark > x`` and nothing else. Along a
Z-order curve over (watermark, key) every file and row group covers a small range
of *both*, so that a delta read and a key lookup each meet few of them by the
statistics that parquet keeps anyway.

Each column is first ranked among ``2^bits`` quantiles of its own values, so the
curve follows the data and not the type's range; the ranks' bits are interleaved.
The quantiles are the only values that reach the driver, at most ``2^bits - 1`` a
column. Rows are then range-partitioned by the curve and, within a cell of it,
by the columns, so a cell that holds much of the table is split as well; equal
rows in all of them stay together.

Spark 4.1 hands no comparison of ``timestamp_ntz`` to parquet (measured: a filter
on such a column skips nothing), so a mark should be stored as a date or timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 6


def ordered_value(df: DataFrame, column: str) -> Column:
    """The column as a value of which quantiles can be taken, in its own order;
    of a string, its first seven bytes as a number."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(F.col(column), "UTF-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("bigint")
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(column)
    raise ValueError(f"cannot cluster by {column}: {kind.simpleString()}")


def quantile_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list]:
    """Per column its distinct inner quantiles, ascending; one pass over these
    columns. Empty for a column without values."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(ordered_value(df, c), shares).alias(f"q{i}")
                   for i, c in enumerate(columns)]).first()
    return [sorted(set(q or [])) for q in row]


def rank(value: Column, bounds: Sequence) -> Column:
    """How many of ``bounds`` are at most ``value`` (a balanced tree of
    comparisons); 0 for NULL."""
    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value >= F.lit(bounds[mid]), among(mid + 1, high)).otherwise(among(low, mid))
    return among(0, len(bounds))


def z_value(df: DataFrame, columns: Sequence[str], bounds: Sequence[Sequence], bits: int = BITS) -> Column:
    """Interleaved bits of the columns' ranks, the first column's bits highest."""
    ranks = [rank(ordered_value(df, c), b) for c, b in zip(columns, bounds, strict=True)]
    out = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for r in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(r, bit).bitwiseAND(F.lit(1)))
    return out


def cluster(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` in files that each cover a small range of every column. ``bits`` a
    column: with ``c`` columns the curve has ``2^(bits * c)`` cells."""
    columns = list(columns)
    if not columns or bits * len(columns) > 62:
        raise ValueError("cluster by one or more columns, of 62 bits in all")
    z = z_value(df, columns, quantile_bounds(df, columns, bits), bits)
    by = ["__z", *columns]
    return df.withColumn("__z", z).repartitionByRange(*by).sortWithinPartitions(*by).drop("__z")
