"""Small configuration frames built inside the JVM.

Config rows (seeds, membership, registry rows, audit rows) are a handful of
literals. Building them as ``inline(array(struct(lit ...)))`` over a
one-row range keeps them out of Python RDDs: no Python worker reads them,
Catalyst knows they are tiny (so joins against them broadcast), and the
values are typed literals rather than text spliced into SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def config_frame(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not isinstance(st, T.StructType):
        raise TypeError(f"schema must be a struct, got {st}")
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in st.fields])
    for r in rows:
        if len(r) != len(st.fields):
            raise ValueError(f"row {r!r} does not match schema {st.simpleString()}")
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(r, st.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
