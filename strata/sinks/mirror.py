"""UAT mirror of harmonised tables (DCL-3, DCL-4, SEC-4).

A mirror copies a production table into another database: a *deep* mirror
writes a snapshot (a full, independent copy), a *shallow* mirror is a view
on the source (context tables that are read, never modified). Either way
the public name can be a masking view, so developers see masked values and
the business group real ones, decided per query by ``current_user()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from strata.functions.columns import sql_name
from strata.operators.security import masked_select_sql
from strata.sinks.publish import SnapshotSink


def mirror_table(spark: SparkSession, source_table: str, sink: SnapshotSink, name: str,
                 deep: bool = True, masked: Sequence[str] = (),
                 allowed_groups: Sequence[str] = (), membership_table: str | None = None,
                 pin_from: SnapshotSink | None = None) -> str:
    """Copy (deep) or reference (shallow) ``source_table`` as ``sink.database.name``.

    A shallow table follows its source. With ``pin_from``, the sink of the source, it
    is a clone instead: a view of the snapshot that is current now, which later
    publishes of the source neither change nor expire (``SnapshotSink.unpin``). A
    clone made anew releases the snapshot before it."""
    if pin_from is not None and not deep:
        clone, table = sink.public_name(name), source_table.rsplit(".", 1)[-1].removesuffix("__base")
        pin_from.unpin(table, clone)
        source_table = pin_from.pin(table, clone)
    df = spark.table(sql_name(source_table))
    if deep:
        sink.publish(df, name)
    else:
        spark.sql(f"CREATE OR REPLACE VIEW {sink.base_view(name)} AS SELECT * FROM {source_table}")
    if masked:
        if not membership_table:
            raise ValueError("masking needs a membership table")
        body = masked_select_sql(sink.base_view(name), df.columns, list(masked),
                                 list(allowed_groups), membership_table)
        return sink.set_public_view(name, body)
    return sink.set_public_view(name)


def mirror_schema(spark: SparkSession, source_db: str, sink: SnapshotSink,
                  modified: Sequence[str], context: Sequence[str], **mask_kwargs) -> dict:
    """DCL-4: deep-copy the tables a change modifies, shallow-link the rest."""
    out = {}
    for t in modified:
        out[t] = mirror_table(spark, f"{source_db}.{t}", sink, t, deep=True, **mask_kwargs)
    for t in context:
        out[t] = mirror_table(spark, f"{source_db}.{t}", sink, t, deep=False, **mask_kwargs)
    return out
