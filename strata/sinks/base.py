"""The interface every sink offers to the job runners.

``SnapshotSink`` (immutable snapshots behind a view pointer, the default),
``PartitionedSink`` (rewrite touched partitions only) and ``MergeIntoSink``
(the table format's own MERGE) all satisfy it; ``plans.jobs.load`` picks the
upsert path by type.
"""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame


@runtime_checkable
class Sink(Protocol):
    database: str

    def exists(self, name: str) -> bool: ...

    def read(self, name: str) -> DataFrame: ...

    def publish(self, df: DataFrame, name: str, keys=None, **kwargs) -> int: ...

    def base_view(self, name: str) -> str: ...

    def public_name(self, name: str) -> str: ...

    def set_public_view(self, name: str, sql_body: str | None = None) -> str: ...
