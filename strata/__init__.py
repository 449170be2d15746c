"""strata: layered batch tables on Spark.

Landing -> harmonised -> curated loads, keyed upserts, group-driven row
filters and column masks, audit and control tables, contract checks.

The main entry points are re-exported here::

    from strata import harmonise, upsert, row_filter, mask_columns, SnapshotSink
"""

__version__ = "0.1.0"

from strata.operators.checks import contract_findings, null_counts, raise_on_errors  # noqa: E402
from strata.operators.harmonise import TableSpec, harmonise, watermark_filter  # noqa: E402
from strata.operators.security import mask_columns, row_filter, secure  # noqa: E402
from strata.operators.upsert import load_frame, upsert  # noqa: E402
from strata.plans.jobs import load, run_fact_job, run_harmonise_job  # noqa: E402
from strata.session import ensure_defaults  # noqa: E402
from strata.sinks.audit import RunLog  # noqa: E402
from strata.sinks.partitioned import PartitionedSink  # noqa: E402
from strata.sinks.publish import SnapshotSink  # noqa: E402

__all__ = [
    "TableSpec", "harmonise", "watermark_filter", "upsert", "load_frame", "row_filter",
    "mask_columns", "secure", "contract_findings", "null_counts", "raise_on_errors", "load",
    "run_fact_job", "run_harmonise_job", "ensure_defaults", "RunLog", "SnapshotSink",
    "PartitionedSink",
]
