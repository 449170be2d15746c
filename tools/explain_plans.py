"""Print the physical plans of the headline queries as they would be chosen
for large tables (planner auto-broadcast off; explicit, size-checked
broadcasts stay), trimmed to operators. Output is markdown for PLANS.md.

    python tools/explain_plans.py [sf_dir] > /tmp/plans.md
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.queries import QUERIES  # noqa: E402
from strata.session import local_session  # noqa: E402

HEADLINE = ["material_on_time", "secured_material_on_time", "row_filter_entity",
            "spend_with_contract", "spend_latest_contract", "logistics_on_time",
            "upsert_single_key", "watermark_delta", "null_violations"]


def trimmed(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        m = re.search(r"(FileScan parquet) .*?(PushedFilters: \[[^\]]*\]).*?(ReadSchema: \S+)",
                      line)
        if m:
            line = line[:line.index("FileScan")] + " ".join(m.groups())
        line = re.sub(r"Project \[.{80,}\]", "Project [...]", line)
        out.append(line[:200])
    return "\n".join(out)


def large_batch_upsert(spark, sf):
    """upsert_single_key with a batch over the broadcast limit (shuffle path)."""
    from pyspark.sql import functions as F

    from strata.operators.upsert import upsert
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    cut = F.lit("2000-01-01").cast(orders.schema["o_orderdate"].dataType)
    return upsert(orders.where(F.col("o_orderdate") < cut),
                  orders.where(F.col("o_orderdate") >= cut), ["o_orderkey"], broadcast_limit=0)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session("explain", cores=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    plans = [(name, lambda n=name: QUERIES[n](spark, sf)) for name in HEADLINE]
    plans.append(("upsert (batch over the broadcast limit)",
                  lambda: large_batch_upsert(spark, sf)))
    for name, build in plans:
        df = build()
        print(f"### `{name}`\n\n```")
        print(trimmed(df._jdf.queryExecution().executedPlan().toString()))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
