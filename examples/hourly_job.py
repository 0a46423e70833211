"""Run the hourly job end to end on the driver's test tables.

    python examples/hourly_job.py [sf_dir] [date] [hour]

Stages the raw signals as a table partitioned by date/hour and the subtype dimension as a
table (both under the session's scratch folder), creates the scored target table, replaces one
hour of it, prints that hour's rows and the plan of the job's input.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sigscore.plans.inspect import plan_text  # noqa: E402
from sigscore.plans.job import JobConfig, cook_hour, run_hour  # noqa: E402
from sigscore.schemas import PARTITION_COLUMNS, SCORED_SCHEMA  # noqa: E402
from sigscore.session import build_session, scratch_path, unique_name  # noqa: E402
from sigscore.sinks import tables as W  # noqa: E402
from sigscore.sources import fixtures as X  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    date = sys.argv[2] if len(sys.argv) > 2 else "2024-01-12"
    hour = sys.argv[3] if len(sys.argv) > 3 else "16"
    spark = build_session()

    raw_table, dim_table, target = (unique_name(n) for n in ("raw", "subtype_dim", "scored"))
    W.save_table(X.raw_signals(spark, sf), raw_table, fmt="parquet",
                 partition_by=PARTITION_COLUMNS, path=scratch_path(spark, raw_table))
    W.save_table(X.subtype_dim(spark), dim_table, fmt="parquet",
                 path=scratch_path(spark, dim_table))
    W.create_table(spark, target, SCORED_SCHEMA, "parquet", PARTITION_COLUMNS,
                   scratch_path(spark, target))

    cfg = JobConfig(source_table=raw_table, target_table=target, dimension=dim_table)
    print(plan_text(cook_hour(spark, cfg, date, hour)))
    written = run_hour(spark, cfg, date, hour, "NA")
    written.orderBy("root_id", "meta_past_halflife").show(20, truncate=False)
    print(f"{written.count()} rows in {target} for {date} hour {hour}")
    spark.stop()


if __name__ == "__main__":
    main()
