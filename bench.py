"""Headline queries, timed on BENCH_SF_DIR. Prints one JSON line.

Every query starts from the Parquet files; nothing is shared between them.
"""

from __future__ import annotations

import json
import os
import time

from cohortlens import session
from cohortlens.checks.queries import QUERIES

HEADLINES = (
    "src_extract",            # fact -> customer table
    "dq_report",              # contract check
    "agg_segment_dist",       # customer table -> cohorts
    "prof_segment_profiles",  # cohorts -> profiles
    "sink_run_artifacts",     # whole run with all tables written
    "agg_describe",           # exact percentiles
    "agg_corr",
    "win_equal_split",
    "agg_cube_demographics",
    "prof_overrep",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session.local(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    times: dict[str, float] = {}
    for key in HEADLINES:
        start = time.perf_counter()
        # The noop sink computes every column of every row.
        QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of headline query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
