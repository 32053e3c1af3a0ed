"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs per
query; each query's figure is the median of them after one warm-up run over the same tables.
A query's time covers plan building, staging and the consumption of every result row.
"""

from __future__ import annotations

import json
import os
import statistics
import time

import pyspark

from rollkeep.checks import QUERIES, enrolling
from rollkeep.session import local_session

HEADLINE = [
    "asof_seq",
    "asof_conditional",
    "dedupe_cascade",
    "interval_join_facts",
    "rollup_counts",
    "running_totals",
    "filing_full",
    "change_feed",
    "commuter_extract",
    "edi_run",
    "edi_members",
    "exception_view",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench")
    seconds, rows = {}, {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            enrolling.forget()  # a query's own writing and reading is part of its time
            start = time.perf_counter()
            df = QUERIES[name](spark, folder)
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    for table in ("orders", "customer", "lineitem"):
        rows[table] = spark.read.parquet(f"{folder}/{table}.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": spark.sparkContext.defaultParallelism,
                "spark": pyspark.__version__,
                "input_rows": rows,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
