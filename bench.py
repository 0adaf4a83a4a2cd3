"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3). Each query is built and run end to end (any
state-fitting jobs included) into the ``noop`` sink, once to warm up, then
``BENCH_REPEAT`` times; the median wall time is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["metrics_report", "threshold_metrics", "group_metrics", "bootstrap_disparities",
            "clean_dataframe", "column_missing_percent", "stratified_split",
            "top_contributions_json"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from binscope import catalog
    from binscope.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, cpus))
    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = catalog.QUERIES[name]
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_median_query_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
