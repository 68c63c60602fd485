"""Benchmark: time the headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full with the no-op sink (every row is computed, nothing is
collected to the driver); the reported value is the sum of the per-query wall times.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "a9_delay_rate_by_carrier",
    "l1_preprocess",
    "a6_missing_profile",
    "l4_airport_features",
    "w1_rolling_rate_dense",
    "l6_build_features",
    "l7_featurizer_train_to_test",
    "j5_station_map",
    "j6_asof_nearest",
    "s6_isd_parse",
    "j8_bbox_congestion",
    "m6_classification_metrics",
    "m9_threshold_sweep",
    "m13_c18_explanations",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(HEADLINE)

    from ontime_spark.registry import QUERIES
    from ontime_spark.session import get_spark

    spark = get_spark("ontime_spark_bench", master=f"local[{cpus}]",
                      shuffle_partitions=max(8, 2 * cpus),
                      conf={"spark.driver.memory": "16g",
                            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-ckpt-")})
    # Warm-up: JVM start, file listing and code paths shared by all queries.
    QUERIES["a10_distinct_airports"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
