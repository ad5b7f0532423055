"""Benchmark of the headline queries.

Runs each query once to warm up, then ``BENCH_REPEAT`` times (default 3)
into the ``noop`` sink, and prints one JSON line with the median seconds per
query.  ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS``
(default 8) select the data and the local parallelism.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from matchspan.session import local_session  # noqa: E402
from matchspan.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    "match_ranges_ignore",
    "match_ranges_assume_start",
    "match_ranges_end_only",
    "match_ranges_hot_key",
    "next_event",
    "windowed_value_set",
    "range_frame_sum",
    "dedup_subset",
    "argmin_per_group",
    "frame_diff_multiset",
    "group_count",
    "explode_outer_array",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    # Local sizing: the sf0.1 tables are a few MB, so let AQE keep enough
    # post-shuffle partitions to use every core (cluster runs keep 64 MB).
    extra = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
    }
    extra.update(kv.split("=", 1) for kv in os.environ.get("BENCH_CONF", "").split(",") if kv)
    spark = local_session(cpus, shuffle_partitions=max(cpus * 2, 8), app="matchspan-bench", extra=extra)
    timings: dict[str, float] = {}
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "median_sec_sum",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
