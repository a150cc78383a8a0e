"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is timed end to end (plan + run + collect of its result, written
to a noop sink so nothing is pulled to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from chartstreak.plans import REGISTRY  # noqa: E402
from chartstreak.plans.queries import labelled  # noqa: E402
from chartstreak.session import get_session  # noqa: E402

HEADLINE = [
    "csv_ingest", "hit_detect", "label_final", "label_causal", "longest_streak", "strict_parse",
    "pipeline_counters", "describe_bands", "song_profile", "json_roundtrip", "class_balance",
    "percent_normalise", "importance_unpivot", "grouped_kmeans", "stream_hit_detect",
    "hit_detect_retract", "label_final_wide", "csv_ingest_wide", "grouped_kmeans_wide", "stream_hit_detect_wide",
    "forest_importance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, driver_memory="16g")
    # warm-up: JVM, codegen caches
    labelled(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only:
        fn = REGISTRY[name][0]
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
