"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 BENCH_SHARED_DIR=/tmp/bench python bench.py

``BENCH_SHARED_DIR`` is the session's ``spark.checkpoint.dir`` (default: a fresh folder
below the system's temporary one; the benchmark runs in one process).

Each query runs to completion through the ``noop`` sink (every row computed, none
collected to the driver).  One warm-up query pays for JVM start.  Every query runs
twice: ``queries`` holds the faster run (code generation cached, as for a query
that a dashboard repeats) and ``cold_value`` the sum of the first runs.  Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from beatstream.plans.catalog import QUERIES  # noqa: E402
from beatstream.session import build_session  # noqa: E402

HEADLINE = [
    "mobile_trend",
    "top_regions_and_users",
    "level_gender_trend",
    "applink_by_age",
    "demographics",
    "enrich_plays",
    "enrich_parsed_lines",
    "flag_ad_targets",
    "build_features",
    "top_tracks_by_gender",
    "daypart_average",
    "access_stats",
    "repeat_listens",
    "repeat_listens_coarse",
    "trending_tags",
    "daily_spend",
    "stream_trending_tags",
    "stream_ad_flags",
    "stream_top_tracks_by_gender",
    "stream_repeat_listens",
    "stream_model_flags",
    "compact_index",
    "upsert_customers",
    "train_and_score",
    "compare_models",
    "plays_by_customer",
    "missing_customers",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="beatstream-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR")
                                 or tempfile.mkdtemp(prefix="beatstream-bench-")})
    run(spark, "count_docs", sf_dir)  # warm-up
    cold, warm = {}, {}
    for n in names:
        cold[n] = run(spark, n, sf_dir)
        warm[n] = min(cold[n], run(spark, n, sf_dir))
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": {n: round(v, 3) for n, v in warm.items()},
                      "cold_value": round(sum(cold.values()), 3), "runs": 2, "stat": "min",
                      "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
