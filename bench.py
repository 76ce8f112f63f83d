"""Time the headline queries, the better of two runs each, and print one JSON line.

``BENCH_QUERIES`` names other queries, separated by commas, or ``all``.
"""

from __future__ import annotations

import json
import os
import time

from querylens.plans.catalog import QUERIES
from querylens.session import build_session

HEADLINE = (
    "flatten_search_export",
    "normalize_query",
    "jaro_winkler_score",
    "match_fuzzy",
    "classify_queries",
    "entity_metrics",
    "attributed_metrics",
    "unified_metrics",
    "ctr_residual",
    "build_from_exports",
    "share_of_total",
    "merge_loads",
    "load_search_export",
    "stream_upsert",
    "snapshot_in_effect",
    "scd2_intervals",
    "scd2_join",
    "quality_report",
)
RUNS = 2


def run(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    asked = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE))
    names = list(QUERIES) if asked == "all" else asked.split(",")
    spark = build_session("bench", cpus, shuffle_partitions=cpus, memory="12g")
    run(spark, QUERIES["global_metrics"], sf_dir)  # starts the JVM's compilers and the file cache
    seconds = {name: round(min(run(spark, QUERIES[name], sf_dir) for _ in range(RUNS)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
