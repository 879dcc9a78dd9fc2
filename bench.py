"""Time the headline loads; prints one JSON line.

A few loads run first to warm up; then each query runs ``BENCH_RUNS`` times
(median). A run computes every result row and column without collecting them.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from siltstone import catalog
from siltstone.session import local_session

WARM_UP = ["segment_counts", "merge_partitioned", "date_dim"]
HEADLINE = [
    "segment_counts",
    "segment_counts_by_status",
    "revenue_by_category",
    "star_lookup",
    "changes_classified",
    "dense_keys",
    "scd1_final",
    "scd2_final",
    "date_dim",
    "member_dim",
    "merge_upsert_all",
    "merge_partitioned",
    "fact_final",
    "silver_upsert",
    "order_fact",
    "watermark_extract",
    "stream_union",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    catalog.load_all()
    spark = local_session("bench", cpus)

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in WARM_UP:
        run(name)
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
