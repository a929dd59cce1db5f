"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 4), BENCH_RUNS (default 3) and
BENCH_QUERIES (comma list, default the headline queries, "all" for every one).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from lakemart.plans.lineage import clear_scratch
from lakemart.queries import QUERIES
from lakemart.session import local_session

HEADLINE = [
    "normalise_text",
    "symbol_labels",
    "content_key",
    "dedup_latest",
    "dedup_any",
    "upsert",
    "upsert_composite",
    "key_gate_dups",
    "chain_resolve",
    "chain_attach",
    "dim_build",
    "fact_build",
    "dim_changed_ids",
    "fact_incremental",
    "propagate_end_to_end",
    "dq_report",
    "variant_spread",
    "appreciation",
]


def timed(spark, folder: str, name: str) -> float:
    """Seconds to compute every row and column of a query."""
    start = time.perf_counter()
    rows = QUERIES[name](spark, folder)
    rows.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = HEADLINE if not chosen else list(QUERIES) if chosen == "all" else chosen.split(",")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "4")))
    seconds = {}
    for name in names:
        timed(spark, folder, name)
        seconds[name] = round(statistics.median(timed(spark, folder, name) for _ in range(runs)), 3)
        clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
