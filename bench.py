"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from linkharbor.catalog.queries import QUERIES
from linkharbor.session import build_session, delete_run_folders

HEADLINE = (
    "scan_edges",
    "edges_to_targets",
    "assemble_graph_edges",
    "normalize_domain",
    "validate_edges",
    "build_domain_edges",
    "load_graph_edges",
    "stg_domain_edges",
    "stg_domain_ranks",
    "int_referring_domain_company",
    "int_matrix",
    "int_competitor_overlap",
    "int_evidence_examples",
    "fct_opportunities",
    "company_summary",
    "competitor_overlap",
    "dq_unique_combination",
    "measure_filtered_count",
    "q_top_opportunities",
    "q_tier_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    keys = sys.argv[1:] or list(HEADLINE)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            # Small inputs: keep a task per core instead of merging to partitions of 1 MB.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for key in keys:
        best = None
        for _ in range(2):  # the first run compiles, the second counts
            started = time.perf_counter()
            QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - started
            best = spent if best is None else min(best, spent)
        times[key] = round(best, 3)
    delete_run_folders(spark)
    spark.stop()
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
