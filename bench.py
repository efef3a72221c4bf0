"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

# largest inputs and hardest operators: text, windows, joins, lineage, names, whole workflow
HEADLINE = [
    "count_by_rank",
    "explode_lines",
    "rank_from_suffix",
    "unescape_pages",
    "alias_status",
    "carry_forward_global",
    "carry_forward_by_user",
    "next_start_intervals",
    "row_sequence",
    "equi_parent",
    "range_parent",
    "banded_parent",
    "cascade_parent",
    "lineage_flat",
    "lineage_columns",
    "hierarchical_order",
    "match_summary",
    "new_name_status",
    "quality_report",
    "dwc_taxa",
]


def main() -> None:
    from taxaloom.catalog import QUERIES
    from taxaloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before timing
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
