"""Headline queries on one machine: prints one JSON line with the median of three warm runs and the cold run of each query.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 8).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gallery.catalog import EXAMPLES  # noqa: E402
from sparkmart.session import local_session  # noqa: E402

HEADLINES = (
    "monthly_revenue",
    "issues_order_items",
    "cleansed_order_items",
    "cleansed_orders",
    "line_duplicates",
    "reload_duplicates",
    "merge_second_load",
    "dim_customer",
    "dim_product",
    "dimension_reload",
    "fact_sales",
    "fact_payments",
    "sales_measures_by_month",
    "status_share",
    "top_categories",
    "kpi_cards",
    "text_lengths_order_items",
    "price_summary",
    "mixed_payment_orders",
    "orphans",
    "normalised_documents",
    "read_quoted_splits",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    memory = os.environ.get("BENCH_MEMORY", "16g")
    spark = local_session("bench", cores, memory)
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in HEADLINES:
        took = []
        for attempt in range(runs + 1):
            start = time.perf_counter()
            EXAMPLES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            if attempt:
                took.append(spent)
            else:  # warms up, and writes the derived tables that the query reads if it is the first to need them
                cold[name] = round(spent, 3)
        times[name] = round(statistics.median(took), 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "cold": cold, "sf": float(scale.group(1)) if scale else None,
        "master": f"local[{cores}]", "driver_memory": memory, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
