"""Time the headline queries on the files in ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Prints one JSON line. Every query runs once to warm up and once timed, from the raw files
to its last row, planning included.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lumbung.catalog import QUERIES
from lumbung.session import local_session

HEADLINE = [
    "int_customer_scd2", "int_order_item_enriched", "int_order_status_lifecycle", "fct_order_item", "fct_asof_events",
    "mart_city_performance", "mart_customer_segments", "mart_hourly_orders", "mart_monthly_revenue",
    "mart_payment_method_performance", "mart_product_performance", "mart_shipping_performance",
    "q01_monthly_trend", "q03_top_products", "q11_cancellation_stage", "q14_provider_quarter", "q15_loyalty_tier",
    "snk_keyed_merge", "rule_allocation", "dq_unique", "kpi_delivery_percentiles",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
