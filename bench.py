"""Times the headline queries and prints one JSON line.

``full_build`` is everything from raw tables to checked, stored marts. The queries after it run on the
stored layers, as they would on a warehouse; ``dim_customers``, ``fact_orders`` and the upsert are
full builds from the cleaned tables. Results go to a sink that drops them, so no time is spent on
moving rows to the driver. ``validate_all`` checks copies of the tables in which rows break every rule, and so
reads everything; ``validate_stored`` is the check that a build makes.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from tradewind.plans.catalog import build_queries, monthly_orders, open_warehouse, stale_fact_orders
from tradewind.plans.incremental import refresh_fact_orders
from tradewind.operators.quality import validate_all
from tradewind.plans.batch import run_batch
from tradewind.schemas import RULES
from tradewind.session import build_session, fresh_path
from tradewind.sources.testdata import READERS, raw_table

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
QUERIES = (
    "bench_raw_category_revenue",
    "bench_star_category_revenue",
    "dim_customers",
    "fact_orders",
    "fact_sales",
    "flat_items",
    "kpi_monthly",
    "kpi_category",
    "kpi_customer_summary",
    "report_monthly_kpi",
    "validate_all",
    "audit_sql_log",
    "semantic_lookup",
)


def timed(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = {name: raw_table(spark, FOLDER, name) for name in READERS}
    rows = sum(df.count() for df in raw.values())  # Also warms the session up.
    seconds = {"full_build": timed(lambda: run_batch(spark, raw, fresh_path(spark, "bench")))}
    # Fill the layers the queries share, so each is timed on its own work.
    warehouse = open_warehouse(spark, FOLDER)
    warehouse.marts(["fact_orders", "fact_sales", "flat_items", "fact_order_item_sales"])
    queries = build_queries()
    details = ("customers", "order_items", "order_payments", "order_reviews")
    # The target as it stood three days ago and the orders by month, not timed.
    target, by_month = stale_fact_orders(warehouse), monthly_orders(warehouse)
    others = [warehouse.stage(n) for n in details]
    # It ends with the published version; nothing is left to read.
    seconds["upsert_fact_orders"] = timed(
        lambda: refresh_fact_orders(target, fresh_path(spark, "bench"), by_month, *others)
    )
    # The checks of the stored tables, as a build runs them: by the counts taken while they were written.
    stored = {name: warehouse.cleaned(name) for name in RULES}
    fact = warehouse.mart("fact_order_item_sales")
    seconds["validate_stored"] = timed(
        lambda: drain(validate_all(stored, fact, warehouse.measured))
    )
    for name in QUERIES:
        seconds[name] = timed(lambda n=name: drain(queries[n](spark, FOLDER)))
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "raw_rows": rows,
                "full_build_rows_per_sec": round(rows / seconds["full_build"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
