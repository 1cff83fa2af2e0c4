"""Times the headline runs with a ``noop`` sink and prints one JSON line.

Bronze is landed as Parquet before the clock starts, in a scratch folder; then each step is timed from that lake: once
to warm up and three times more, of which the least counts. Products and customers read silver sales as written.

A test table is one Parquet row group, so bronze is written in as many files as there are cores, as a lake has many.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.operators import quality, segments
from tradewind.operators.reconcile import price_sync
from tradewind.plans import categories, customers, employees, graph, products, sales
from tradewind.plans.warehouse import order_headers
from tradewind.sources.datasets import DATASETS
from tradewind.sources.files import read_table, write_table
from tradewind.sources.scratch import scratch_path
from validation.raw_tables import RAW_TABLES

RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def landed(spark: SparkSession, sf_dir: str) -> str:
    """A lake with bronze, silver sales and silver categories, none of it timed."""
    lake = scratch_path(spark, "bench")
    for name in DATASETS:
        raw = RAW_TABLES[f"raw_{name}"](spark, sf_dir)
        write_table(raw.repartition(spark.sparkContext.defaultParallelism), lake, "bronze", name)
    for name, clean in (("sales", sales.clean_sales), ("categories", categories.clean_categories)):
        write_table(clean(read_table(spark, lake, "bronze", name)), lake, "silver", name)
    return lake


def headline(spark: SparkSession, lake: str) -> dict[str, Callable[[], DataFrame]]:
    def bronze(name: str) -> DataFrame:
        return read_table(spark, lake, "bronze", name)

    def silver(name: str) -> DataFrame:
        return read_table(spark, lake, "silver", name)

    def lines() -> DataFrame:
        return sales.keep_one_order_id(bronze("sales"))

    return {
        "silver_sales": lambda: sales.clean_sales(bronze("sales")),
        "silver_products": lambda: products.clean_products(bronze("products"), silver("sales"), silver("categories")),
        "silver_customers": lambda: customers.clean_customers(bronze("customers"), silver("sales")),
        "silver_categories": lambda: categories.clean_categories(bronze("categories")),
        "silver_employees": lambda: employees.clean_employees(bronze("employees")),
        "product_demand_tier": lambda: segments.with_demand_tier(bronze("products"), silver("sales")),
        "customer_value_tier": lambda: segments.with_value_tier(bronze("customers"), silver("sales")),
        "price_sync": lambda: price_sync(bronze("sales"), bronze("products")),
        "null_audit_sales": lambda: quality.null_audit(bronze("sales"), "sales"),
        "quality_report": lambda: quality.quality_report(bronze("sales"), "sales", sales.sales_rules()),
        "duplicate_keys": lambda: quality.duplicate_keys(lines(), "OrderID", "ProductID"),
        "graph_nodes_order": lambda: graph.order_nodes(order_headers(lines())),
        "graph_edges_order_product": lambda: graph.order_product_edges(lines(), bronze("products")),
        "graph_edges_sold": lambda: graph.sold_edges(order_headers(lines()), bronze("employees")),
    }


def seconds(run: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name, run in headline(spark, landed(spark, sf_dir)).items():
        seconds(run)
        times[name] = round(min(seconds(run) for _ in range(RUNS)), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
