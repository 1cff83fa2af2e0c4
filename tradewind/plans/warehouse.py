"""Whole runs over a lake: bronze to silver, the price-synced sales, the graph, and the audits."""

from __future__ import annotations

from collections.abc import Collection
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators import quality
from tradewind.operators.reconcile import price_sync
from tradewind.plans import graph
from tradewind.plans.categories import category_rules, clean_categories
from tradewind.plans.customers import clean_customers, customer_rules
from tradewind.plans.employees import clean_employees, employee_rules
from tradewind.plans.products import clean_products, product_rules
from tradewind.plans.sales import clean_sales, keep_one_order_id, sales_rules
from tradewind.plans.vat import clean_vat, vat_rules
from tradewind.sources.datasets import DATASETS
from tradewind.sources.files import read_table, write_table

# Bronze tables that have quality rules, and the keys that must be unique.
RULES = {
    "sales": sales_rules, "products": product_rules, "categories": category_rules, "customers": customer_rules,
    "employees": employee_rules, "tva": vat_rules,
}
UNIQUE = {"categories": ["CategoryID"], "products": ["ProductID"], "customers": ["CustomerID"], "employees": ["EmployeeID"]}
AUDITS = ("null_audit", "row_counts", "duplicate_keys", "quality_report")

SILVER = ("sales", "categories", "products", "customers", "employees", "vat", "suppliers")


def build_silver(
    spark: SparkSession, lake: str, tables: Collection[str] = SILVER, unmapped_years: str = "drop"
) -> None:
    """Write the silver tables of ``lake`` from its bronze tables, in dependency order.

    Products and customers read silver sales back as written, with only the columns their totals need, instead of
    repeating the cleaning. A failure of one table raises, and the tables before it stay written.
    """
    bronze = partial(read_table, spark, lake, "bronze")
    silver = partial(read_table, spark, lake, "silver")
    plans = {
        "sales": lambda: clean_sales(bronze("sales"), unmapped_years),
        "categories": lambda: clean_categories(bronze("categories")),
        "products": lambda: clean_products(bronze("products"), silver("sales"), silver("categories")),
        "customers": lambda: clean_customers(bronze("customers"), silver("sales")),
        "employees": lambda: clean_employees(bronze("employees")),
        "vat": lambda: clean_vat(bronze("tva")),
        "suppliers": lambda: bronze("suppliers"),
    }
    unknown = set(tables) - plans.keys()
    if unknown:
        raise ValueError(f"no silver table {', '.join(sorted(unknown))}")
    for name, plan in plans.items():
        if name in tables:
            write_table(plan(), lake, "silver", name)


def sync_prices(spark: SparkSession, lake: str) -> None:
    """Write bronze sales with catalogue prices to silver/price_sync."""
    bronze = partial(read_table, spark, lake, "bronze")
    write_table(price_sync(bronze("sales"), bronze("products")), lake, "silver", "price_sync")


def audit(spark: SparkSession, lake: str) -> None:
    """Write what the audits find to the audit layer of ``lake``: NULLs, row counts, repeated keys and quality rules.

    NULLs and rows are counted in bronze, and in silver where it has the table (``silver.sales``), so before and after
    the cleaning stand side by side. Order ids are checked on the order headers that the graph makes its nodes from.
    """
    layers = {"bronze": list(DATASETS), "silver": [t for t in SILVER if _has_table(spark, lake, "silver", t)]}
    tables = {
        f"{layer}.{name}": read_table(spark, lake, layer, name) for layer, names in layers.items() for name in names
    }
    keys = {name: (tables[f"bronze.{name}"], columns) for name, columns in UNIQUE.items()}
    keys["orders"] = (order_headers(keep_one_order_id(tables["bronze.sales"])), ["OrderID"])
    found = {
        "null_audit": [quality.null_audit(df, name) for name, df in tables.items()],
        "row_counts": [quality.row_counts(tables)],
        "duplicate_keys": [
            quality.duplicate_keys(df, *columns).select(
                F.lit(name).alias("table_name"), F.concat_ws(", ", *columns).alias("key"), "n"
            )
            for name, (df, columns) in keys.items()
        ],
        "quality_report": [
            quality.quality_report(tables[f"bronze.{name}"], "vat" if name == "tva" else name, rules())
            for name, rules in RULES.items()
        ],
    }
    for name in AUDITS:
        write_table(reduce(DataFrame.unionAll, found[name]), lake, "audit", name)


def _has_table(spark: SparkSession, lake: str, layer: str, name: str) -> bool:
    try:
        read_table(spark, lake, layer, name)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


GRAPH = (
    "nodes_customer", "nodes_product", "nodes_supplier", "nodes_employee", "nodes_category", "nodes_order",
    "edges_order_product", "edges_sold", "edges_purchased", "edges_supplies", "edges_part_of", "edges_reports_to",
)


def order_headers(order_lines: DataFrame) -> DataFrame:
    """What order nodes and their edges need of the lines, each combination once: about a row per order."""
    return order_lines.select("OrderID", "EmployeeID", "CustomerID", "ShipName").distinct()


def build_graph(spark: SparkSession, lake: str, tables: Collection[str] = GRAPH) -> None:
    """Write the node and edge tables of ``lake`` from its bronze tables to the graph layer.

    Order lines are reduced to order headers once, in a table of their own; order nodes, sales and purchases read that.
    """
    unknown = set(tables) - set(GRAPH)
    if unknown:
        raise ValueError(f"no graph table {', '.join(sorted(unknown))}")
    bronze = partial(read_table, spark, lake, "bronze")
    lines = keep_one_order_id(bronze("sales"))
    headers = lines
    if {"nodes_order", "edges_sold", "edges_purchased"} & set(tables):
        write_table(order_headers(lines), lake, "graph", "order_headers")
        headers = read_table(spark, lake, "graph", "order_headers")
    products, employees, customers = bronze("products"), bronze("employees"), bronze("customers")
    suppliers, categories = bronze("suppliers"), bronze("categories")
    plans = {
        "nodes_customer": graph.customer_nodes(customers),
        "nodes_product": graph.product_nodes(products),
        "nodes_supplier": graph.supplier_nodes(suppliers),
        "nodes_employee": graph.employee_nodes(employees),
        "nodes_category": graph.category_nodes(categories),
        "nodes_order": graph.order_nodes(headers),
        "edges_order_product": graph.order_product_edges(lines, products),
        "edges_sold": graph.sold_edges(headers, employees),
        "edges_purchased": graph.purchased_edges(headers, customers),
        "edges_supplies": graph.supplies_edges(products, suppliers),
        "edges_part_of": graph.part_of_edges(products, categories),
        "edges_reports_to": graph.reports_to_edges(employees),
    }
    for name in GRAPH:
        if name in tables:
            write_table(plans[name], lake, "graph", name)
