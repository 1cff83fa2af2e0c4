"""Sales amounts per line, and their totals per product and per customer.

Totals are one hash aggregation each. Spark combines rows before the shuffle, so a key that holds a large share
of all sales sends one row per task, not all its rows. Amounts are computed in double and summed as decimals, so no
factor is rounded and sums do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import exact_amount


def line_revenue(sales: DataFrame, out: str = "total_sales_per_product") -> DataFrame:
    """Price times quantity, before discount."""
    return sales.withColumn(out, F.col("UnitPrice") * F.col("Quantity"))


def line_net_total(sales: DataFrame, out: str = "total_commande") -> DataFrame:
    """Price times quantity, less discount."""
    return sales.withColumn(out, F.col("UnitPrice") * F.col("Quantity") * (1 - F.col("Discount")))


def product_totals(sales: DataFrame) -> DataFrame:
    """Revenue (discount ignored) and quantity per product, from repaired sales."""
    revenue = exact_amount(F.col("UnitPrice") * F.col("Quantity"))
    return sales.groupBy("ProductID").agg(
        F.sum(revenue).cast("double").alias("total_revenue"),
        F.sum(exact_amount("Quantity")).cast("double").alias("total_quantity_sold"),
    )


def customer_totals(sales: DataFrame) -> DataFrame:
    """Net total (discount applied) per customer, from repaired sales."""
    net = exact_amount(F.col("UnitPrice") * F.col("Quantity") * (1 - F.col("Discount")))
    return sales.groupBy("CustomerID").agg(F.sum(net).cast("double").alias("total_commande_client"))
