"""Sale prices against catalogue prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import to_double

# The names under which the reconciled sales carry key and price, and the second order id they lack.
OUTPUT_NAMES = {"ProductID": "sales_ProductID", "UnitPrice": "sales_UnitPrice"}
SECOND_ORDER_ID = "OrderID14"


def _listed(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with the catalogue price of their product as ``listed_price``, NULL where there is none.

    Sales are many per product, and one product may dominate. Where the catalogue is too large to broadcast, the join
    shuffles, and adaptive execution splits the dominating product: a left join may be split on the sales side.
    """
    catalogue = products.select("ProductID", to_double("UnitPrice").alias("listed_price"))
    return sales.join(catalogue, "ProductID", "left")


def price_sync(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Raw sales with their price replaced by the catalogue's; NULL where the product or its price is missing."""
    value = {"UnitPrice": F.col("listed_price")}
    return _listed(sales, products).select(
        *(
            value.get(name, F.col(name)).alias(OUTPUT_NAMES.get(name, name))
            for name in sales.columns
            if name != SECOND_ORDER_ID
        )
    )


def price_mismatches(sales: DataFrame, products: DataFrame, null_safe: bool = False) -> DataFrame:
    """Raw sales whose price differs from the catalogue's, with both prices.

    A missing price on either side is no mismatch, unless ``null_safe``: then it is one if the other is present.
    """
    sold, listed = to_double("UnitPrice"), F.col("listed_price")
    differs = ~sold.eqNullSafe(listed) if null_safe else sold != listed
    found = _listed(sales, products).where(differs).withColumn("UnitPrice", sold)
    return found.withColumnsRenamed(OUTPUT_NAMES | {"listed_price": "products_UnitPrice"})
