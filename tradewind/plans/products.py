"""Products: repaired price and stock, parsed package size, demand tier and class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import digits_to_int, thousands_to_double
from tradewind.functions.text import keep_digits, leading_number, text_after_number
from tradewind.operators.quality import Rule
from tradewind.operators.segments import with_class, with_demand_tier


def repair_price(products: DataFrame) -> DataFrame:
    """``1k`` is 1000, negative is positive, anything else that is no number is NULL (not 0)."""
    return products.withColumn("UnitPrice", F.abs(thousands_to_double("UnitPrice")))


def repair_stock(products: DataFrame) -> DataFrame:
    return products.withColumns({c: digits_to_int(c) for c in ("UnitsInStock", "UnitsOnOrder")})


def parse_package(products: DataFrame) -> DataFrame:
    """``QuantityPerUnit`` into its leading Quantity and the Description after it."""
    return products.withColumns(
        {
            "Quantity": leading_number("QuantityPerUnit"),
            "Description": text_after_number("QuantityPerUnit"),
        }
    )


def clean_products(bronze: DataFrame, silver_sales: DataFrame, silver_categories: DataFrame) -> DataFrame:
    """Bronze products to silver products. The sales total per product is taken before the join."""
    return (
        bronze.fillna({"ProductName": "Unknown"})
        .transform(repair_price)
        .transform(repair_stock)
        .transform(parse_package)
        .transform(with_demand_tier, silver_sales)
        .transform(with_class, silver_categories)
    )


def product_rules() -> list[Rule]:
    price, stock = F.col("UnitPrice"), F.col("UnitsInStock")
    return [
        Rule("ProductName is missing", F.col("ProductName").isNull(), "set to Unknown"),
        Rule("UnitPrice has a k suffix", price.contains("k"), "k becomes 000"),
        Rule("UnitPrice is negative", thousands_to_double(price) < 0, "absolute value"),
        Rule(
            "UnitPrice is not a number",
            price.isNotNull() & thousands_to_double(price).isNull(),
            "set to NULL",
        ),
        Rule("UnitsInStock has other than digits", stock != keep_digits(stock), "digits kept"),
    ]
