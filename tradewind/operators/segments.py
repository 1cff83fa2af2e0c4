"""Business grades: demand tier and class of products, value tier of customers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.dimensions import COUNTRY_CONTINENT, COUNTRY_REGION
from tradewind.operators.lookup import lookup
from tradewind.operators.totals import customer_totals, product_totals

# Words in a category name -> product class, and category names by origin.
CLASS_WORDS = {
    "Drinks": ("Beverages",),
    "Food": ("GrainsCereals", "Condiments", "Confections", "Cheeses", "MeatPoultry", "Produce", "Seafood"),
    "Tech": ("Tech",),
}
# The borders of the tiers.
HIGH_REVENUE, HIGH_QUANTITY = 10000, 500
MEDIUM_REVENUE, MEDIUM_QUANTITY = (2000, 10000), (100, 500)
VIP_TOTAL = 10000
MIDDLE_TOTAL = (5000, 10000)

ORIGIN_CATEGORIES = {
    "Animal": ("Cheeses", "MeatPoultry", "Seafood"),
    "Plant": ("Beverages", "Condiments", "Confections", "GrainsCereals", "Produce"),
}


def demand_tier(revenue: Column, quantity: Column) -> Column:
    """High needs both measures above the range, Medium one of them inside it; the rest, NULL too, is Low.

    The rule has gaps: a large revenue with few pieces sold is Low.
    """
    return (
        F.when((revenue > HIGH_REVENUE) & (quantity > HIGH_QUANTITY), "High Demand")
        .when(revenue.between(*MEDIUM_REVENUE) | quantity.between(*MEDIUM_QUANTITY), "Medium Demand")
        .otherwise("Low Demand")
    )


def value_tier(net_total: Column) -> Column:
    return (
        F.when(net_total > VIP_TOTAL, "VIP")
        .when(net_total.between(*MIDDLE_TOTAL), "Moyen")
        .otherwise("Low")
    )


def product_class(category_name: Column) -> Column:
    """Class by words in the category name, case-sensitive; ``autres`` for anything else and NULL."""
    branches = F
    for label, words in CLASS_WORDS.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | category_name.contains(word)
        branches = branches.when(hit, label)
    return branches.otherwise("autres")


def product_origin(category_name: Column) -> Column:
    branches = F
    for label, names in ORIGIN_CATEGORIES.items():
        branches = branches.when(category_name.isin(*names), label)
    return branches.otherwise("Unknown")


def with_demand_tier(products: DataFrame, sales: DataFrame, out: str = "StatutProduit") -> DataFrame:
    """Products with their demand tier. ``sales`` are repaired; products without sales are Low."""
    totals = product_totals(sales)
    tier = demand_tier(F.col("total_revenue"), F.col("total_quantity_sold"))
    return (
        products.join(totals, "ProductID", "left")
        .withColumn(out, tier)
        .select(*products.columns, out)
    )


def with_value_tier(customers: DataFrame, sales: DataFrame, out: str = "StatutClient") -> DataFrame:
    """Customers with their value tier. ``sales`` are repaired; customers without sales are Low."""
    totals = customer_totals(sales)
    return (
        customers.join(totals, "CustomerID", "left")
        .withColumn(out, value_tier(F.col("total_commande_client")))
        .select(*customers.columns, out)
    )


def with_category(products: DataFrame, categories: DataFrame, grade, out: str) -> DataFrame:
    """Products with ``grade(category name)``. A category listed twice repeats its products.

    The size of ``categories`` is not known here, so there is no broadcast hint: Spark broadcasts it when its
    size allows, and else shuffles on CategoryID, where adaptive execution splits an over-full category.
    """
    names = categories.select("CategoryID", F.col("CategoryName").alias("_category_name"))
    return (
        products.join(names, "CategoryID", "left")
        .withColumn(out, grade(F.col("_category_name")))
        .select(*products.columns, out)
    )


def with_class(products: DataFrame, categories: DataFrame, out: str = "ClassProduct") -> DataFrame:
    return with_category(products, categories, product_class, out)


def with_origin(products: DataFrame, categories: DataFrame, out: str = "OriginProduct") -> DataFrame:
    return with_category(products, categories, product_origin, out)


def with_region(customers: DataFrame, regions: Mapping[str, str] = COUNTRY_REGION) -> DataFrame:
    """Sales region of the (corrected) country. Overwrites Region; ``Unknown`` for NULL and unlisted."""
    return lookup(customers, regions, "Country", "Region", F.lit("Unknown"))


def with_continent(
    customers: DataFrame, continents: Mapping[str, str] = COUNTRY_CONTINENT, out: str = "CodeRegion"
) -> DataFrame:
    """Two-letter continent code of the country; ``Unknown`` for NULL and unlisted."""
    return lookup(customers, continents, "Country", out, F.lit("Unknown"))
