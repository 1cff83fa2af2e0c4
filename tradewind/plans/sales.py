"""Sales: one order id, re-based dates, repaired numbers, region by ship city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.dates import plus_days
from tradewind.functions.numbers import magnitude_or_zero, to_double
from tradewind.operators import calendar
from tradewind.operators.dimensions import CITY_REGION
from tradewind.operators.lookup import lookup
from tradewind.operators.quality import Rule

DATES = ("OrderDate", "RequiredDate", "ShippedDate")
MEASURES = ("UnitPrice", "Quantity", "Discount")
SHIPPING_DAYS = 7


def keep_one_order_id(sales: DataFrame) -> DataFrame:
    """The file has its order id twice; keep the first copy as OrderID."""
    return sales.drop("OrderID14").withColumnRenamed("OrderID0", "OrderID")


def rebase_dates(sales: DataFrame, unmapped: str = "drop") -> DataFrame:
    """Parse ``M/d/yy`` text and write it back as text with the year moved to 2021-2024."""
    return calendar.rebase_dates(sales, *DATES, unmapped=unmapped)


def cast_numbers(sales: DataFrame) -> DataFrame:
    return sales.withColumns({c: to_double(c) for c in ("Freight", *MEASURES)})


def repair_numbers(sales: DataFrame) -> DataFrame:
    """Prices, quantities and discounts as non-negative numbers, 0 for NULL."""
    return sales.withColumns({c: magnitude_or_zero(c) for c in MEASURES})


def fill_shipped_date(sales: DataFrame) -> DataFrame:
    """A missing ShippedDate becomes the re-based OrderDate plus a week; NULL if that has no year."""
    return sales.withColumn("ShippedDate", F.coalesce("ShippedDate", plus_days("OrderDate", SHIPPING_DAYS)))


def map_region(sales: DataFrame) -> DataFrame:
    """ShipRegion by ShipCity; an unmapped or missing city keeps the region it came with."""
    return lookup(sales, CITY_REGION, "ShipCity", "ShipRegion", F.col("ShipRegion"))


def sales_measures(bronze: DataFrame) -> DataFrame:
    """Repaired numbers only: what the totals per product and customer need of the cleaning."""
    return bronze.transform(keep_one_order_id).transform(cast_numbers).transform(repair_numbers)


def clean_sales(bronze: DataFrame, unmapped_years: str = "drop") -> DataFrame:
    """Bronze sales to silver sales, row by row; its only joins are with the broadcast calendar and city dimensions."""
    return (
        bronze.transform(keep_one_order_id)
        .transform(rebase_dates, unmapped_years)
        .transform(cast_numbers)
        .transform(repair_numbers)
        .transform(fill_shipped_date)
        .transform(map_region)
    )


def sales_rules() -> list[Rule]:
    rules = [Rule(f"{c} is missing", F.col(c).isNull(), "set to 0") for c in MEASURES]
    rules += [Rule(f"{c} is negative", F.col(c) < 0, "absolute value") for c in MEASURES]
    rules.append(Rule("Freight is negative", F.col("Freight") < 0, "kept"))
    rules += [
        Rule(f"{c} is not finite", F.abs(F.col(c)) >= float("inf"), "set to NULL") for c in ("Freight", *MEASURES)
    ]
    for c in DATES:
        rules.append(Rule(f"{c} is not M/d/yy", calendar.unreadable(c), "set to NULL"))
        rules.append(Rule(f"{c} has a year outside 95-98", calendar.unmapped_year(c), "year left out"))
    rules.append(Rule("ShippedDate is missing", F.col("ShippedDate").isNull(), "order date plus 7 days"))
    rules.append(
        Rule("ShipCity is not mapped", ~F.col("ShipCity").isin(*CITY_REGION), "ShipRegion left as it was")
    )
    return rules
