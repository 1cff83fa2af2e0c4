"""Categories: plain text, and name and description filled from each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.text import first_token, is_blank, keep_alphanumeric
from tradewind.operators.quality import Rule


def strip_symbols(categories: DataFrame) -> DataFrame:
    return categories.withColumns(
        {
            "CategoryName": keep_alphanumeric("CategoryName"),
            "Description": keep_alphanumeric("Description", also=","),
        }
    )


def cross_fill(categories: DataFrame) -> DataFrame:
    """A blank name takes the first word of the description; then a blank description takes the name."""
    name, description = F.col("CategoryName"), F.col("Description")
    return categories.withColumn(
        "CategoryName", F.when(is_blank(name), first_token(description)).otherwise(name)
    ).withColumn("Description", F.when(is_blank(description), name).otherwise(description))


def clean_categories(bronze: DataFrame) -> DataFrame:
    return bronze.transform(strip_symbols).transform(cross_fill).drop("Picture")


def category_rules() -> list[Rule]:
    return [
        Rule("CategoryName is blank", is_blank("CategoryName"), "first word of Description"),
        Rule("Description is blank", is_blank("Description"), "CategoryName"),
        Rule(
            "CategoryName has symbols",
            F.col("CategoryName") != keep_alphanumeric("CategoryName"),
            "symbols removed",
        ),
    ]
