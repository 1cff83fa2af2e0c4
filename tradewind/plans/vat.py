"""VAT by country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.dimensions import VAT_COUNTRY_FIXES
from tradewind.operators.lookup import correct_values
from tradewind.operators.quality import Rule


def clean_vat(bronze: DataFrame) -> DataFrame:
    return correct_values(bronze, "Country", VAT_COUNTRY_FIXES)


def vat_rules() -> list[Rule]:
    return [Rule("Country is misspelt", F.col("Country").isin(*VAT_COUNTRY_FIXES), "corrected")]
