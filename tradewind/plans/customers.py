"""Customers: digits-only phones, corrected countries, region, continent and value tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.text import keep_digits
from tradewind.operators.dimensions import COUNTRY_REGION, CUSTOMER_COUNTRY_FIXES
from tradewind.operators.lookup import correct_values
from tradewind.operators.quality import Rule
from tradewind.operators.segments import with_continent, with_region, with_value_tier

FILLED = ("CompanyName", "City", "PostalCode", "Fax")


def clean_phones(customers: DataFrame) -> DataFrame:
    return customers.withColumns({c: keep_digits(c) for c in ("Phone", "Fax")})


def fill_unknown(customers: DataFrame) -> DataFrame:
    """Missing text becomes Unknown. Phone is left NULL, and a fax without digits is ``''``, so it stays."""
    return customers.fillna({c: "Unknown" for c in FILLED})


def correct_countries(customers: DataFrame) -> DataFrame:
    return correct_values(customers, "Country", CUSTOMER_COUNTRY_FIXES)


def clean_customers(bronze: DataFrame, silver_sales: DataFrame) -> DataFrame:
    """Bronze customers to silver customers. The sales total per customer is taken before the join."""
    return (
        bronze.transform(clean_phones)
        .transform(fill_unknown)
        .transform(correct_countries)
        .transform(with_region)
        .transform(with_continent)
        .transform(with_value_tier, silver_sales)
    )


def customer_rules() -> list[Rule]:
    country = F.col("Country")
    listed = [*COUNTRY_REGION, *CUSTOMER_COUNTRY_FIXES]
    rules = [Rule(f"{c} is missing", F.col(c).isNull(), "set to Unknown") for c in FILLED]
    rules.append(Rule("Country is misspelt", country.isin(*CUSTOMER_COUNTRY_FIXES), "corrected"))
    rules.append(
        Rule("Country has no region", country.isNull() | ~country.isin(*listed), "Region set to Unknown")
    )
    return rules
