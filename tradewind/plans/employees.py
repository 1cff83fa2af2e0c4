"""Employees: plain names, digits-only phone, parsed dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.dates import parse_date
from tradewind.functions.text import keep_digits, keep_person_name
from tradewind.operators.dimensions import EMPLOYEE_COUNTRY_FIXES
from tradewind.operators.lookup import correct_values
from tradewind.operators.quality import Rule

# The date columns of the file and how it writes dates.
DATES = ("BirthDate", "HireDate")
DATE_PATTERN = "MM/dd/yy"


def clean_names(employees: DataFrame) -> DataFrame:
    return employees.withColumns(
        {
            "LastName": keep_person_name("LastName"),
            "FirstName": keep_person_name("FirstName"),
            "HomePhone": keep_digits("HomePhone"),
        }
    )


def correct_countries(employees: DataFrame) -> DataFrame:
    return correct_values(employees, "Country", EMPLOYEE_COUNTRY_FIXES)


def parse_dates(employees: DataFrame) -> DataFrame:
    """``MM/dd/yy`` with two digits each, else NULL. Birth years get no century repair: 48 is 2048."""
    return employees.withColumns({c: parse_date(c, DATE_PATTERN) for c in DATES})


def clean_employees(bronze: DataFrame) -> DataFrame:
    return (
        bronze.transform(clean_names)
        .transform(correct_countries)
        .transform(parse_dates)
        .drop("Photo")
        .fillna({"Title": "Unknown", "Region": "Unknown"})
    )


def employee_rules() -> list[Rule]:
    rules = [
        Rule(f"{c} has other than letters", F.col(c) != keep_person_name(c), "other characters removed")
        for c in ("LastName", "FirstName")
    ]
    rules.append(Rule("Country is misspelt", F.col("Country").isin(*EMPLOYEE_COUNTRY_FIXES), "corrected"))
    rules += [
        Rule(
            f"{c} is not MM/dd/yy",
            F.col(c).isNotNull() & parse_date(c, "MM/dd/yy").isNull(),
            "set to NULL",
        )
        for c in DATES
    ]
    rules += [Rule(f"{c} is missing", F.col(c).isNull(), "set to Unknown") for c in ("Title", "Region")]
    return rules
