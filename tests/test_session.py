"""Results do not depend on ANSI mode or the session time zone."""

from __future__ import annotations

from collections import Counter
from contextlib import contextmanager

import pytest

from tradewind.functions.dates import REBASED_YEARS
from tradewind.operators.calendar import calendar
from validation.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def setting(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize(
    "name",
    [
        "silver_sales",
        "silver_products",
        "silver_customers",
        "silver_employees",
        "null_percentages",
        "price_sync",
        "quality_report",
        "graph_edges_order_product",
    ],
)
def test_ansi_mode_and_time_zone(spark, name):
    expected = rows(QUERIES[name](spark, SF_DIR))
    with setting(spark, "spark.sql.ansi.enabled", "false"):
        assert rows(QUERIES[name](spark, SF_DIR)) == expected
    with setting(spark, "spark.sql.session.timeZone", "America/Sao_Paulo"):
        assert rows(QUERIES[name](spark, SF_DIR)) == expected


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Pacific/Apia", "Asia/Tehran"])
def test_no_day_is_lost_in_a_zone_that_skips_midnight_or_a_day(spark, zone):
    expected = rows(calendar(spark, REBASED_YEARS, "keep"))
    with setting(spark, "spark.sql.session.timeZone", zone):
        assert rows(calendar(spark, REBASED_YEARS, "keep")) == expected
