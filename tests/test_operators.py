"""Operators on small literal tables."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.operators import lookup as lookups
from tradewind.operators import quality, reconcile, segments, totals
from tradewind.plans import graph
from tradewind.plans.warehouse import order_headers
from tradewind.operators.dimensions import CITY_REGION, COUNTRY_CONTINENT, COUNTRY_REGION
from tradewind.plans import categories, customers, employees, sales, vat


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


def test_dimension_sizes():
    assert len(CITY_REGION) == 74 and len(set(CITY_REGION.values())) == 58
    assert len(COUNTRY_REGION) == 21
    assert COUNTRY_REGION.keys() <= COUNTRY_CONTINENT.keys()
    assert len(CITY_REGION) < lookups.MAX_BROADCAST_ROWS


def test_lookup_overwrites_mapped_and_keeps_the_rest(tables):
    df = tables(
        "ShipCity string, ShipRegion string, n int",
        ("Reims", "XX", 1),
        ("Reims", None, 2),
        ("Atlantis", "XX", 3),
        ("Atlantis", None, 4),
        (None, "XX", 5),
        (None, None, 6),
        ("reims", "XX", 7),
    )
    got = sales.map_region(df)
    assert got.columns == df.columns
    assert [tuple(r) for r in got.orderBy("n").collect()] == [
        ("Reims", "Grand Est", 1),
        ("Reims", "Grand Est", 2),
        ("Atlantis", "XX", 3),
        ("Atlantis", None, 4),
        (None, "XX", 5),
        (None, None, 6),
        ("reims", "XX", 7),
    ]


def test_a_large_mapping_is_not_hinted(spark, tables, monkeypatch):
    df = tables("k string", ("a",), ("b",))
    small = lookups.lookup(df, {"a": "1"}, "k", "v", F.lit("none"))
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(lookups, "MAX_BROADCAST_ROWS", 0)
    large = lookups.lookup(df, {"a": "1"}, "k", "v", F.lit("none"))
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert rows(small) == rows(large) == [("a", "1"), ("b", "none")]


def test_unmapped_values_leave_null_out(tables):
    df = tables("ShipCity string", ("Reims",), ("Atlantis",), ("Atlantis",), (None,))
    assert rows(lookups.unmapped_values(df, CITY_REGION, "ShipCity")) == [("Atlantis",)]


def test_country_corrections_differ_by_dataset(tables):
    names = tables("Country string", ("UK",), ("UKA",), ("Allemagne",), ("Germani#",), ("Poretugal#$",), (None,))
    assert rows(customers.correct_countries(names)) == sorted(
        [("United Kingdom",), ("UKA",), ("Allemagne",), ("Germany",), ("Portugal",), (None,)], key=repr
    )
    assert rows(employees.correct_countries(names)) == sorted(
        [("UK",), ("UK",), ("Allemagne",), ("Germani#",), ("Poretugal#$",), (None,)], key=repr
    )
    assert rows(vat.clean_vat(names)) == sorted(
        [("UK",), ("UKA",), ("Germany",), ("Germani#",), ("Poretugal#$",), (None,)], key=repr
    )


def test_region_and_continent(tables):
    df = tables("Country string, Region string", ("Mexico", "old"), ("Japan", "old"), (None, "old"), ("Nowhere", None))
    got = df.transform(segments.with_region).transform(segments.with_continent)
    assert rows(got) == sorted(
        [
            ("Mexico", "North America", "NA"),
            ("Japan", "Unknown", "AS"),
            (None, "Unknown", "Unknown"),
            ("Nowhere", "Unknown", "Unknown"),
        ],
        key=repr,
    )
    extended = segments.with_continent(df, {**COUNTRY_CONTINENT, "Nowhere": "AN"})
    assert rows(extended.where("Country = 'Nowhere'").select("CodeRegion")) == [("AN",)]


@pytest.mark.parametrize(
    ("revenue", "quantity", "tier"),
    [
        (10000.01, 501.0, "High Demand"),
        (10000.0, 501.0, "Medium Demand"),
        (10000.01, 500.0, "Medium Demand"),
        (2000.0, 0.0, "Medium Demand"),
        (0.0, 100.0, "Medium Demand"),
        (50000.0, 300.0, "Medium Demand"),
        (50000.0, 50.0, "Low Demand"),
        (1000.0, 600.0, "Low Demand"),
        (1999.99, 99.99, "Low Demand"),
        (None, None, "Low Demand"),
        (None, 200.0, "Medium Demand"),
    ],
)
def test_demand_tier_borders(tables, revenue, quantity, tier):
    df = tables("r double, q double", (revenue, quantity))
    assert rows(df.select(segments.demand_tier(F.col("r"), F.col("q")))) == [(tier,)]


def test_value_tier_borders(tables):
    df = tables("n double", (10000.01,), (10000.0,), (5000.0,), (4999.99,), (None,))
    got = [r[0] for r in df.select(segments.value_tier(F.col("n"))).collect()]
    assert got == ["VIP", "Moyen", "Moyen", "Low", "Low"]


def test_product_class_and_origin(tables):
    df = tables("c string", ("Beverages",), ("Dried Produce",), ("produce",), ("Tech",), ("Seafood",), (None,))
    got = [tuple(r) for r in df.select(segments.product_class(F.col("c")), segments.product_origin(F.col("c"))).collect()]
    assert got == [
        ("Drinks", "Plant"),
        ("Food", "Unknown"),
        ("autres", "Unknown"),
        ("Tech", "Unknown"),
        ("Food", "Animal"),
        ("autres", "Unknown"),
    ]


def test_a_category_listed_twice_repeats_its_products(tables):
    products = tables("ProductID int, CategoryID int", (1, 1), (2, 2), (3, None))
    listed = tables("CategoryID int, CategoryName string", (1, "Tech"), (1, "Seafood"), (None, "Tech"))
    got = segments.with_class(products, listed)
    assert rows(got) == sorted(
        [(1, 1, "Tech"), (1, 1, "Food"), (2, 2, "autres"), (3, None, "autres")], key=repr
    )


SALES = "ProductID int, CustomerID int, UnitPrice double, Quantity double, Discount double"


def test_totals_are_exact_and_do_not_depend_on_order(tables):
    data = [(1, 7, 0.1, 3.0, 0.05)] * 1000 + [(1, 7, 33333.3333, 2.0, 0.15), (2, 8, 5.0, 1.5, 0.0)]
    df = tables(SALES, *data)
    revenue = Decimal("0.1") * 3 * 1000 + Decimal("33333.3333") * 2
    net = Decimal("0.1") * 3 * 1000 * Decimal("0.95") + Decimal("33333.3333") * 2 * Decimal("0.85")
    for parts in (1, 7):
        shuffled = df.repartition(parts)
        assert rows(totals.product_totals(shuffled)) == [(1, float(revenue), 3002.0), (2, 7.5, 1.5)]
        assert rows(totals.customer_totals(shuffled)) == [(7, float(net)), (8, 7.5)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_round_no_factor_and_drop_no_amount(spark, tables, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = [
            (1, 1, 0.00004, 1e6, 0.0), (2, 2, 1e5, 1.0, 0.333333), (3, 3, 1e8, 1.0, 0.0), (4, 4, 10.0, 1.0, 15.0),
            (5, 5, 9999.99996, 1.0, 0.0), (5, 5, 40.0, 1.0, 0.0), (6, 6, 1.0, 0.004, 0.0),
        ]
        sold = tables(SALES, *lines)
        revenue = {r.ProductID: r.total_revenue for r in totals.product_totals(sold).collect()}
        assert [revenue[i] for i in (1, 3, 6)] == [40.0, 1e8, 0.004]
        net = {r.CustomerID: r.total_commande_client for r in totals.customer_totals(sold).collect()}
        assert net[2] == pytest.approx(66666.7) and net[4] == -140.0 and net[5] == 10039.99996
        people = tables("CustomerID int", *[(i,) for i in range(1, 7)])
        tier = {r.CustomerID: r.StatutClient for r in segments.with_value_tier(people, sold).collect()}
        assert tier[5] == "VIP" and tier[3] == "VIP" and tier[1] == "Low"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_order_nodes_and_unmerged_headers(tables):
    lines = tables("OrderID int, EmployeeID int, CustomerID int, ShipName string", (1, 1, 1, "b"), (1, 1, 1, "a"), (2, 1, 1, "c"), (2, 1, 1, "c"))
    assert rows(quality.duplicate_keys(order_headers(lines), "OrderID")) == [(1, 2)]
    nodes = graph.order_nodes(lines)
    assert rows(nodes) == [(1, "a"), (2, "c")] and rows(quality.duplicate_keys(nodes, "orderID")) == []


def test_line_amounts(tables):
    df = tables(SALES, (1, 1, 10.0, 3.0, 0.1))
    assert rows(totals.line_net_total(totals.line_revenue(df)).select("total_sales_per_product", "total_commande")) == [
        (30.0, 27.0)
    ]


def test_tiers_keep_rows_and_columns(tables):
    products = tables("ProductID int, Description string", (1, "a"), (2, "b"), (3, None))
    sold = tables(SALES, (1, 1, 100.0, 150.0, 0.0), (1, 1, 100.0, 400.0, 0.0), (9, 2, 1.0, 1.0, 0.0))
    assert rows(segments.with_demand_tier(products, sold)) == sorted(
        [(1, "a", "High Demand"), (2, "b", "Low Demand"), (3, None, "Low Demand")], key=repr
    )
    people = tables("CustomerID int", (1,), (2,), (3,))
    assert rows(segments.with_value_tier(people, sold)) == [(1, "VIP"), (2, "Low"), (3, "Low")]


def test_null_audit_has_a_row_per_column(tables):
    df = tables("a int, `b.c` string", (1, None), (None, None), (3, "x"))
    assert rows(quality.null_audit(df, "t")) == [("t", "a", 1, 3, "WARNING"), ("t", "b.c", 2, 3, "WARNING")]
    assert rows(quality.null_audit(df.where("a = 3"), "t")) == [("t", "a", 0, 1, "INFO"), ("t", "b.c", 0, 1, "INFO")]
    assert rows(quality.null_audit(df.where("a = 9"), "t")) == [("t", "a", 0, 0, "INFO"), ("t", "b.c", 0, 0, "INFO")]


def test_null_percentages_of_some_and_no_rows(tables):
    df = tables("a int, b string", (1, None), (None, None), (3, "x"), (4, "y"))
    assert rows(quality.null_percentages(df)) == [(25.0, 50.0)]
    assert rows(quality.null_percentages(df.where("a = 9"))) == [(None, None)]


def test_duplicate_keys(tables):
    df = tables("a int, b int", (1, 1), (1, 1), (1, 2), (None, 1), (None, 1))
    assert rows(quality.duplicate_keys(df, "a", "b")) == sorted([(1, 1, 2), (None, 1, 2)], key=repr)
    assert rows(quality.duplicate_keys(df.distinct(), "a", "b")) == []


def test_row_counts_and_count_where(tables):
    df = tables("a int", (1,), (None,), (3,))
    assert rows(quality.row_counts({"all": df, "none": df.where("false")})) == [("all", 3), ("none", 0)]
    assert rows(quality.count_where(df, F.col("a") > 1)) == [(1,)]


def test_quality_report(tables):
    df = tables("a int", (1,), (None,), (-3,))
    rules = [
        quality.Rule("a is missing", F.col("a").isNull(), "kept"),
        quality.Rule("a is negative", F.col("a") < 0, "absolute value"),
    ]
    assert rows(quality.quality_report(df, "t", rules)) == [
        ("t", "a is missing", 1, "kept"),
        ("t", "a is negative", 1, "absolute value"),
    ]


def test_price_mismatches(tables):
    sold = tables("OrderID int, ProductID int, UnitPrice double", (1, 1, 5.0), (2, 2, 5.0), (3, 3, None), (4, 9, 5.0))
    listed = tables("ProductID int, UnitPrice string", (1, "5"), (2, "6"), (3, "7"))
    assert rows(reconcile.price_mismatches(sold, listed).select("OrderID")) == [(2,)]
    assert rows(reconcile.price_mismatches(sold, listed, null_safe=True).select("OrderID")) == [(2,), (3,), (4,)]


def test_category_cross_fill(tables):
    df = tables(
        "CategoryID int, CategoryName string, Description string, Picture string",
        (1, None, "Produce, dried", "0x"),
        (2, "Condiments#", None, "0x"),
        (3, "", ", leading", "0x"),
        (4, None, None, "0x"),
        (5, "###", "", "0x"),
    )
    got = [tuple(r) for r in categories.clean_categories(df).orderBy("CategoryID").collect()]
    assert got == [
        (1, "Produce", "Produce, dried"),
        (2, "Condiments", "Condiments"),
        (3, "", ", leading"),
        (4, None, None),
        (5, "", ""),
    ]


def test_fill_unknown(tables):
    schema = "CompanyName string, City string, PostalCode string, Fax string, Phone string"
    df = tables(schema, (None, None, None, "n.a.", None), (None, "X", "01", None, "(1)"))
    got = df.transform(customers.clean_phones).transform(customers.fill_unknown)
    assert rows(got) == sorted(
        [("Unknown", "Unknown", "Unknown", "", None), ("Unknown", "X", "01", "Unknown", "1")], key=repr
    )


def test_filling_text_into_a_number_column_raises(tables):
    df = tables("CompanyName string, City string, PostalCode int, Fax string", ("a", "b", None, "c"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        customers.fill_unknown(df).collect()


def test_shipped_date_uses_the_rebased_order_date(tables):
    df = tables(
        "n int, OrderDate string, RequiredDate string, ShippedDate string",
        (1, "7/4/95", "8/1/95", None),
        (2, "7/4/99", "8/1/99", None),
        (3, "2/29/96", None, None),
        (4, "7/4/95", None, "7/6/99"),
    )
    got = df.transform(sales.rebase_dates).transform(sales.fill_shipped_date)
    assert dict(got.dtypes)["ShippedDate"] == "string"
    assert [tuple(r)[1:] for r in got.orderBy("n").collect()] == [
        ("2021-07-04", "2021-08-01", "2021-07-11"),
        ("07-04", "08-01", None),
        ("2022-02-29", None, None),
        ("2021-07-04", None, "07-06"),
    ]


def test_the_calendar_agrees_with_parsing(spark, tables):
    from tradewind.functions import parse_date, rebase_year
    from tradewind.operators import calendar

    texts = ["7/4/96", "07/04/96", "007/4/96", "7/04/1996", "2/29/96", "2/29/97", "2/30/96", "12/31/99", "1/1/00", "", None]
    df = tables("n int, d string, e string", *[(i, t, t) for i, t in enumerate(texts)])
    for unmapped in ("drop", "keep"):
        direct = rebase_year(parse_date("d", "M/d/yy"), unmapped=unmapped)
        expected = [r[0] for r in df.orderBy("n").select(direct).collect()]
        got = calendar.rebase_dates(df, "d", "e", unmapped=unmapped).orderBy("n").collect()
        assert [r.d for r in got] == [r.e for r in got] == expected
    assert calendar.calendar(spark, {}, "drop").select("_calendar_text").distinct().count() == calendar.DAYS
