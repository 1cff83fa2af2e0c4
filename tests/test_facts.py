"""Known counts at sf0.01, worked out from the dataset definitions before the queries existed."""

from __future__ import annotations

from collections import Counter

import pytest

from validation.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: QUERIES[name](spark, SF_DIR)


def counts(df, column):
    return Counter(r[column] for r in df.select(column).collect())


def test_tiers(run):
    assert counts(run("product_demand_tier"), "StatutProduit") == {
        "High Demand": 502,
        "Medium Demand": 1256,
        "Low Demand": 242,
    }
    assert counts(run("customer_value_tier"), "StatutClient") == {"VIP": 530, "Moyen": 777, "Low": 193}


def test_classes(run):
    classes = {"Food": 1274, "Drinks": 182, "Tech": 181, "autres": 363}
    assert counts(run("product_class"), "ClassProduct") == classes


def test_missing_values(run):
    audit = {r.column_name: r.null_count for r in run("null_audit_sales").collect() if r.null_count}
    expected = {"ShippedDate": 5421, "UnitPrice": 4683, "Quantity": 3167, "Discount": 8607}
    assert {c: audit[c] for c in expected} == expected


def test_regions(run):
    kept = run("ship_region").where("ShipRegion = 'XX'")
    assert counts(kept, "ShipCity") == {"Atlantis": 2014, None: 1990}
    assert run("unmapped_region_count").collect()[0].n == 7858 + 7977
    assert [r.ShipCity for r in run("missing_cities").collect()] == ["Atlantis"]


def test_graph_sizes(run):
    sizes = {
        "graph_nodes_order": 14743,
        "graph_edges_order_product": 59945,
        "graph_edges_reports_to": 99,
        "graph_edges_purchased": 14743,
        "graph_edges_sold": 58785,
        "graph_edges_supplies": 2000,
        "graph_edges_part_of": 1637,
        "duplicate_keys": 55,
    }
    assert {name: run(name).count() for name in sizes} == sizes
