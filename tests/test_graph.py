"""Graph tables: one node per row, one edge per pair, no edge without both ends."""

from __future__ import annotations

import pytest

from tradewind.plans import graph
from validation import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lines(spark):
    data = [
        (1, 10, 100, 7, "b", 5.0, 2.0),
        (1, 10, 100, 7, "a", None, 1.0),
        (1, 10, 100, 7, "c", 5.0, None),
        (1, 11, 100, 7, "c", None, 4.0),
        (1, 11, 100, 7, "c", None, 3.0),
        (2, 99, 999, None, None, 1.0, 1.0),
        (None, 10, 100, 7, "d", 1.0, 1.0),
    ]
    schema = (
        "OrderID int, ProductID int, EmployeeID int, CustomerID int, ShipName string, UnitPrice double, "
        "Quantity double"
    )
    return spark.createDataFrame(data, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_order_nodes(lines):
    assert rows(graph.order_nodes(lines)) == [(1, "a"), (2, None)]


def test_order_product_edges_take_the_least_line(spark, lines):
    # Product 10 is listed twice: still one edge. Product 99 is not listed: no edge.
    products = spark.createDataFrame([(10,), (10,), (11,)], "ProductID int")
    assert rows(graph.order_product_edges(lines, products)) == [(1, 10, 5.0, 2.0), (1, 11, None, 3.0)]


def test_edges_need_both_ends(spark, lines):
    people = spark.createDataFrame([(100, None), (101, 100), (102, 55), (103, 101), (103, 101)], "EmployeeID int, ReportsTo int")
    assert rows(graph.sold_edges(lines, people)) == [(100, 1)]
    assert rows(graph.reports_to_edges(people)) == [(101, 100), (103, 101)]
    clients = spark.createDataFrame([(7,), (8,)], "CustomerID int")
    assert rows(graph.purchased_edges(lines, clients)) == [(7, 1)]


def test_nodes_are_not_deduplicated(spark):
    clients = spark.createDataFrame([(7, "a", None, "1")] * 2, "CustomerID int, CompanyName string, Fax string, Phone string")
    assert graph.customer_nodes(clients).count() == 2


@pytest.mark.parametrize(
    ("edges", "src", "dst"),
    [
        ("graph_edges_order_product", ("graph_nodes_order", "orderID"), ("graph_nodes_product", "productID")),
        ("graph_edges_sold", ("graph_nodes_employee", "employeeID"), ("graph_nodes_order", "orderID")),
        ("graph_edges_purchased", ("graph_nodes_customer", "customerID"), ("graph_nodes_order", "orderID")),
        ("graph_edges_supplies", ("graph_nodes_supplier", "supplierID"), ("graph_nodes_product", "productID")),
        ("graph_edges_part_of", ("graph_nodes_product", "productID"), ("graph_nodes_category", "categoryID")),
        ("graph_edges_reports_to", ("graph_nodes_employee", "employeeID"), ("graph_nodes_employee", "employeeID")),
    ],
)
def test_edge_ends_are_nodes(spark, edges, src, dst):
    found = queries.QUERIES[edges](spark, SF_DIR)
    for end, (nodes, node_id) in (("src", src), ("dst", dst)):
        ids = queries.QUERIES[nodes](spark, SF_DIR)
        assert found.join(ids, found[end] == ids[node_id], "left_anti").count() == 0
    assert found.groupBy("src", "dst").count().where("count > 1").count() == 0
