"""The warehouse as a property graph: one table per node label, one per edge type.

Nodes are one per row, orders one per id. An edge exists once per pair whose two ends exist as nodes. Edges are
deduplicated first, combining before the shuffle, and only then matched with their ends by a semi join. So a
product or employee that is in a large share of all order lines reaches the join with its distinct pairs only, and
repeated ids among the nodes cannot multiply edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import to_double


def customer_nodes(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("CompanyName").alias("companyName"),
        F.col("CustomerID").alias("customerID"),
        F.col("Fax").alias("fax"),
        F.col("Phone").alias("phone"),
    )


def product_nodes(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("ProductName").alias("productName"),
        F.col("ProductID").alias("productID"),
        to_double("UnitPrice").alias("unitPrice"),
    )


def supplier_nodes(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(
        F.col("CompanyName").alias("companyName"), F.col("SupplierID").alias("supplierID")
    )


def employee_nodes(employees: DataFrame) -> DataFrame:
    return employees.select(
        F.col("EmployeeID").alias("employeeID"),
        F.col("FirstName").alias("firstName"),
        F.col("LastName").alias("lastName"),
        F.col("Title").alias("title"),
    )


def category_nodes(categories: DataFrame) -> DataFrame:
    return categories.select(
        F.col("CategoryID").alias("categoryID"),
        F.col("CategoryName").alias("categoryName"),
        F.col("Description").alias("description"),
    )


def order_nodes(order_lines: DataFrame) -> DataFrame:
    """One node per order id. Of several ship names the least is kept, as rows have no order on a cluster.

    Spark sorts for the minimum of a text; so the distinct names of an order, often one, are hashed together first.
    """
    named = order_lines.where(F.col("OrderID").isNotNull()).select(F.col("OrderID").alias("orderID"), "ShipName")
    return named.distinct().groupBy("orderID").agg(F.min("ShipName").alias("shipName"))


def _pairs(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Distinct pairs of two columns, without NULL ends."""
    pairs = df.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    return pairs.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct()


def _with_end(edges: DataFrame, end: str, nodes: DataFrame, node_id: str) -> DataFrame:
    """Edges whose ``end`` is the id of a node."""
    return edges.join(nodes.select(F.col(node_id).alias(end)), end, "left_semi").select(*edges.columns)


def order_product_edges(order_lines: DataFrame, products: DataFrame) -> DataFrame:
    """Order contains product. Of several lines for a pair, the least price and then quantity is kept, NULL last."""
    price, quantity = to_double("UnitPrice"), to_double("Quantity")
    lines = order_lines.select(
        F.col("OrderID").alias("src"),
        F.col("ProductID").alias("dst"),
        F.struct(
            price.isNull().alias("no_price"),
            price.alias("unitPrice"),
            quantity.isNull().alias("no_quantity"),
            quantity.alias("quantity"),
        ).alias("line"),
    ).where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    edges = (
        lines.groupBy("src", "dst")
        .agg(F.min("line").alias("line"))
        .select("src", "dst", "line.unitPrice", "line.quantity")
    )
    return _with_end(edges, "dst", products, "ProductID")


def sold_edges(order_lines: DataFrame, employees: DataFrame) -> DataFrame:
    """Employee sold order."""
    return _with_end(_pairs(order_lines, "EmployeeID", "OrderID"), "src", employees, "EmployeeID")


def purchased_edges(order_lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer purchased order."""
    return _with_end(_pairs(order_lines, "CustomerID", "OrderID"), "src", customers, "CustomerID")


def supplies_edges(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Supplier supplies product."""
    return _with_end(_pairs(products, "SupplierID", "ProductID"), "src", suppliers, "SupplierID")


def part_of_edges(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Product is part of category."""
    return _with_end(_pairs(products, "ProductID", "CategoryID"), "dst", categories, "CategoryID")


def reports_to_edges(employees: DataFrame) -> DataFrame:
    """Employee reports to employee. Who has no manager, or one who is not listed, gives no edge."""
    return _with_end(_pairs(employees, "EmployeeID", "ReportsTo"), "dst", employees, "EmployeeID")
