"""Raw warehouse datasets derived from the test tables, with dirt injected by key arithmetic.

The test tables are clean, while the operators are about dirt. ``validation/oracle.py`` has the same definitions as
SQL. Every dataset reads a whole table, so that it grows with the data; dirty values depend on keys only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _pad(c: Column, width: int) -> Column:
    return F.lpad(_text(c), width, "0")


def _by_remainder(key: Column, divisor: int, values: dict[int, str | None], other: str | None = None) -> Column:
    rest = key % divisor
    return reduce(
        lambda case, item: case.when(rest == item[0], F.lit(item[1])),
        values.items(),
        F.when(F.lit(False), F.lit(None).cast("string")),
    ).otherwise(F.lit(other))


def _signed(value: Column, missing: Column, negative: Column) -> Column:
    return F.when(missing, None).when(negative, -value).otherwise(value)


def raw_sales(spark: SparkSession, sf_dir: str, task_rows: int | None = None) -> DataFrame:
    """Order header joined to order line, as the sales file has it: one row per line, order id twice.

    ``task_rows`` deals the lines out by order, about so many to a task whatever their number. Else adaptive execution
    merges them to as many tasks as there are cores, and what groups them by order behind the join holds all of a task.
    """
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    if task_rows:
        n = 1 + lines.count() // task_rows
        lines, orders = lines.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey")
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    line, part, number = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    ordered = F.col("o_orderdate").cast("date")
    shipped = F.col("l_shipdate").cast("date")
    price = (part % 20 + 1).cast("double")
    return lines.join(orders, line == order).select(
        order.alias("OrderID0"),
        customer.alias("CustomerID"),
        F.col("l_suppkey").alias("EmployeeID"),
        F.date_format(ordered, "M/d/yy").alias("OrderDate"),
        F.date_format(F.date_add(ordered, 28), "M/d/yy").alias("RequiredDate"),
        F.when((line + number) % 11 != 0, F.date_format(shipped, "M/d/yy")).alias("ShippedDate"),
        (order % 3 + 1).alias("ShipVia"),
        F.col("o_totalprice").alias("Freight"),
        F.concat(F.lit("Ship "), _text(customer), F.lit("-"), _text(number)).alias("ShipName"),
        F.concat(F.lit("Street "), _text(customer)).alias("ShipAddress"),
        _by_remainder(
            order, 6, {0: "Reims", 1: "Rio de Janeiro", 2: "London", 3: "Atlantis", 4: "Seattle"}
        ).alias("ShipCity"),
        F.when(order % 5 == 0, "XX").alias("ShipRegion"),
        _pad(customer, 6).alias("ShipPostalCode"),
        _by_remainder(order, 3, {0: "France", 1: "USA"}, "Brazil").alias("ShipCountry"),
        order.alias("OrderID14"),
        part.alias("ProductID"),
        _signed(price, (line + part) % 13 == 0, (line + part) % 17 == 0).alias("UnitPrice"),
        _signed(F.col("l_quantity"), (line + number) % 19 == 0, (line + number) % 23 == 0).alias("Quantity"),
        _signed(F.col("l_discount"), (line + part) % 7 == 0, (line + part) % 5 == 0).alias("Discount"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), _text(F.col("p_size"))
    return _table(spark, sf_dir, "part").select(
        key.alias("ProductID"),
        F.when(key % 10 != 0, F.col("p_name")).alias("ProductName"),
        (key % 10).alias("SupplierID"),
        (key % 11).alias("CategoryID"),
        F.when(key % 4 == 0, F.concat(size, F.lit(" - 12 oz bottles")))
        .when(key % 4 == 1, F.concat(size, F.lit(" boxes x 20 bags")))
        .when(key % 4 == 2, F.concat(size, F.lit("kg pkg.")))
        .alias("QuantityPerUnit"),
        F.when(key % 12 == 0, "1k")
        .when(key % 16 == 1, "1.5k")
        .when(key % 9 == 0, F.concat(F.lit("-"), size, F.lit(".5")))
        .when(key % 25 == 0, "n/a")
        .otherwise(size)
        .alias("UnitPrice"),
        F.when(key % 15 == 0, "none").otherwise(F.concat(size, F.lit(" units"))).alias("UnitsInStock"),
        F.when(key % 14 != 0, F.concat(F.lit("-"), _text(F.col("p_size") % 7))).alias("UnitsOnOrder"),
    )


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category per supplier. Products use ids 0-10, of which 0 and 10 have no category."""
    key = F.col("s_suppkey")
    names = {
        1: "Beverages", 2: "Condiments#", 3: "Confections", 4: "", 5: "Grains/Cereals", 6: "Meat/Poultry", 7: None,
        8: "Seafood",
    }
    descriptions = {
        1: "Soft drinks, coffees & teas", 2: None, 3: "", 4: "Cheeses and more", 5: "Breads, crackers",
        6: "Prepared meats", 7: "Produce, dried fruit", 8: "Seaweed (and fish)",
    }
    return _table(spark, sf_dir, "supplier").select(
        F.when((key % 11).isin(0, 10), key + 1000000).otherwise(key).alias("CategoryID"),
        _by_remainder(key, 11, names, "Tech").alias("CategoryName"),
        _by_remainder(key, 11, descriptions, "Tools").alias("Description"),
        F.lit("0x").alias("Picture"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), _text(F.col("c_nationkey"))
    countries = {
        0: "Germani#", 1: "Poretugal#$", 2: "UK", 3: "France", 4: "USA", 5: "Brazil", 6: "Japan", 7: None,
        8: "Mexico",
    }
    return _table(spark, sf_dir, "customer").select(
        key.alias("CustomerID"),
        F.when(key % 9 != 0, F.col("c_name")).alias("CompanyName"),
        F.when(key % 8 != 0, F.concat(F.lit("City "), nation)).alias("City"),
        F.when(key % 7 != 0, _pad(key, 6)).alias("PostalCode"),
        F.lit(None).cast("string").alias("Region"),
        _by_remainder(key, 10, countries, "Norway").alias("Country"),
        F.when(key % 6 != 0, F.concat(F.lit("(0"), nation, F.lit(") 555-"), _text(key))).alias("Phone"),
        F.when(key % 5 == 0, None)
        .when(key % 5 == 1, "n.a.")
        .otherwise(F.concat(F.lit("+1."), _text(key)))
        .alias("Fax"),
    )


def raw_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    days = key.cast("int")
    born = F.date_add(F.lit("1948-12-08").cast("date"), days)
    hired = F.date_add(F.lit("1992-04-01").cast("date"), days)
    return _table(spark, sf_dir, "supplier").select(
        key.alias("EmployeeID"),
        F.concat(F.col("s_name"), F.when(key % 3 == 0, " Müller").otherwise("")).alias("LastName"),
        F.concat(F.lit("Jo@n-"), _text(key), F.lit(" O'Neil")).alias("FirstName"),
        F.when(key % 4 != 0, "Rep").alias("Title"),
        F.when(key % 3 != 0, "WA").alias("Region"),
        F.when(key % 2 == 0, "UKA").otherwise("USA").alias("Country"),
        F.concat(F.lit("(206) 555-"), _text(key)).alias("HomePhone"),
        F.when(key % 5 == 0, "1/2/63").otherwise(F.date_format(born, "MM/dd/yy")).alias("BirthDate"),
        F.date_format(hired, "MM/dd/yy").alias("HireDate"),
        F.lit("0x").alias("Photo"),
        F.when(key != 0, F.floor((key - 1) / 3).cast("bigint")).alias("ReportsTo"),
    )


def raw_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("SupplierID"), F.col("s_name").alias("CompanyName")
    )


def raw_tva(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One VAT entry per customer."""
    key = F.col("c_custkey")
    return _table(spark, sf_dir, "customer").select(
        key.alias("CountryID"),
        _by_remainder(key, 4, {0: "Allemagne", 1: "France", 2: "Italy"}).alias("Country"),
        (key % 3 + 18).cast("double").alias("Rate"),
    )


RAW_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_sales": raw_sales,
    "raw_products": raw_products,
    "raw_categories": raw_categories,
    "raw_customers": raw_customers,
    "raw_employees": raw_employees,
    "raw_suppliers": raw_suppliers,
    "raw_tva": raw_tva,
}
