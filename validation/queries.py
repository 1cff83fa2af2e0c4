"""One query per operator, on the raw datasets."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.dates import format_as_text
from tradewind.operators import quality, reconcile, segments, totals
from tradewind.operators.dimensions import CITY_REGION
from tradewind.operators.lookup import unmapped_values
from tradewind.plans import categories, customers, employees, graph, products, sales, vat
from tradewind.plans.warehouse import AUDITS, GRAPH, SILVER, audit, build_graph, build_silver, order_headers, sync_prices
from tradewind.sources import files
from tradewind.sources.datasets import DATASETS, SILVER_TYPES
from tradewind.sources.files import land, read_csv, read_table, write_csv, write_table
from tradewind.sources.scratch import scratch_path
from validation.raw_tables import (
    RAW_TABLES,
    raw_categories,
    raw_customers,
    raw_employees,
    raw_products,
    raw_sales,
    raw_suppliers,
    raw_tva,
)

Query = Callable[[SparkSession, str], DataFrame]

LINE = ("OrderID", "ProductID")
TASK_ROWS = 1 << 17


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sales(spark, sf_dir).transform(sales.keep_one_order_id)


def _lines_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines for what groups them by order, dealt out so that a task's memory does not grow with the table."""
    return raw_sales(spark, sf_dir, task_rows=TASK_ROWS).transform(sales.keep_one_order_id)


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sales(spark, sf_dir).transform(sales.sales_measures)


def _silver_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_categories(spark, sf_dir).transform(categories.clean_categories)


# Sources and sinks


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "products-csv")
    write_csv(raw_products(spark, sf_dir), path)
    return read_csv(spark, path, DATASETS["products"].types)


def bronze_roundtrip(spark, sf_dir):
    lake = scratch_path(spark, "lake")
    write_table(raw_sales(spark, sf_dir), lake, "bronze", "sales")
    return read_table(spark, lake, "bronze", "sales")


def warehouse_run(spark, sf_dir):
    """CSV files to bronze to silver, all written, then the NULLs in every silver column."""
    raw, lake = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    for dataset in DATASETS.values():
        write_csv(RAW_TABLES[f"raw_{dataset.name}"](spark, sf_dir), f"{raw}/{dataset.csv_file}")
    land(spark, raw, lake)
    build_silver(spark, lake)
    audits = [quality.null_audit(read_table(spark, lake, "silver", name), name) for name in SILVER_TYPES]
    return reduce(DataFrame.unionAll, audits)


def csv_strings(spark, sf_dir):
    """Every column as text, as a file without declared types is read."""
    path = scratch_path(spark, "products-csv")
    write_csv(raw_products(spark, sf_dir), path)
    return read_csv(spark, path)


def csv_inferred(spark, sf_dir):
    """Types guessed by Spark."""
    path = scratch_path(spark, "products-csv")
    write_csv(raw_products(spark, sf_dir), path)
    return read_csv(spark, path, infer=True)


def landed_sales(spark, sf_dir):
    """Bronze sales after landing their CSV file, all values."""
    raw, lake = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    write_csv(raw_sales(spark, sf_dir), f"{raw}/{DATASETS['sales'].csv_file}")
    land(spark, raw, lake, {"sales": DATASETS["sales"]})
    return read_table(spark, lake, "bronze", "sales")


def _broken_products(spark, sf_dir):
    """A folder with a products file of which some lines lost their last values and some have one too many."""
    raw = scratch_path(spark, "raw")
    products = raw_products(spark, sf_dir)
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in products.columns]
    whole = F.concat_ws(",", *values)
    short, wide = F.concat_ws(",", *values[:3]), F.concat_ws(",", *values, F.lit("surplus"))
    key = F.col("ProductID")
    line = F.when(key % 7 == 3, short).when(key % 7 == 5, wide).otherwise(whole)
    lines = products.select(line.alias("value"))
    # Whole lines under the whole header, which every file of the folder has: no comma separates anything here.
    path = f"{raw}/{DATASETS['products'].csv_file}"
    lines.withColumnRenamed("value", ",".join(products.columns)).write.csv(path, header=True, sep="\u0001", quote="\u0000")
    return raw


def landing_audit(spark, sf_dir):
    """Rows of a raw file, and how many of its lines have too few or too many values."""
    return files.landing_audit(spark, _broken_products(spark, sf_dir), {"products": DATASETS["products"]})


def malformed_lines(spark, sf_dir):
    """Those lines."""
    raw = _broken_products(spark, sf_dir)
    return files.malformed_lines(spark, f"{raw}/{DATASETS['products'].csv_file}")


def _bronze(spark, sf_dir, *datasets):
    """A lake with these bronze tables."""
    lake = scratch_path(spark, "lake")
    for dataset in datasets:
        write_table(RAW_TABLES[f"raw_{dataset}"](spark, sf_dir), lake, "bronze", dataset)
    return lake


_SILVER_NEEDS = {"products": ("sales", "categories"), "customers": ("sales",)}


def _lake_silver(table):
    def query(spark, sf_dir):
        tables = (*_SILVER_NEEDS.get(table, ()), table)
        lake = _bronze(spark, sf_dir, *("tva" if t == "vat" else t for t in tables))
        build_silver(spark, lake, tables)
        return read_table(spark, lake, "silver", table)

    query.__name__ = f"lake_silver_{table}"
    query.__doc__ = f"Silver {table} as read back from the lake."
    return query


def _lake_graph(table):
    def query(spark, sf_dir):
        lake = _bronze(spark, sf_dir, *DATASETS)
        build_graph(spark, lake, (table,))
        return read_table(spark, lake, "graph", table)

    query.__name__ = f"lake_graph_{table}"
    query.__doc__ = f"Graph table {table} as read back from the lake."
    return query


def lake_price_sync(spark, sf_dir):
    lake = _bronze(spark, sf_dir, "sales", "products")
    sync_prices(spark, lake)
    return read_table(spark, lake, "silver", "price_sync")


def lake_audits(spark, sf_dir):
    """The audit tables of a silver run with audits, read back: nulls, rows, repeated keys and rules as one table."""
    lake = _bronze(spark, sf_dir, *DATASETS)
    build_silver(spark, lake)
    audit(spark, lake)
    found = {name: read_table(spark, lake, "audit", name) for name in AUDITS}
    no_count, no_note = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    return (
        found["null_audit"]
        .select(F.lit("null_audit").alias("audit"), "table_name", F.col("column_name").alias("item"),
                F.col("null_count").alias("n"), "row_count", F.col("level").alias("note"))
        .unionAll(found["row_counts"].select(F.lit("row_counts"), "table_name", F.lit("rows"), "n", no_count, no_note))
        .unionAll(found["duplicate_keys"].select(F.lit("duplicate_keys"), "table_name", "key", "n", no_count, no_note))
        .unionAll(found["quality_report"].select(F.lit("quality_report"), "dataset", "rule", "affected_rows", no_count, "action"))
    )


def graph_run(spark, sf_dir):
    """Bronze to graph and price-synced sales, all written, then the rows of every table."""
    lake = _bronze(spark, sf_dir, *DATASETS)
    build_graph(spark, lake)
    sync_prices(spark, lake)
    tables = {name: read_table(spark, lake, "graph", name) for name in GRAPH}
    tables["price_sync"] = read_table(spark, lake, "silver", "price_sync")
    return quality.row_counts(tables)


# Sales


def sales_dedup_header(spark, sf_dir):
    return _order_lines(spark, sf_dir)


def sales_numeric_cast(spark, sf_dir):
    return _order_lines(spark, sf_dir).transform(sales.cast_numbers).select(*LINE, "Freight", *sales.MEASURES)


def rebase_years(spark, sf_dir):
    return _order_lines(spark, sf_dir).transform(sales.rebase_dates).select(*LINE, *sales.DATES)


def shipped_date_fill(spark, sf_dir):
    return (
        _order_lines(spark, sf_dir)
        .transform(sales.rebase_dates)
        .transform(sales.fill_shipped_date)
        .select(*LINE, "OrderDate", "ShippedDate")
    )


def sales_repair_numbers(spark, sf_dir):
    return _repaired(spark, sf_dir).select(*LINE, *sales.MEASURES)


def ship_region(spark, sf_dir):
    return _order_lines(spark, sf_dir).transform(sales.map_region).select(*LINE, "ShipCity", "ShipRegion")


def unmapped_region_count(spark, sf_dir):
    mapped = _order_lines(spark, sf_dir).transform(sales.map_region)
    return quality.count_where(mapped, F.col("ShipRegion").isNull())


def missing_cities(spark, sf_dir):
    return unmapped_values(raw_sales(spark, sf_dir), CITY_REGION, "ShipCity")


def silver_sales(spark, sf_dir):
    return raw_sales(spark, sf_dir).transform(sales.clean_sales)


def line_revenue(spark, sf_dir):
    return _repaired(spark, sf_dir).transform(totals.line_revenue).select(*LINE, "total_sales_per_product")


def line_net_total(spark, sf_dir):
    return _repaired(spark, sf_dir).transform(totals.line_net_total).select(*LINE, "total_commande")


def product_sales_totals(spark, sf_dir):
    return _repaired(spark, sf_dir).transform(totals.product_totals)


def customer_totals(spark, sf_dir):
    return _repaired(spark, sf_dir).transform(totals.customer_totals)


# Categories and products


def category_clean(spark, sf_dir):
    return raw_categories(spark, sf_dir).transform(categories.strip_symbols).drop("Picture")


def category_crossfill(spark, sf_dir):
    cleaned = raw_categories(spark, sf_dir).transform(categories.strip_symbols)
    return cleaned.transform(categories.cross_fill).drop("Picture")


def silver_categories(spark, sf_dir):
    return _silver_categories(spark, sf_dir)


def product_stock_clean(spark, sf_dir):
    repaired = raw_products(spark, sf_dir).transform(products.repair_stock)
    return repaired.select("ProductID", "UnitsInStock", "UnitsOnOrder")


def product_price_clean(spark, sf_dir):
    return raw_products(spark, sf_dir).transform(products.repair_price).select("ProductID", "UnitPrice")


def quantity_per_unit(spark, sf_dir):
    parsed = raw_products(spark, sf_dir).transform(products.parse_package)
    return parsed.select("ProductID", "Quantity", "Description")


def product_demand_tier(spark, sf_dir):
    graded = segments.with_demand_tier(raw_products(spark, sf_dir), _repaired(spark, sf_dir))
    return graded.select("ProductID", "StatutProduit")


def product_class(spark, sf_dir):
    graded = segments.with_class(raw_products(spark, sf_dir), _silver_categories(spark, sf_dir))
    return graded.select("ProductID", "CategoryID", "ClassProduct")


def product_origin(spark, sf_dir):
    graded = segments.with_origin(raw_products(spark, sf_dir), _silver_categories(spark, sf_dir))
    return graded.select("ProductID", "OriginProduct")


def silver_products(spark, sf_dir):
    return products.clean_products(
        raw_products(spark, sf_dir), silver_sales(spark, sf_dir), _silver_categories(spark, sf_dir)
    )


# Customers, employees, VAT


def phone_digits(spark, sf_dir):
    cleaned = raw_customers(spark, sf_dir).transform(customers.clean_phones)
    return cleaned.select("CustomerID", "Phone", "Fax")


def fill_unknown(spark, sf_dir):
    cleaned = raw_customers(spark, sf_dir).transform(customers.clean_phones)
    return cleaned.transform(customers.fill_unknown).select("CustomerID", *customers.FILLED)


def country_corrections(spark, sf_dir):
    return raw_customers(spark, sf_dir).transform(customers.correct_countries).select("CustomerID", "Country")


def customer_region(spark, sf_dir):
    corrected = raw_customers(spark, sf_dir).transform(customers.correct_countries)
    return corrected.transform(segments.with_region).select("CustomerID", "Country", "Region")


def customer_continent(spark, sf_dir):
    corrected = raw_customers(spark, sf_dir).transform(customers.correct_countries)
    return corrected.transform(segments.with_continent).select("CustomerID", "Country", "CodeRegion")


def unknown_region_count(spark, sf_dir):
    placed = raw_customers(spark, sf_dir).transform(customers.correct_countries).transform(segments.with_region)
    return quality.count_where(placed, F.col("Region") == "Unknown")


def customer_value_tier(spark, sf_dir):
    graded = segments.with_value_tier(raw_customers(spark, sf_dir), _repaired(spark, sf_dir))
    return graded.select("CustomerID", "StatutClient")


def silver_customers(spark, sf_dir):
    return customers.clean_customers(raw_customers(spark, sf_dir), silver_sales(spark, sf_dir))


def employee_name_clean(spark, sf_dir):
    cleaned = raw_employees(spark, sf_dir).transform(employees.clean_names)
    return cleaned.select("EmployeeID", "LastName", "FirstName", "HomePhone")


def employee_country(spark, sf_dir):
    return raw_employees(spark, sf_dir).transform(employees.correct_countries).select("EmployeeID", "Country")


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: format_as_text(c) for c in employees.DATES})


def employee_dates(spark, sf_dir):
    parsed = raw_employees(spark, sf_dir).transform(employees.parse_dates).transform(_dates_as_text)
    return parsed.select("EmployeeID", *employees.DATES)


def drop_blob_columns(spark, sf_dir):
    return raw_employees(spark, sf_dir).drop("Photo")


def silver_employees(spark, sf_dir):
    return raw_employees(spark, sf_dir).transform(employees.clean_employees)


def vat_country(spark, sf_dir):
    return raw_tva(spark, sf_dir).transform(vat.clean_vat).select("CountryID", "Country")


def silver_vat(spark, sf_dir):
    return raw_tva(spark, sf_dir).transform(vat.clean_vat)


# Quality


def null_audit_employees(spark, sf_dir):
    return quality.null_audit(raw_employees(spark, sf_dir), "employees")


def null_audit_employees_cleaned(spark, sf_dir):
    return quality.null_audit(raw_employees(spark, sf_dir).transform(employees.clean_employees), "employees_cleaned")


def null_audit_sales(spark, sf_dir):
    return quality.null_audit(raw_sales(spark, sf_dir), "sales")


def null_percentages(spark, sf_dir):
    prepared = _order_lines(spark, sf_dir).transform(sales.rebase_dates).transform(sales.cast_numbers)
    return quality.null_percentages(prepared)


def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(_lines_by_order(spark, sf_dir), *LINE)


def duplicate_categories(spark, sf_dir):
    """Category ids that occur more than once, in categories of which some are repeated."""
    every = raw_categories(spark, sf_dir)
    return quality.duplicate_keys(every.unionAll(every.where(F.col("CategoryID") % 5 == 0)), "CategoryID")


def duplicate_orders(spark, sf_dir):
    """Order ids that occur more than once among the order headers, before they are merged to nodes."""
    return quality.duplicate_keys(order_headers(_lines_by_order(spark, sf_dir)), "OrderID")


def table_row_counts(spark, sf_dir):
    return quality.row_counts({name: build(spark, sf_dir) for name, build in RAW_TABLES.items()})


def quality_report(spark, sf_dir):
    reports = [
        quality.quality_report(raw_sales(spark, sf_dir), "sales", sales.sales_rules()),
        quality.quality_report(raw_products(spark, sf_dir), "products", products.product_rules()),
        quality.quality_report(raw_categories(spark, sf_dir), "categories", categories.category_rules()),
        quality.quality_report(raw_customers(spark, sf_dir), "customers", customers.customer_rules()),
        quality.quality_report(raw_employees(spark, sf_dir), "employees", employees.employee_rules()),
        quality.quality_report(raw_tva(spark, sf_dir), "vat", vat.vat_rules()),
    ]
    return reduce(DataFrame.unionAll, reports)


def price_sync(spark, sf_dir):
    return reconcile.price_sync(raw_sales(spark, sf_dir), raw_products(spark, sf_dir))


def _mismatches(spark, sf_dir, null_safe):
    lines, catalogue = _order_lines(spark, sf_dir), raw_products(spark, sf_dir)
    found = reconcile.price_mismatches(lines, catalogue, null_safe)
    return found.select(
        "OrderID", F.col("sales_ProductID").alias("ProductID"), "sales_UnitPrice", "products_UnitPrice"
    )


def price_mismatch(spark, sf_dir):
    return _mismatches(spark, sf_dir, null_safe=False)


def price_mismatch_null_safe(spark, sf_dir):
    return _mismatches(spark, sf_dir, null_safe=True)


# Graph


def graph_nodes_customer(spark, sf_dir):
    return graph.customer_nodes(raw_customers(spark, sf_dir))


def graph_nodes_product(spark, sf_dir):
    return graph.product_nodes(raw_products(spark, sf_dir))


def graph_nodes_supplier(spark, sf_dir):
    return graph.supplier_nodes(raw_suppliers(spark, sf_dir))


def graph_nodes_employee(spark, sf_dir):
    return graph.employee_nodes(raw_employees(spark, sf_dir))


def graph_nodes_category(spark, sf_dir):
    return graph.category_nodes(raw_categories(spark, sf_dir))


def graph_nodes_order(spark, sf_dir):
    return graph.order_nodes(_lines_by_order(spark, sf_dir))


def graph_edges_order_product(spark, sf_dir):
    return graph.order_product_edges(_lines_by_order(spark, sf_dir), raw_products(spark, sf_dir))


def graph_edges_sold(spark, sf_dir):
    return graph.sold_edges(_lines_by_order(spark, sf_dir), raw_employees(spark, sf_dir))


def graph_edges_purchased(spark, sf_dir):
    return graph.purchased_edges(_lines_by_order(spark, sf_dir), raw_customers(spark, sf_dir))


def graph_edges_supplies(spark, sf_dir):
    return graph.supplies_edges(raw_products(spark, sf_dir), raw_suppliers(spark, sf_dir))


def graph_edges_part_of(spark, sf_dir):
    return graph.part_of_edges(raw_products(spark, sf_dir), raw_categories(spark, sf_dir))


def graph_edges_reports_to(spark, sf_dir):
    return graph.reports_to_edges(raw_employees(spark, sf_dir))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        csv_roundtrip,
        bronze_roundtrip,
        csv_strings,
        csv_inferred,
        landed_sales,
        warehouse_run,
        graph_run,
        *map(_lake_silver, SILVER),
        *map(_lake_graph, GRAPH),
        lake_price_sync,
        lake_audits,
        landing_audit,
        malformed_lines,
        sales_dedup_header,
        sales_numeric_cast,
        rebase_years,
        shipped_date_fill,
        sales_repair_numbers,
        ship_region,
        unmapped_region_count,
        missing_cities,
        silver_sales,
        line_revenue,
        line_net_total,
        product_sales_totals,
        customer_totals,
        category_clean,
        category_crossfill,
        silver_categories,
        product_stock_clean,
        product_price_clean,
        quantity_per_unit,
        product_demand_tier,
        product_class,
        product_origin,
        silver_products,
        phone_digits,
        fill_unknown,
        country_corrections,
        customer_region,
        customer_continent,
        unknown_region_count,
        customer_value_tier,
        silver_customers,
        employee_name_clean,
        employee_country,
        employee_dates,
        drop_blob_columns,
        silver_employees,
        vat_country,
        silver_vat,
        null_audit_employees,
        null_audit_employees_cleaned,
        null_audit_sales,
        null_percentages,
        duplicate_keys,
        duplicate_categories,
        duplicate_orders,
        table_row_counts,
        quality_report,
        price_sync,
        price_mismatch,
        price_mismatch_null_safe,
        graph_nodes_customer,
        graph_nodes_product,
        graph_nodes_supplier,
        graph_nodes_employee,
        graph_nodes_category,
        graph_nodes_order,
        graph_edges_order_product,
        graph_edges_sold,
        graph_edges_purchased,
        graph_edges_supplies,
        graph_edges_part_of,
        graph_edges_reports_to,
    )
}
