"""Physical plans: what is broadcast, scanned and shuffled, and how a dominating key is treated."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tradewind.operators import quality, reconcile
from tradewind.operators.segments import with_class
from tradewind.plans import graph, sales
from validation import queries
from validation.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WRITING = {"csv_roundtrip", "csv_strings", "csv_inferred", "bronze_roundtrip", "landed_sales", "warehouse_run", "graph_run"}
LAZY = [name for name in QUERIES if name not in WRITING and not name.startswith("lake_")]


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    """The physical plan before execution, where each operator stands once."""
    return df._jdf.queryExecution().sparkPlan().toString()


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_query_leaves_the_jvm_or_pairs_everything(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("EvalPython", "InPandas", "Scan ExistingRDD", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


@pytest.mark.parametrize("name", ["ship_region", "silver_sales", "customer_region", "customer_continent"])
def test_lookups_broadcast_their_dimension_whatever_the_session_says(spark, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES[name](spark, SF_DIR))
    assert re.search(r"BroadcastHashJoin \[(ShipCity|Country)", text)


@pytest.mark.parametrize("name", ["product_class", "price_sync", "graph_edges_sold", "product_demand_tier"])
def test_data_of_unknown_size_is_not_forced_into_a_broadcast(spark, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES[name](spark, SF_DIR))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


@pytest.mark.parametrize(
    ("name", "scans"),
    [("null_audit_employees", 1), ("null_audit_sales", 2), ("null_percentages", 2), ("quality_report", 7)],
)
def test_audits_scan_each_table_once(spark, name, scans):
    assert plan(QUERIES[name](spark, SF_DIR)).count("FileScan parquet") == scans


JIT_LIMIT = 8000  # bytes of one method beyond which the JVM leaves it interpreted


@pytest.mark.parametrize("name", LAZY)
def test_generated_methods_can_be_compiled(spark, name):
    with settings(spark, spark__sql__adaptive__enabled="false"):
        stages = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan()
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(stages))]
    assert sizes and max(sizes) < JIT_LIMIT


def test_date_columns_share_one_calendar(spark):
    text = executed(QUERIES["rebase_years"](spark, SF_DIR))
    final = text.split("Initial Plan")[0]
    assert final.count("ReusedExchange") == len(sales.DATES) - 1


def test_totals_read_only_their_columns(spark, tmp_path):
    QUERIES["silver_sales"](spark, SF_DIR).write.parquet(str(tmp_path / "sales"))
    stored = spark.read.parquet(str(tmp_path / "sales"))
    from tradewind.operators.totals import customer_totals, product_totals

    for df, columns in (
        (product_totals(stored), {"ProductID", "UnitPrice", "Quantity"}),
        (customer_totals(stored), {"CustomerID", "UnitPrice", "Quantity", "Discount"}),
    ):
        schema = re.search(r"ReadSchema: struct<(.*?)>", df._jdf.queryExecution().executedPlan().toString())
        assert {c.split(":")[0] for c in schema.group(1).split(",")} == columns


def test_a_filter_on_a_stored_column_reaches_the_scan(spark, tmp_path):
    QUERIES["silver_sales"](spark, SF_DIR).write.parquet(str(tmp_path / "sales"))
    stored = spark.read.parquet(str(tmp_path / "sales")).where(F.col("ShipCity") == "Reims")
    text = executed(stored.transform(sales.map_region))
    assert "EqualTo(ShipCity,Reims)" in text


def test_cleaning_sales_shuffles_nothing(spark, tmp_path):
    QUERIES["bronze_roundtrip"](spark, SF_DIR).write.parquet(str(tmp_path / "sales"))
    cleaned = sales.clean_sales(spark.read.parquet(str(tmp_path / "sales")))
    text = executed(cleaned)
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_totals_combine_before_the_shuffle_and_shuffle_once(spark):
    text = executed(QUERIES["product_sales_totals"](spark, SF_DIR))
    assert "partial_sum" in text
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        tiers = QUERIES["product_demand_tier"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    # Totals are joined on the partitioning their aggregation left; only the products are shuffled besides.
    assert len(re.findall(r"Exchange hashpartitioning\(ProductID", tiers)) == 2


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "16KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "16KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "16",
}


@pytest.fixture(scope="module")
def hot_lines(spark):
    """Order lines of which a third have one product and a tenth none; order ids repeat per product."""
    line = F.col("id")
    columns = {
        "OrderID": line % 9001,
        "EmployeeID": F.when(line % 3 == 0, 5).otherwise(line % 50),
        "ProductID": F.when(line % 3 == 0, 7).when(line % 10 == 1, None).otherwise(line % 500),
        "UnitPrice": (line % 11).cast("double"),
        "Quantity": (line % 5).cast("double"),
        "Discount": F.lit(0.0),
        "ShipName": F.concat(F.lit("a long ship name to give rows some size "), line.cast("string")),
    }
    return spark.range(0, 40000, 1, 8).select(*[c.alias(n) for n, c in columns.items()])


@pytest.fixture(scope="module")
def catalogue(spark):
    key = F.col("id")
    return spark.range(0, 400, 1, 4).select(
        key.alias("ProductID"), (key % 11).cast("string").alias("UnitPrice"), (key % 2).alias("CategoryID")
    )


def test_a_dominating_product_is_split_in_the_price_join(spark, hot_lines, catalogue):
    compared = reconcile.price_mismatches(hot_lines, catalogue, null_safe=True)
    with settings(spark, **SKEW):
        text = executed(compared)
        shuffled = sorted(compared.select("OrderID", "ShipName").collect())
    assert "skew=true" in text
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="10MB"):
        assert sorted(compared.select("OrderID", "ShipName").collect()) == shuffled


def test_a_dominating_category_is_split_in_the_class_join(spark, catalogue):
    products = spark.range(0, 40000, 1, 8).select(
        F.col("id").alias("ProductID"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 300).alias("CategoryID"),
        F.concat(F.lit("a long product name to give rows some size "), F.col("id").cast("string")).alias("ProductName"),
    )
    categories = spark.range(300).select(F.col("id").alias("CategoryID"), F.lit("Tech").alias("CategoryName"))
    with settings(spark, **SKEW):
        graded = with_class(products, categories)
        text = executed(graded)
        assert graded.groupBy("ClassProduct").count().collect() == [("Tech", 40000)]
    assert "skew=true" in text


def test_a_dominating_employee_is_split_in_the_edge_join(spark, hot_lines):
    people = spark.range(50).select(F.col("id").alias("EmployeeID"))
    with settings(spark, **SKEW):
        edges = graph.sold_edges(hot_lines, people)
        text = executed(edges)
        got = {tuple(r) for r in edges.collect()}
    assert "skew=true" in text
    assert got == {tuple(r) for r in hot_lines.select("EmployeeID", "OrderID").distinct().collect()}


def test_a_dominating_product_is_split_in_the_edge_join(spark, hot_lines, catalogue):
    with settings(spark, **SKEW):
        edges = graph.order_product_edges(hot_lines, catalogue)
        text = executed(edges)
        got = {(r.src, r.dst): (r.unitPrice, r.quantity) for r in edges.collect()}
    assert "skew=true" in text
    listed = {r.ProductID for r in catalogue.collect()}
    least = {}
    for r in hot_lines.where("ProductID is not null").collect():
        if r.ProductID in listed:
            pair, line = (r.OrderID, r.ProductID), (r.UnitPrice, r.Quantity)
            least[pair] = min(least.get(pair, line), line)
    assert got == least


def test_a_dominating_key_reaches_the_final_aggregation_once_per_task(spark, hot_lines):
    """Rows shuffled by a total, a duplicate check and a distinct: at most keys times input tasks, not all lines."""
    from tradewind.operators.totals import product_totals

    for df, keys in (
        (product_totals(hot_lines), 501),
        (quality.duplicate_keys(hot_lines, "EmployeeID"), 50),
        (hot_lines.select("EmployeeID").distinct(), 50),
    ):
        df.collect()
        shuffled = written_rows(df)
        assert 0 < shuffled <= keys * 8


def written_rows(df):
    """Rows the query wrote to its shuffles, from the metrics of the executed plan."""
    node = df._jdf.queryExecution().executedPlan()
    total, pending = 0, [node]
    while pending:
        node = pending.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            pending.append(node.executedPlan())
            continue
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        if name.endswith("QueryStage"):
            pending.append(node.plan())
        children = node.children()
        pending += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize(
    "name",
    ["duplicate_keys", "duplicate_orders", "graph_nodes_order", "graph_edges_order_product", "graph_edges_sold", "graph_edges_purchased"],
)
def test_lines_grouped_by_order_are_dealt_to_tasks_by_their_number(spark, monkeypatch, name):
    expected = sorted(map(tuple, QUERIES[name](spark, SF_DIR).collect()))
    monkeypatch.setattr(queries, "TASK_ROWS", 500)
    n = 1 + spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count() // 500
    df = QUERIES[name](spark, SF_DIR)
    assert n > 4 and re.search(rf"hashpartitioning\(l_orderkey#\d+L, {n}\), REPARTITION_BY_NUM", executed(df))
    assert sorted(map(tuple, df.collect())) == expected
