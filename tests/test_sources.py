"""Landing, the silver run, and the scratch folder, on files."""

from __future__ import annotations

from pathlib import Path

import pytest

from tradewind.__main__ import parse, run
from tradewind.plans.warehouse import AUDITS, build_silver
from tradewind.sources import datasets, files, scratch
from validation.queries import QUERIES

HEADER = (
    "OrderID,CustomerID,EmployeeID,OrderDate,RequiredDate,ShippedDate,ShipVia,Freight,ShipName,ShipAddress,ShipCity,"
    "ShipRegion,ShipPostalCode,ShipCountry,OrderID,ProductID,UnitPrice,Quantity,Discount"
)
RAW = {
    "sales.csv": [
        HEADER,
        "1,ALFKI,5,7/4/96,8/1/96,,3,32.38,Vins,Rue 1,Reims,,51100,France,1,11,14,12,0",
        "1,ALFKI,5,7/4/96,8/1/96,7/16/96,3,32.38,Vins,Rue 1,Reims,,51100,France,1,12,-9.8,1000,-0.1",
        "2,TOMSP,6,7/5/99,8/16/99,,1,x,Toms,Str 2,Atlantis,XX,44087,Germany,2,11,,9,",
    ],
    "products.csv": [
        "ProductID,ProductName,SupplierID,CategoryID,QuantityPerUnit,UnitPrice,UnitsInStock,UnitsOnOrder",
        "11,Queso,5,4,1 kg pkg.,1k,22 units,-30",
        "12,,5,9,10 - 500 g pkgs.,n/a,none,",
    ],
    "customers.csv": [
        "CustomerID,CompanyName,City,PostalCode,Region,Country,Phone,Fax,Extra",
        "ALFKI,Alfreds,Berlin,01234,,Germani#,030-007,n.a.,more",
        "TOMSP,,,,,Japan,,,",
    ],
    "employees.csv": [
        "EmployeeID,LastName,FirstName,Title,Region,Country,HomePhone,BirthDate,HireDate,Photo,ReportsTo",
        "5,Büchanan1,Steven,,,UKA,(71) 555,03/04/55,1/2/93,0x,",
    ],
    "categories.csv": [
        "CategoryID,CategoryName,Description,Picture",
        '4,,"Cheeses, soft",0x',
    ],
    "suppliers.csv": ["SupplierID,CompanyName", "5,Cooperativa"],
    "tva_country.csv": ["Country,TauxTVA", "Allemagne,19", ",20"],
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    raw = root / "raw"
    raw.mkdir()
    for name, lines in RAW.items():
        (raw / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    lake = str(root / "lake")
    files.land(spark, str(raw), lake)
    build_silver(spark, lake)
    return lake


def test_every_dataset_lands(spark, lake):
    assert sorted(p.name for p in Path(lake, "bronze").iterdir()) == sorted(datasets.DATASETS)
    landed = files.read_table(spark, lake, "bronze", "sales")
    assert landed.columns[0] == "OrderID0" and landed.columns[14] == "OrderID14"
    typed = {"OrderID" if c.startswith("OrderID") else c: t for c, t in landed.dtypes if t != "string"}
    assert typed == datasets.DATASETS["sales"].types and dict(landed.dtypes)["OrderID14"] == "bigint"
    # A column the dataset does not name lands as text; a number that does not parse is NULL.
    assert dict(files.read_table(spark, lake, "bronze", "customers").dtypes)["Extra"] == "string"
    assert [r.Freight for r in landed.orderBy("OrderID0", "ProductID").collect()] == [32.38, 32.38, None]


def test_silver_sales(spark, lake):
    got = files.read_table(spark, lake, "silver", "sales").orderBy("OrderID", "ProductID")
    picked = got.select("OrderDate", "ShippedDate", "ShipRegion", "UnitPrice", "Quantity", "Discount").collect()
    assert [tuple(r) for r in picked] == [
        ("2022-07-04", "2022-07-11", "Grand Est", 14.0, 12.0, 0.0),
        ("2022-07-04", "2022-07-16", "Grand Est", 9.8, 1000.0, 0.1),
        ("07-05", None, "XX", 0.0, 9.0, 0.0),
    ]


def test_silver_products(spark, lake):
    got = files.read_table(spark, lake, "silver", "products").orderBy("ProductID")
    assert [tuple(r) for r in got.collect()] == [
        (11, "Queso", 5, 4, "1 kg pkg.", 1000.0, 22, 30, 1, "kg pkg.", "Low Demand", "Food"),
        (12, "Unknown", 5, 9, "10 - 500 g pkgs.", None, None, None, 10, "500 g pkgs.", "Medium Demand", "autres"),
    ]


def test_silver_customers(spark, lake):
    got = files.read_table(spark, lake, "silver", "customers").orderBy("CustomerID")
    columns = ["CompanyName", "City", "PostalCode", "Region", "Country", "Phone", "Fax", "CodeRegion", "StatutClient"]
    assert [tuple(r) for r in got.select(*columns).collect()] == [
        ("Alfreds", "Berlin", "01234", "Europe", "Germany", "030007", "", "EU", "Moyen"),
        ("Unknown", "Unknown", "Unknown", "Unknown", "Japan", None, "Unknown", "AS", "Low"),
    ]


def test_other_silver_tables(spark, lake):
    people = files.read_table(spark, lake, "silver", "employees").collect()
    assert [(r.LastName, r.Title, r.Region, r.Country, r.HomePhone, str(r.BirthDate), r.HireDate) for r in people] == [
        ("Bchanan", "Unknown", "Unknown", "UK", "71555", "2055-03-04", None)
    ]
    assert "Photo" not in people[0].asDict()
    assert [tuple(r) for r in files.read_table(spark, lake, "silver", "categories").collect()] == [
        (4, "Cheeses", "Cheeses, soft")
    ]
    taxes = files.read_table(spark, lake, "silver", "vat").collect()
    assert sorted((r.Country or "", r.TauxTVA) for r in taxes) == [("", "20"), ("Germany", "19")]
    assert files.read_table(spark, lake, "silver", "suppliers").count() == 1


def test_silver_types(spark, lake):
    for name, types in datasets.SILVER_TYPES.items():
        found = dict(files.read_table(spark, lake, "silver", name).dtypes)
        assert {c: found[c] for c in types} == types, name


def test_a_second_run_replaces_the_first(spark, lake):
    before = files.read_table(spark, lake, "silver", "sales").count()
    build_silver(spark, lake)
    assert files.read_table(spark, lake, "silver", "sales").count() == before == 3


def test_years_can_be_kept(spark, lake):
    build_silver(spark, lake, unmapped_years="keep")
    dates = {r.OrderDate for r in files.read_table(spark, lake, "silver", "sales").collect()}
    assert dates == {"2022-07-04", "2099-07-05"}
    build_silver(spark, lake)


def test_inferred_and_untyped_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("n,x\n1,2.5\n2,\n")
    assert files.read_csv(spark, str(path), infer=True).dtypes == [("n", "int"), ("x", "double")]
    assert files.read_csv(spark, str(path)).dtypes == [("n", "string"), ("x", "string")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_key_that_does_not_parse_raises(spark, tmp_path, ansi):
    path = tmp_path / "a.csv"
    path.write_text("id,x\n1,2.5\nA,1\n,3\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="id is no bigint: A"):
            files.read_csv(spark, str(path), {"id": "bigint"}).collect()
        assert files.read_csv(spark, str(path), {"x": "double"}).where("id is null").count() == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_declared_columns_match_without_case_and_must_be_there(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("orderid,x\n1,2.5\n")
    assert files.read_csv(spark, str(path), {"OrderID": "bigint"}).dtypes == [("orderid", "bigint"), ("x", "string")]
    with pytest.raises(ValueError, match="has no column ProductID"):
        files.read_csv(spark, str(path), {"ProductID": "bigint"})
    path.write_text("OrderID,x,OrderID\n1,2.5,1\n")
    twice = files.read_csv(spark, str(path), {"OrderID": "bigint"})
    assert twice.dtypes == [("OrderID0", "bigint"), ("x", "string"), ("OrderID2", "bigint")]


def test_a_quoted_value_may_hold_a_line_break(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,t\n1,"a\nb"\n2,c\n')
    read = files.read_csv(spark, str(path), {"id": "bigint"}, multiline=True)
    assert [tuple(r) for r in read.orderBy("id").collect()] == [(1, "a\nb"), (2, "c")]


def test_empty_text_comes_back_from_csv_as_null(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, " a ")], "id int, t string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out")).orderBy("id").collect()
    assert [tuple(r) for r in back] == [("1", None), ("2", " a ")]


def test_malformed_lines_are_counted_and_shown(spark, tmp_path):
    (tmp_path / "sales.csv").write_text('a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x,y",,\n"q\n,,\n')
    (tmp_path / "tva_country.csv").write_text("line,_line\n1,2\n3\n")
    assert {r.line for r in files.malformed_lines(spark, f"{tmp_path}/tva_country.csv").collect()} == {"3"}
    found = {r.line for r in files.malformed_lines(spark, f"{tmp_path}/sales.csv").collect()}
    assert {"4,5", "6,7,8,9"} <= found and not found & {"1,2,3", '"x,y",,'}
    some = {n: datasets.DATASETS[n] for n in ("sales", "tva")}
    audit = {r.table_name: (r.n_rows, r.n_malformed) for r in files.landing_audit(spark, str(tmp_path), some).collect()}
    assert audit["tva"] == (2, 1) and audit["sales"][1] == len(found)
    assert files.malformed_lines(spark, f"{tmp_path}/tva_country.csv").columns == ["line"]


def test_preview(spark):
    assert files.preview(spark.range(100)).count() == 20
    assert files.preview(spark.range(100), 5).count() == 5


def test_command_line_runs_every_step(spark, lake, tmp_path):
    copy = str(tmp_path / "lake")
    raw = str(Path(lake).parent / "raw")
    run(spark, parse(["land", raw, copy, "--audit"]))
    landed = {r.table_name: r.n_malformed for r in files.read_table(spark, copy, "audit", "landing").collect()}
    assert landed.keys() == datasets.DATASETS.keys() and landed["sales"] == 0
    run(spark, parse(["silver", copy, "--tables", "sales", "vat", "--unmapped-years", "keep"]))
    assert sorted(p.name for p in Path(copy, "silver").iterdir()) == ["sales", "vat"]
    run(spark, parse(["prices", copy]))
    synced = files.read_table(spark, copy, "silver", "price_sync").orderBy("OrderID0", "sales_ProductID").collect()
    # The catalogue price is taken as it is: '1k' is no number here.
    assert [(r.OrderID0, r.sales_ProductID, r.sales_UnitPrice) for r in synced] == [(1, 11, None), (1, 12, None), (2, 11, None)]
    run(spark, parse(["graph", copy]))
    assert len(list(Path(copy, "graph").iterdir())) == 13  # twelve tables, and the order headers they share
    run(spark, parse(["audit", copy]))
    assert sorted(p.name for p in Path(copy, "audit").iterdir()) == sorted([*AUDITS, "landing"])
    counted = files.read_table(spark, copy, "audit", "row_counts").where("table_name like 'silver.%'").collect()
    assert sorted(r.table_name for r in counted) == ["silver.sales", "silver.vat"]
    sold = files.read_table(spark, copy, "graph", "edges_sold").collect()
    assert [tuple(r) for r in sold] == [(5, 1)]


def test_an_unknown_silver_table_is_refused(spark, lake):
    with pytest.raises(ValueError, match="no silver table orders"):
        build_silver(spark, lake, ["orders"])


class FakeSession:
    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_folder_is_the_sessions(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch.scratch_path(spark, "a"), scratch.scratch_path(spark, "a")
    assert first.startswith(root + "/a-") and first != second


def test_scratch_folder_must_be_named_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_path(FakeSession(spark_master="yarn"), "a")
    assert scratch.scratch_path(FakeSession(spark_master="local[2]"), "a")


def test_a_bare_local_scratch_folder_is_refused_on_a_cluster():
    cluster = {"spark_master": "local-cluster[2,1,1024]"}
    with pytest.raises(ValueError, match="bare local path"):
        scratch.scratch_path(FakeSession(**cluster, spark_checkpoint_dir="/tmp/x"), "a")
    assert scratch.scratch_path(FakeSession(**cluster, spark_checkpoint_dir="file:///shared/x"), "a")


@pytest.mark.parametrize("path", ["/tmp/x", "/tmp/x/"])
def test_a_bare_local_scratch_folder_is_taken_on_a_cluster_if_rows_come_back(spark, tmp_path, monkeypatch, path):
    settings = {"spark.master": "local-cluster[3,4,10240]", "spark.checkpoint.dir": f"{tmp_path}{path}"}
    read = spark.conf.get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: settings.get(key) or read(key, *default))
    first, second = scratch.scratch_path(spark, "a"), scratch.scratch_path(spark, "a")
    assert first.startswith(f"{tmp_path}/tmp/x/a-") and first != second
    assert len(list((tmp_path / "tmp/x").glob("trial-*"))) == 1
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, path: spark.range(0))
    settings["spark.checkpoint.dir"] = str(tmp_path / "unshared")
    with pytest.raises(ValueError, match="bare local path"):
        scratch.scratch_path(spark, "a")


@pytest.mark.parametrize("name", ["csv_inferred", "csv_roundtrip", "csv_strings", "lake_silver_categories", "lake_price_sync"])
def test_queries_that_write_run_on_a_cluster_with_a_bare_scratch_folder(spark, tmp_path, monkeypatch, name):
    expected = sorted(QUERIES[name](spark, "/root/testdata/sf0.001").collect(), key=str)
    settings = {"spark.master": "local-cluster[3,4,10240]", "spark.checkpoint.dir": str(tmp_path / "bare")}
    read = spark.conf.get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: settings.get(key) or read(key, *default))
    found = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert sorted(found, key=str) == expected != []
    assert any((tmp_path / "bare").iterdir())


@pytest.mark.parametrize("name", [f"lake_graph_nodes_{x}" for x in ("category", "employee", "order", "product", "supplier")])
def test_node_tables_are_written_on_a_cluster_with_a_bare_scratch_folder(spark, tmp_path, monkeypatch, name):
    test_queries_that_write_run_on_a_cluster_with_a_bare_scratch_folder(spark, tmp_path, monkeypatch, name)


@pytest.mark.parametrize("name", ["csv_inferred", "lake_graph_nodes_category", "lake_silver_employees"])
def test_queries_that_write_run_on_a_cluster_with_a_folder_set_by_call(spark, tmp_path, monkeypatch, name):
    settings = {"spark.master": "local-cluster[3,4,10240]", "spark.checkpoint.dir": None}
    read = spark.conf.get
    monkeypatch.setattr(
        type(spark.conf), "get", lambda self, key, *default: settings[key] if key in settings else read(key, *default)
    )
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: f"file:{tmp_path}/called")
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert len(list((tmp_path / "called").glob("trial-*"))) == 1
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, path: spark.range(0))
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: f"file:{tmp_path}/unshared")
    with pytest.raises(ValueError, match="bare local path"):
        scratch.scratch_path(spark, "a")
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    with pytest.raises(ValueError, match="set spark.checkpoint.dir"):
        scratch.scratch_path(spark, "a")
