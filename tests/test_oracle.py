"""Every query against DuckDB: same columns, same types, same rows."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from validation.oracle import ORACLE
from validation.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    types = {c[0]: TYPES[str(c[1])] for c in expected.description}
    assert dict(got.dtypes) == types
    columns = sorted(types)
    order = [[c[0] for c in expected.description].index(c) for c in columns]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    have = Counter(tuple(row) for row in got.select(*columns).collect())
    assert have == want
    assert have, "an empty result proves nothing"
