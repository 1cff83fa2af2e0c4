"""The audit tables of a whole run, as one table."""

from __future__ import annotations

from tradewind.plans.warehouse import AUDITS
from validation import queries


def test_lake_audits_has_all_that_the_audits_find(spark, monkeypatch):
    once = queries.RAW_TABLES["raw_employees"]
    monkeypatch.setitem(queries.RAW_TABLES, "raw_employees", lambda *a: once(*a).union(once(*a).where("EmployeeID = 3")))
    found = queries.lake_audits(spark, "/root/testdata/sf0.001").collect()
    assert {r.audit for r in found} == set(AUDITS)
    nulls = [r for r in found if r.audit == "null_audit"]
    assert all(r.note == ("WARNING" if r.n else "INFO") and r.row_count >= r.n for r in nulls)
    assert ("employees", "3", 2) in {(r.table_name, r.item, r.n) for r in found if r.audit == "duplicate_keys"}
    assert all(r.note for r in found if r.audit == "quality_report")
