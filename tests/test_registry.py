"""Every registered query on the smallest driver tables: equal to its DuckDB oracle SQL
(row count, column names, order-insensitive values), or, for the iterative fits without
an oracle, runs to completion with the declared columns."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_mod
from sparkloom.plans.check import compare, duckdb_connection
from sparkloom.plans.oracle import ORACLE_SQL
from sparkloom.plans.registry import all_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_entry_contract(spark):
    assert set(NAMES) <= set(entry_mod.queries())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    df = entry_mod.entry(spark)
    assert df.count() > 0 and len(df.columns) > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    fn = all_queries()[name]
    sql = ORACLE_SQL.get(name)
    if sql is None:
        df = fn(spark, SF)
        assert df.count() > 0
        return
    problems, n, _, _ = compare(spark, con, name, fn, sql, SF)
    assert not problems, problems


@pytest.mark.parametrize("name", ["logreg_test_report", "svm_test_report", "svm_weighted_test_report"])
def test_report_covers_every_labelled_test_document(spark, con, name):
    row = all_queries()[name](spark, SF).first()
    sides = con.execute(
        "SELECT count(*) FILTER (WHERE quality = 1), count(*) FILTER (WHERE quality = 0) "
        "FROM documents JOIN labels USING (doc_id) WHERE doc_id % 5 = 0 AND quality IS NOT NULL").fetchone()
    assert (row.tp + row.fn, row.fp + row.tn) == sides
    assert row.tp > 0 and row.f1 == pytest.approx(2 * row.tp / (2 * row.tp + row.fp + row.fn))
