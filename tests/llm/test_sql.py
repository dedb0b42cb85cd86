"""Every query with DuckDB SQL gives the rows of that SQL."""

from __future__ import annotations

import pytest
from helpers import SF

from sparkloom.llm.oracle import ORACLE_SQL
from sparkloom.llm.queries import QUERIES
from sparkloom.plans.check import compare, duckdb_connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    problems, n, _, _ = compare(spark, duckdb_connection(SF), name, QUERIES[name], ORACLE_SQL[name], SF)
    assert not problems and n > 0, problems
