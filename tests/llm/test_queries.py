"""Every corpus query over the smallest tables, against its SQL where it has one."""

from __future__ import annotations

import duckdb
import pytest

from sieveline.llm.queries import queries
from sieveline.llm.sql import SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_runs_and_equals_its_sql(spark, name):
    got = queries()[name](spark, FOLDER)
    rows = sorted((tuple(r[c] for c in sorted(got.columns)) for r in got.collect()), key=str)
    assert rows
    if name in SQL:
        con = duckdb.connect()
        for table in ("documents", "pages", "benchmark"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        con.execute(SQL[name])
        names = [d[0] for d in con.description]
        order = sorted(range(len(names)), key=lambda i: names[i])
        assert sorted(names) == sorted(got.columns)
        assert rows == sorted((tuple(r[i] for i in order) for r in con.fetchall()), key=str)
