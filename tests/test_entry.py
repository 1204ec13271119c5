"""Every registered query against its SQL reference on the smallest data."""

import re
from collections import Counter

import __spark_entry__ as entry
import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
# The corpus queries have tests of their own.
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if not re.match(r"op\d+_|pipeline$", name)}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def test_every_query_has_a_reference():
    assert {name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name)} == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_reference(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan
    want = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(want.columns, want.fetchall())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0].weighted_dq_score >= rows[-1].weighted_dq_score


def test_the_reports_of_a_run_are_totalled_once(spark, tmp_path):
    from datetime import datetime

    from sieveline.operators.set_rules import SUMMARY
    from sieveline.sources import derived

    for name, ddl in derived._SOURCES.items():
        rows = [(1, 1, 1, i, 2.0, 1.0, 0.0, 0.0, "R", "O", datetime(1997, 3, 1 + i)) for i in range(3)] if name == "lineitem" else []
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    tables = entry._run_tables(spark, str(tmp_path))
    assert not any("lineitem" in path for name in ("aggregate_report", SUMMARY) for path in tables[name].inputFiles())
    plain = derived.derive(spark, str(tmp_path), "aggregate_report")
    assert sorted(map(str, tables["aggregate_report"].collect())) == sorted(map(str, plain.collect()))
    assert tables[SUMMARY].count() == 5 and tables["aggregate_report"].count() == 5
