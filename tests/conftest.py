from __future__ import annotations

import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from sieveline.functions.time import Clock  # noqa: E402
from sieveline.session import build_session  # noqa: E402
from sieveline.sources.landing import conform  # noqa: E402
from sieveline.sources.schemas import DEFAULTS, NOW, SCHEMAS  # noqa: E402

CLOCK = Clock.at("2024-05-15 06:00:00")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        shuffle_partitions=4,
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.sql.maxMetadataStringLength": "5000"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def clock():
    return CLOCK


def _value(raw, datatype):
    if raw is None:
        return None
    if isinstance(datatype, T.DateType):
        return date.fromisoformat(raw)
    if isinstance(datatype, T.TimestampType):
        return datetime.fromisoformat(raw)
    if isinstance(datatype, T.DecimalType):
        return Decimal(str(raw))
    return raw


def frame(spark, table: str, rows: list[dict], clock: Clock = CLOCK):
    """Rows of a table, each like an insert of its own: what a row leaves out takes its default."""
    named = [f for f in SCHEMAS[table].fields if any(f.name in row for row in rows)]
    named = named or [SCHEMAS[table].fields[0]]
    usual = {k: v for k, v in DEFAULTS.get(table, {}).items() if v is not NOW}
    data = [tuple(_value(row.get(f.name, usual.get(f.name)), f.dataType) for f in named) for row in rows]
    return conform(spark.createDataFrame(data, T.StructType(named)), table, clock)


FACILITIES = [
    {"facility_id": 1, "mfl_code": "M1", "facility_name": "Alpha", "county_id": 10, "sub_county_id": 101},
    {"facility_id": 2, "mfl_code": "M2", "facility_name": "Beta", "county_id": 10, "sub_county_id": 102},
    {"facility_id": 3, "mfl_code": "M3", "facility_name": "Gamma", "county_id": 20, "is_active": False},
]


class Tables(dict):
    """All tables by name, each built when first used."""

    def __init__(self, spark, rows):
        super().__init__()
        self.spark, self.rows = spark, rows

    def __missing__(self, table):
        if table not in SCHEMAS:
            raise KeyError(table)
        self[table] = frame(self.spark, table, self.rows.get(table, []))
        return self[table]


@pytest.fixture
def make(spark):
    def build(**rows):
        rows.setdefault("facility", [{"is_active": True, **f} for f in FACILITIES])
        rows.setdefault("county", [{"county_id": 10, "county_name": "North"}, {"county_id": 20, "county_name": "South"}])
        return Tables(spark, rows)

    return build
