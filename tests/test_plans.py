"""What the physical plans must and must not contain."""

import pytest
from conftest import CLOCK

from sieveline.operators.fused_scan import facility_findings
from sieveline.operators.row_rules import FACILITY_RULES

def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def landed(spark, make, tmp_path):
    tables = make(viral_load=[{"vl_id": "a", "patient_id": "p", "facility_id": 1, "sample_date": "2024-01-01"}])
    for name in ("viral_load", "facility"):
        tables[name].write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in ("viral_load", "facility")}


def test_row_checks_of_a_table_share_one_pruned_filtered_scan(landed):
    text = plan(facility_findings(landed, "viral_load", CLOCK))
    assert len(FACILITY_RULES["viral_load"]) == 4
    assert text.count("FileScan parquet") == 2  # the table once, the facility list once
    scan = next(line for line in text.splitlines() if "FileScan" in line and "vl_id" in line)
    assert "ordering_clinician" not in scan and "lab_name" not in scan


def test_single_row_checks_need_no_shuffle(landed):
    text = plan(facility_findings(landed, "viral_load", CLOCK, {"P04"}))
    assert "Exchange hashpartitioning" not in text
    assert "GreaterThan(vl_result,10000000.00)" in text  # pushed into the file scan


def test_facility_join_survives_without_broadcast(spark, landed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(facility_findings(landed, "viral_load", CLOCK))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
