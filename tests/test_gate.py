from conftest import frame

from sieveline.operators.constraints import CONSTRAINTS, gate, rejected_counts
from sieveline.sources.schemas import FACT_TABLES

GOOD = {"patient_id": "a", "facility_id": 1, "nupi_number": "1", "date_enrolled": "2020-01-01", "sex": "male"}


def reasons(result, key):
    return {r[key]: r.reasons for r in result[1].collect()}


def test_every_fact_table_has_constraints():
    assert set(FACT_TABLES) <= set(CONSTRAINTS)


def test_patient_gate(make):
    rows = [
        GOOD,
        {**GOOD, "patient_id": "no number", "nupi_number": None},
        {**GOOD, "patient_id": "no number either", "nupi_number": None},
        {**GOOD, "patient_id": "b", "nupi_number": "2"},
        {**GOOD, "patient_id": "c", "nupi_number": "2", "facility_id": None},
        {**GOOD, "patient_id": "d", "nupi_number": "3", "facility_id": 99, "date_of_birth": "2000-01-01", "date_of_death": "1999-01-01"},
        {**GOOD, "patient_id": "e", "nupi_number": "4", "sex": "M"},
    ]
    tables = make(patient=rows)
    accepted, rejected = gate("patient", tables["patient"], tables)
    assert accepted.columns == tables["patient"].columns
    assert sorted(r.patient_id for r in accepted.collect()) == ["a", "no number", "no number either"]
    assert {r.patient_id: r.reasons for r in rejected.collect()} == {
        "b": "duplicate:nupi_number",
        "c": "duplicate:nupi_number,missing:facility_id",
        "d": "check:death_after_birth,check:enrolled_before_death,parent:facility_id",
        "e": "code:sex",
    }
    assert {r.reason: r.rejected_rows for r in rejected_counts(rejected).collect()}["duplicate:nupi_number"] == 2


def test_repeated_keys_and_missing_values(make):
    base = {"patient_id": "a", "facility_id": 1, "visit_date": "2024-01-01"}
    rows = [
        {**base, "visit_id": "1", "adherence_score": None, "next_appointment": None},
        {**base, "visit_id": "2", "next_appointment": "2024-01-01"},
        {**base, "visit_id": "2", "days_dispensed": 366},
        {**base, "visit_id": None},
        {**base, "visit_id": None, "patient_id": "nobody"},
    ]
    tables = make(patient=[GOOD], art_visit=rows)
    found = sorted((r.visit_id or "", r.reasons) for r in gate("art_visit", tables["art_visit"], tables)[1].collect())
    assert found == [
        ("", "missing:visit_id"),
        ("", "missing:visit_id,parent:patient_id"),
        ("2", "check:appointment_after_visit,duplicate:visit_id"),
        ("2", "check:days_dispensed_range,duplicate:visit_id"),
    ]


def test_lenient_domains_bind_only_when_strict(make):
    rows = [{"vl_id": "1", "patient_id": "a", "facility_id": 1, "sample_date": "2024-01-01", "vl_category": "odd"}]
    tables = make(patient=[GOOD], viral_load=rows)
    assert reasons(gate("viral_load", tables["viral_load"], tables), "vl_id") == {}
    strict = gate("viral_load", tables["viral_load"], tables, strict=True)
    assert reasons(strict, "vl_id") == {"1": "check:vl_category_domain"}


def test_suppression_scope_and_dates(spark, make):
    base = {"check_name": "c", "suppressed_by": "x", "suppression_reason": "y", "valid_from": "2024-01-01", "valid_until": "2024-02-01", "facility_id": 1}
    df = frame(
        spark,
        "dq_check_suppression",
        [{**base, "suppression_id": "ok"}, {**base, "suppression_id": "scope", "facility_id": None}, {**base, "suppression_id": "dates", "valid_until": "2024-01-01"}],
    )
    assert reasons(gate("dq_check_suppression", df, make()), "suppression_id") == {
        "scope": "check:scope_given",
        "dates": "check:ends_after_start",
    }


def test_report_period(make):
    base = {"facility_id": 1, "period_type": "monthly", "period_year": 2023, "indicator_code": "X"}
    rows = [
        {**base, "report_id": "both", "period_month": 1, "period_quarter": 1},
        {**base, "report_id": "month", "period_month": 13},
        {**base, "report_id": "fine", "period_quarter": 4, "value": 0},
    ]
    tables = make(aggregate_report=rows)
    assert reasons(gate("aggregate_report", tables["aggregate_report"], tables), "report_id") == {
        "both": "check:month_or_quarter",
        "month": "check:month_range",
    }
