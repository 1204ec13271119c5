"""Set checks against brute force over small random tables."""

import random
from datetime import date, timedelta

import pytest

from sieveline.operators import set_rules
from sieveline.plans.run import one_check, raise_findings


def day(n):
    return (date(2020, 1, 1) + timedelta(days=n)).isoformat()


@pytest.mark.parametrize("seed", range(3))
def test_duplicate_patients_equal_pairwise_comparison(make, clock, seed):
    rng = random.Random(seed)
    people = [
        {
            "patient_id": f"p{rng.randrange(40):03d}",
            "facility_id": rng.choice([1, 1, 2, 99]),
            "sex": rng.choice(["male", "female", None]),
            "date_of_birth": rng.choice(["1980-01-01", "1990-01-01", None]),
            "date_enrolled": day(rng.randrange(120)),
        }
        for _ in range(80)
    ]
    expected = set()
    for b in people:
        for a in people:
            same = all(a[k] is not None and a[k] == b[k] for k in ("facility_id", "sex", "date_of_birth"))
            gap = abs((date.fromisoformat(a["date_enrolled"]) - date.fromisoformat(b["date_enrolled"])).days)
            if same and a["patient_id"] < b["patient_id"] and gap <= 14 and b["facility_id"] != 99:
                expected.add(b["patient_id"])
    found = [r.record_id for r in one_check(make(patient=people), "U01", clock).collect()]
    assert sorted(found) == sorted(expected)


@pytest.mark.parametrize("seed", range(3))
def test_positives_equal_pairwise_comparison(make, clock, seed):
    rng = random.Random(seed)
    reports = [
        {
            "report_id": f"r{i:03d}",
            "facility_id": rng.choice([1, 2, 99]),
            "period_type": "monthly",
            "period_year": 2023,
            "period_month": rng.choice([1, 2, None]),
            "indicator_code": rng.choice(["HTS_TST", "HTS_TST_POS", "TX_NEW"]),
            "value": rng.choice([None, 1, 5, 9]),
        }
        for i in range(50)
    ]
    expected = {}
    for pos in reports:
        for tst in reports:
            if (
                (pos["indicator_code"], tst["indicator_code"]) == ("HTS_TST_POS", "HTS_TST")
                and pos["facility_id"] == tst["facility_id"] != 99
                and (pos["period_month"] or 0) == (tst["period_month"] or 0)
                and None not in (pos["value"], tst["value"])
                and pos["value"] > tst["value"]
            ):
                expected[pos["report_id"]] = min(tst["value"], expected.get(pos["report_id"], 99))
    found = {r.record_id: r.expected_value for r in one_check(make(aggregate_report=reports), "K06", clock).collect()}
    assert found == {k: f"≤ HTS_TST ({v}.00)" for k, v in expected.items()}


@pytest.mark.parametrize("seed", range(4))
def test_jumps_equal_a_walk_along_each_series(make, clock, seed, monkeypatch):
    rng = random.Random(seed)
    start = ["", "TX_CURR-2023-", "TX_CURR-" * 6, "é"][seed]  # what all ids share
    monkeypatch.setattr(set_rules, "BLOCK_REPORTS", [10_000, 3, 2, 1][seed])
    reports = [
        {
            "report_id": f"{start}{rng.choice('abc')}{i:03d}",
            "facility_id": rng.choice([1, 1, 1, 2]),
            "period_type": "monthly",
            "period_year": rng.choice([2022, 2023]),
            "period_month": rng.choice([1, 2, 3, None]),
            "indicator_code": "TX_CURR",
            "value": rng.choice([None, 0, 1, 2, 5, 20]),
        }
        for i in range(60)
    ]
    expected = set()
    for facility in (1, 2):
        series = sorted(
            (r for r in reports if r["facility_id"] == facility),
            key=lambda r: (r["period_year"], r["period_month"] or 99, r["report_id"]),
        )
        for before, now in zip(series, series[1:]):
            if before["value"] and now["value"] is not None and now["value"] > 2 * before["value"]:
                expected.add(now["report_id"])
    found = {r.record_id for r in one_check(make(aggregate_report=reports), "P03", clock).collect()}
    assert found == expected


def test_jump_text(make, clock):
    base = {"facility_id": 1, "period_type": "monthly", "period_year": 2023, "indicator_code": "TX_CURR"}
    tables = make(
        aggregate_report=[
            {**base, "report_id": "a", "period_month": 5, "value": 160},
            {**base, "report_id": "b", "period_month": 6, "value": 320},
            {**base, "report_id": "c", "period_month": 7, "value": 9999},
        ]
    )
    row = one_check(tables, "P03", clock).collect()
    assert [r.record_id for r in row] == ["c"]
    assert row[0].expected_value == "≤ 640.00 (200% of previous month)"
    assert "jumped from 320.00 (2023-6) to 9999.00 (2023-7): a 3024.7% increase" in row[0].issue_description


def test_overdue(make, clock):
    def visit(i, patient, on, back, facility=1):
        return {"visit_id": i, "patient_id": patient, "facility_id": facility, "visit_date": on, "next_appointment": back}

    person = {"facility_id": 1, "sex": "female", "date_enrolled": "2020-01-01"}
    tables = make(
        patient=[
            {**person, "patient_id": "late", "is_transferred_out": False},
            {**person, "patient_id": "ninety", "is_transferred_out": False},
            {**person, "patient_id": "dead", "is_transferred_out": False, "date_of_death": "2024-01-01"},
            {**person, "patient_id": "moved", "is_transferred_out": True},
            {**person, "patient_id": "unsure", "is_transferred_out": None},
            {**person, "patient_id": "two places", "is_transferred_out": False},
        ],
        art_visit=[
            visit("1", "late", "2023-10-01", "2024-02-14"),
            visit("2", "late", "2024-05-01", None),  # a later visit without an appointment does not clear it
            visit("3", "ninety", "2024-01-01", "2024-02-15"),
            visit("4", "dead", "2023-01-01", "2023-02-01"),
            visit("5", "moved", "2023-01-01", "2023-02-01"),
            visit("6", "unsure", "2023-01-01", "2023-02-01"),
            visit("7", "two places", "2023-01-01", "2023-02-01", 2),
            visit("8", "two places", "2023-01-01", "2023-03-01", 1),
            visit("9", "unknown", "2023-01-01", "2023-03-01", 1),
        ],
    )
    found = {r.record_id: (r.facility_id, r.raw_value) for r in one_check(tables, "T04", clock).collect()}
    assert found == {"late": (1, "overdue by 91 days"), "two places": (1, "overdue by 441 days")}


def test_case_numbers(make, clock):
    def case(i, number, facility):
        return {"tb_case_id": i, "case_number": number, "facility_id": facility, "notification_date": "2023-01-01"}

    rows = [case("b", "N1", 1), case("a", "N1", 2), case("c", "N1", 3), case("d", None, 1), case("e", None, 1)]
    rows += [case(f"z{i}", "N2", 1) for i in range(5)]
    tables = make(tb_case=rows)
    found = {r.record_id: r for r in one_check(tables, "U02", clock).collect()}
    assert set(found) == {"a", "z0"}
    assert found["a"].facility_id is None and found["a"].county_id == 10
    assert found["a"].issue_description.endswith("appears 2 times in county_id=10. Lowest id: a")
    assert "appears 5 times" in found["z0"].issue_description
    members = set_rules.duplicate_case_members(tables).collect()
    assert sorted(m.tb_case_id for m in members if m.case_number == "N2") == [f"z{i}" for i in range(5)]


def test_duplicate_reports_ignore_period_type(make, clock):
    base = {"facility_id": 1, "period_year": 2023, "indicator_code": "TX_NEW"}
    tables = make(
        aggregate_report=[
            {**base, "report_id": "b", "period_month": 1, "period_type": "monthly"},
            {**base, "report_id": "a", "period_month": 1, "period_type": "monthly"},
            {**base, "report_id": "c", "period_quarter": 1, "period_type": "quarterly"},
            {**base, "report_id": "d", "period_quarter": 2, "period_type": "quarterly"},
            {**base, "report_id": "e", "period_month": 2, "period_type": "monthly"},
        ]
    )
    found = {r.record_id: r.raw_value for r in one_check(tables, "U03", clock).collect()}
    assert found == {"a": "2 submissions", "c": "2 submissions"}


def _reports(rng, n, ids):
    return [
        {
            "report_id": f"r{rng.randrange(ids):03d}",
            "facility_id": rng.choice([1, 1, 2, 3, None]),
            "period_type": rng.choice(["monthly", "monthly", "quarterly", None]),
            "period_year": rng.choice([2022, 2023, None]),
            "period_month": rng.choice([0, 1, 2, 3, 4, 5, None]),
            "indicator_code": rng.choice(["TX_CURR", "HTS_TST", "HTS_TST_POS", "TX_NEW"]),
            "value": rng.choice([None, 0, 1, 2, 5, 20]),
        }
        for _ in range(n)
    ]


@pytest.mark.parametrize("n, ids", [(0, 1), (40, 400), (400, 200)])
def test_rules_find_the_same_in_reports_and_in_their_summary(spark, make, clock, tmp_path, n, ids):
    tables = make(aggregate_report=_reports(random.Random(n), n, ids))
    set_rules.report_summary(tables["aggregate_report"]).write.parquet(str(tmp_path / "summary"))
    for check in ("K06", "U03", "P03"):
        found = sorted(map(str, one_check(tables, check, clock).collect()))
        tables[set_rules.SUMMARY] = spark.read.parquet(str(tmp_path / "summary"))
        assert sorted(map(str, one_check(tables, check, clock).collect())) == found
        del tables[set_rules.SUMMARY]


def test_a_run_with_a_summary_reads_the_reports_once(spark, make, clock, tmp_path):
    base = {"facility_id": 1, "period_type": "monthly", "period_year": 2023, "submission_date": "2023-07-10 09:00:00"}
    rows = [{**base, "report_id": f"{code}{m}", "indicator_code": code, "period_month": m, "value": m} for m in range(1, 6) for code in ("TX_CURR", "HTS_TST", "HTS_TST_POS")]
    tables = make(aggregate_report=rows)
    tables["aggregate_report"].write.parquet(str(tmp_path / "aggregate_report"))
    tables["aggregate_report"] = spark.read.parquet(str(tmp_path / "aggregate_report"))
    set_rules.report_summary(tables["aggregate_report"]).write.parquet(str(tmp_path / "summary"))
    tables[set_rules.SUMMARY] = spark.read.parquet(str(tmp_path / "summary"))
    plan = raise_findings(tables, clock)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("/aggregate_report" in line for line in scans) == 1 and sum("/summary" in line for line in scans) >= 3
