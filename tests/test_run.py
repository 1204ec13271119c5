"""Whole runs: planted faults, repeats, re-runs, suppressions, storage."""

from collections import Counter

import pytest
from conftest import CLOCK, frame
from pyspark.sql import functions as F

from sieveline.operators.dedup import collapse_repeats, collapse_staged, drop_repeated_active
from sieveline.operators.fixed_values import CHECKS
from sieveline.operators.maintenance import archive_old_resolved, cleanup_expired_suppressions
from sieveline.operators.row_rules import FINDING_DDL
from sieveline.operators.scan_counts import scan_counts
from sieveline.plans.run import RUN_TABLES, execute_run, kept_findings, run_checks
from sieveline.sources.store import Store


def planted() -> dict[str, list[dict]]:
    """One clean record per table and one fault (or more) per check."""
    person = {"facility_id": 1, "sex": "female", "date_of_birth": "1985-04-01", "date_enrolled": "2020-01-10"}
    start = {"patient_id": "ok", "facility_id": 1, "art_start_date": "2020-01-17", "weight_at_start": 60}
    load = {"patient_id": "ok", "facility_id": 1, "sample_date": "2023-06-15", "is_ldl": False, "vl_result": 40}
    visit = {"patient_id": "ok", "facility_id": 1, "visit_date": "2024-05-01", "next_appointment": "2024-06-01"}
    case = {"facility_id": 1, "notification_date": "2023-03-01", "treatment_start": "2023-03-03"}
    anc = {"patient_id": "ok", "facility_id": 1, "visit_date": "2023-05-10", "gestational_age_wks": 12}
    birth = {"patient_id": "ok", "facility_id": 1, "delivery_date": "2023-04-15", "birth_weight_g": 3000}
    report = {"facility_id": 1, "period_type": "monthly", "period_year": 2023, "submission_date": "2023-07-10 09:00:00"}
    stock = {"facility_id": 1, "commodity_id": 1, "record_date": "2023-10-31", "opening_balance": 1200}
    return {
        "patient": [
            {**person, "patient_id": "ok"},
            *[{**person, "patient_id": f"nodob{i}", "date_of_birth": None} for i in range(3)],
            {**person, "patient_id": "nosex", "sex": "unknown", "date_of_birth": "1991-01-01"},
            {**person, "patient_id": "future", "date_of_birth": "2035-06-15", "date_enrolled": "2035-06-20"},
            {**person, "patient_id": "unborn", "date_of_birth": "2000-05-10", "date_enrolled": "1999-12-01"},
            {**person, "patient_id": "twin-a", "date_of_birth": "1987-03-22", "date_enrolled": "2020-05-01"},
            {**person, "patient_id": "twin-b", "date_of_birth": "1987-03-22", "date_enrolled": "2020-05-15"},
            {**person, "patient_id": "dead", "sex": "male", "date_of_birth": "1980-09-14", "date_of_death": "2022-05-20"},
            {**person, "patient_id": "lost", "date_of_birth": "1979-04-18"},
        ],
        "art_enrollment": [
            {**start, "enrollment_id": "ok"},
            {**start, "enrollment_id": "early", "patient_id": "nodob0", "art_start_date": "2019-10-12", "weight_at_start": None},
            {**start, "enrollment_id": "negative", "cd4_at_start": -50, "weight_at_start": None},
            {**start, "enrollment_id": "huge", "cd4_at_start": 3450, "weight_at_start": None},
            {**start, "enrollment_id": "light", "weight_at_start": None},
            {**start, "enrollment_id": "late", "patient_id": "dead", "art_start_date": "2022-06-01"},
        ],
        "viral_load": [
            {**load, "vl_id": "ok", "vl_category": "suppressed"},
            {**load, "vl_id": "before", "result_date": "2023-06-01"},
            {**load, "vl_id": "over", "vl_result": 15000000, "vl_category": "high_vl"},
            *[{**load, "vl_id": f"empty{i}", "vl_result": None} for i in range(5)],
            {**load, "vl_id": "mislabeled", "vl_result": 8500, "vl_category": "suppressed"},
        ],
        "art_visit": [
            {**visit, "visit_id": "ok", "weight_kg": 64, "adherence_score": 90},
            {**visit, "visit_id": "overdue", "patient_id": "lost", "visit_date": "2023-10-08", "next_appointment": "2023-12-17"},
            {**visit, "visit_id": "4kg", "weight_kg": 4},
            {**visit, "visit_id": "minus", "adherence_score": -10},
        ],
        "tb_case": [
            {**case, "tb_case_id": "ok", "case_number": "T1"},
            {**case, "tb_case_id": "going", "case_number": "T2", "treatment_start": None},
            {**case, "tb_case_id": "slow", "case_number": "T3", "notification_date": "2023-11-20", "diagnosis_date": "2023-06-01", "treatment_start": "2023-11-21"},
            {**case, "tb_case_id": "cured", "case_number": "T4", "treatment_start": None, "treatment_outcome": "cured"},
            {**case, "tb_case_id": "dup1", "case_number": "T5"},
            {**case, "tb_case_id": "dup2", "case_number": "T5", "facility_id": 2},
        ],
        "anc_visit": [
            {**anc, "anc_visit_id": "ok"},
            {**anc, "anc_visit_id": "male", "patient_id": "dead"},
            {**anc, "anc_visit_id": "50", "gestational_age_wks": 50},
            {**anc, "anc_visit_id": "280", "systolic_bp": 280},
        ],
        "delivery": [
            {**birth, "delivery_id": "ok"},
            {**birth, "delivery_id": "120g", "birth_weight_g": 120},
            {**birth, "delivery_id": "mtct", "baby_hiv_status": "positive", "mother_hiv_status": "negative"},
        ],
        "chw": [{"chw_id": "w", "chw_code": "W", "facility_id": 1}],
        "chw_service_record": [
            {"service_id": "ok", "chw_id": "w", "service_date": "2024-05-01", "created_at": "2024-05-03 00:00:00"},
            {"service_id": "late", "chw_id": "w", "service_date": "2023-04-01", "created_at": "2024-05-03 00:00:00"},
        ],
        "aggregate_report": [
            {**report, "report_id": "ok", "period_month": 5, "indicator_code": "TX_CURR", "value": 300},
            {**report, "report_id": "jump", "period_month": 6, "indicator_code": "TX_CURR", "value": 9999},
            {**report, "report_id": "late", "period_month": 3, "indicator_code": "TB_NOTIF", "value": 1, "submission_date": "2023-07-15 09:00:00"},
            {**report, "report_id": "minus", "period_month": 5, "indicator_code": "TX_NEW", "value": -15},
            {**report, "report_id": "tests", "period_month": 5, "indicator_code": "HTS_TST", "value": 200},
            {**report, "report_id": "more", "period_month": 5, "indicator_code": "HTS_TST_POS", "value": 350},
            {**report, "report_id": "closed", "period_month": 5, "indicator_code": "HTS_TST", "value": 125, "facility_id": 3},
            {**report, "report_id": "twice1", "period_month": 6, "indicator_code": "TX_NEW", "value": 44},
            {**report, "report_id": "twice2", "period_month": 6, "indicator_code": "TX_NEW", "value": 61},
        ],
        "stock_record": [
            {**stock, "stock_id": "ok", "received_qty": 500, "dispensed_qty": 600, "losses_adjustments": 20, "closing_balance": 1080},
            *[
                {**stock, "stock_id": f"wrong{i}", "received_qty": 500, "dispensed_qty": 600, "losses_adjustments": 20, "closing_balance": 900}
                for i in range(3)
            ],
            {**stock, "stock_id": "45", "opening_balance": 0, "closing_balance": 0, "days_out_of_stock": 45},
            *[{**stock, "stock_id": f"empty{i}", "closing_balance": None} for i in range(2)],
        ],
    }


EXPECTED = {c.id: 1 for c in CHECKS} | {"C01": 3, "C04": 4, "C05": 2, "C06": 5, "K05": 3}


@pytest.fixture
def tables(make):
    built = make(**planted())
    return {name: built[name] for name in RUN_TABLES}


def counts(df):
    return {row.check_name[:3]: row["count"] for row in df.groupBy("check_name").count().collect()}


def test_every_planted_fault_is_found_once(tables):
    assert counts(kept_findings(tables, CLOCK)) == EXPECTED


def test_scan_counts(tables):
    got = {r.check_name[:3]: r.records_scanned for r in scan_counts(tables, CLOCK).collect()}
    assert len(got) == 36
    assert (got["C01"], got["V01"], got["U01"]) == (11, 8, 8)
    assert (got["K07"], got["T04"], got["K06"], got["P03"], got["P01"]) == (1, 2, 3, 2, 2)


def test_check_log_and_run_row(tables):
    result = run_checks(tables, CLOCK, "r", "pipeline")
    log = {r.check_name[:3]: r for r in result.check_log.collect()}
    assert {k: r.issues_raised for k, r in log.items()} == EXPECTED
    assert log["C03"].severity == "critical" and log["C03"].source_table == "tb_case"
    row = result.run.first()
    assert (row.checks_executed, row.issues_found, row.triggered_by) == (36, sum(EXPECTED.values()), "pipeline")


def test_stored_runs_are_idempotent_and_reraise_resolved(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path / "dq"))
    execute_run(store, tables, CLOCK, "run1")
    total = sum(EXPECTED.values())
    issues = store.read("data_quality_issue")
    assert issues.count() == total and issues.select("issue_id").distinct().count() == total
    execute_run(store, tables, CLOCK, "run2")
    assert store.read("data_quality_issue").count() == total
    # A resolved finding is raised again, a confirmed one is not.
    current = store.read("data_quality_issue")
    status = (
        F.when(F.col("record_id") == "mtct", "resolved").when(F.col("record_id") == "120g", "confirmed").otherwise(F.col("status"))
    )
    store.replace("data_quality_issue", current.withColumn("status", status))
    execute_run(store, tables, CLOCK, "run3")
    again = store.read("data_quality_issue").filter("check_run_id = 'run3'").collect()
    assert [(r.check_name[:3], r.record_id) for r in again] == [("K04", "mtct")]
    runs = {r.run_id: (r.checks_executed, r.issues_found) for r in store.read("dq_engine_run").collect()}
    assert runs == {"run1": (36, total), "run2": (36, 0), "run3": (36, 1)}
    assert store.read("dq_check_log").count() == 3 * 36


def test_suppressions_apply_only_when_asked(spark, make, tables):
    requests = frame(
        spark,
        "dq_check_suppression",
        [
            {"check_name": "K05_stock_balance_arithmetic", "county_id": 10, "facility_id": None, "valid_from": "2024-05-01", "valid_until": "2024-05-15", "is_active": True},
            {"check_name": "C01_patient_missing_dob", "county_id": None, "facility_id": 1, "valid_from": "2024-05-16", "valid_until": "2024-06-15", "is_active": True},
            {"check_name": "C06_vl_result_missing_without_ldl", "county_id": None, "facility_id": 1, "valid_from": "2024-05-01", "valid_until": "2024-06-15", "is_active": False},
            {"check_name": "V08_birth_weight_below_minimum", "county_id": None, "facility_id": 1, "valid_from": "2024-05-15", "valid_until": "2024-06-15", "is_active": True},
            # U02 findings carry a county but no facility: they are never suppressed.
            {"check_name": "U02_duplicate_tb_case_number", "county_id": 10, "facility_id": None, "valid_from": "2024-05-01", "valid_until": "2024-06-15", "is_active": True},
        ],
    )
    expected = {k: v for k, v in EXPECTED.items() if k not in ("K05", "V08")}
    assert counts(kept_findings(tables, CLOCK, suppressions=requests)) == expected


def finding_rows(spark, rows):
    return spark.createDataFrame(rows, FINDING_DDL)


def test_repeats_collapse_and_idless_findings_stay(spark, monkeypatch):
    monkeypatch.setattr("sieveline.operators.dedup._RUN", 3)
    copy = ("C01", "a", 1, 10, "text", None, "exp", None, None, None)
    other = ("C01", "a", 2, 10, "text", None, "exp", None, None, None)
    idless = ("C01", None, 1, 10, "text", None, "exp", None, None, None)
    unlike = ("C01", None, 1, 10, "other", None, "exp", None, None, None)
    got = collapse_repeats(finding_rows(spark, [other] + [copy] * 50 + [idless] * 8 + [unlike])).collect()
    assert [(r.facility_id, r.copy_no) for r in got if r.record_id == "a"] == [(1, 0)]
    assert sorted(r.copy_no for r in got if r.record_id is None and r.issue_description == "text") == list(range(8))
    assert len(got) == 10


@pytest.mark.parametrize("repeats", [0, 5])
def test_staged_findings_collapse_alike(spark, tmp_path, repeats):
    copy = ("C01", "a", 1, 10, "text", None, "exp", None, None, None)
    rows = [copy, ("C01", "b", 1, 10, "text", None, "exp", None, None, None), ("C02", "a", 1, 10, "text", None, "exp", None, None, None)]
    rows += [("C01", None, 1, 10, t, None, "exp", None, None, None) for t in ("text", "other")]
    rows += [copy, ("C01", "a", 0, 10, "zz", "v", "exp", None, None, None), rows[3]] * repeats
    stored = []

    def stage(df):
        stored.append(str(tmp_path / f"{repeats}-{len(stored)}"))
        df.write.parquet(stored[-1])
        return spark.read.schema(df.schema).parquet(stored[-1])

    findings = finding_rows(spark, rows)
    plain = collapse_repeats(findings)
    got = collapse_staged(stage, findings)
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    if not repeats:
        assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_batch_of_issue_rows(spark):
    def issue(i, status, record, seen):
        return {"issue_id": i, "check_name": "c", "source_table": "t", "record_id": record, "status": status, "detected_at": seen}

    df = frame(
        spark,
        "data_quality_issue",
        [
            issue("1", "open", "a", "2024-01-02 00:00:00"),
            issue("2", "confirmed", "a", "2024-01-01 00:00:00"),
            issue("3", "resolved", "a", "2024-01-01 00:00:00"),
            issue("4", "open", None, "2024-01-01 00:00:00"),
            issue("5", "open", None, "2024-01-01 00:00:00"),
            issue("6", None, "a", "2024-01-01 00:00:00"),
        ],
    )
    assert sorted(r.issue_id for r in drop_repeated_active(df).collect()) == ["2", "3", "4", "5", "6"]


def test_archive_and_cleanup(spark, tmp_path):
    store = Store(spark, str(tmp_path / "dq"))
    base = {"check_name": "c", "source_table": "t", "detected_at": "2023-01-01 00:00:00"}
    rows = [
        {**base, "issue_id": "old", "status": "resolved", "resolved_at": "2023-11-17 05:59:59"},
        {**base, "issue_id": "edge", "status": "resolved", "resolved_at": "2023-11-17 06:00:00"},
        {**base, "issue_id": "waived", "status": "waived", "resolved_at": "2023-01-02 00:00:00"},
        {**base, "issue_id": "open", "status": "open"},
    ]
    store.replace("data_quality_issue", frame(spark, "data_quality_issue", rows))
    assert archive_old_resolved(store, CLOCK) == 1
    assert sorted(r.issue_id for r in store.read("data_quality_issue").collect()) == ["edge", "open", "waived"]
    archived = store.read("data_quality_issue_archive")
    assert archived.columns == store.read("data_quality_issue").columns
    assert [r.issue_id for r in archived.collect()] == ["old"]
    assert archive_old_resolved(store, CLOCK) == 0

    span = {"check_name": "c", "facility_id": 1, "valid_from": "2024-01-01"}
    requests = [
        {**span, "suppression_id": "past", "valid_until": "2024-05-14", "is_active": True},
        {**span, "suppression_id": "today", "valid_until": "2024-05-15", "is_active": True},
        {**span, "suppression_id": "off", "valid_until": "2024-01-02", "is_active": False},
    ]
    store.replace("dq_check_suppression", frame(spark, "dq_check_suppression", requests))
    assert cleanup_expired_suppressions(store, CLOCK) == 1
    active = {r.suppression_id: r.is_active for r in store.read("dq_check_suppression").collect()}
    assert active == {"past": False, "today": True, "off": False}
    assert cleanup_expired_suppressions(store, CLOCK) == 0


def test_unfinished_version_is_ignored(spark, tmp_path):
    store = Store(spark, str(tmp_path / "dq"))
    store.replace("dq_check_suppression", frame(spark, "dq_check_suppression", [{"suppression_id": "a"}]))
    (tmp_path / "dq" / "dq_check_suppression" / "version-000002").mkdir()
    assert [r.suppression_id for r in store.read("dq_check_suppression").collect()] == ["a"]


def test_catalogue():
    assert Counter(c.category for c in CHECKS) == {
        "completeness": 6,
        "validity": 8,
        "consistency": 8,
        "timeliness": 4,
        "uniqueness": 3,
        "referential": 1,
        "plausibility": 6,
    }
    assert Counter(c.severity for c in CHECKS) == {"critical": 8, "high": 19, "medium": 9}


def _case(i, number="N"):
    return {"tb_case_id": i, "case_number": number, "facility_id": 1, "notification_date": "2023-01-01"}


def test_a_stored_run_keeps_all_members_of_a_group(spark, make, clock, tmp_path):
    rows = [_case(f"c{i:05d}") for i in range(1500)] + [_case("x", "M"), _case("y", "M"), _case("z", "L")]
    store = Store(spark, str(tmp_path / "dq"))
    execute_run(store, make(tb_case=rows), clock, run_id="r")
    issues = {r.record_id: r for r in store.read("data_quality_issue").filter("check_name LIKE 'U02%'").collect()}
    assert set(issues) == {"c00000", "x"} and "appears 1500 times" in issues["c00000"].issue_description
    members = store.read("data_quality_issue_member").collect()
    assert sorted(m.record_id for m in members if m.issue_id == issues["c00000"].issue_id) == [f"c{i:05d}" for i in range(1500)]
    assert sorted(m.record_id for m in members if m.issue_id == issues["x"].issue_id) == ["x", "y"]


@pytest.mark.parametrize("stop_after", range(5))
def test_a_run_that_dies_leaves_nothing_and_can_be_repeated(spark, make, clock, tmp_path, monkeypatch, stop_after):
    tables = make(tb_case=[_case("a"), _case("b")], patient=[{"patient_id": "p", "facility_id": 1}])
    calm, store = Store(spark, str(tmp_path / "calm")), Store(spark, str(tmp_path / "dq"))
    execute_run(calm, tables, clock, run_id="r")
    writes = []
    write, publish = Store._write, Store._publish

    def dying(method):
        def call(self, *args):
            if len(writes) == stop_after:
                raise KeyboardInterrupt
            writes.append(args[0])
            return method(self, *args)

        return call

    monkeypatch.setattr(Store, "_write", dying(write))
    monkeypatch.setattr(Store, "_publish", dying(publish))
    with pytest.raises(KeyboardInterrupt):
        execute_run(store, tables, clock, run_id="r")
    monkeypatch.undo()
    assert store.read("data_quality_issue").count() == store.read("dq_engine_run").count() == 0
    for _ in range(2):  # the second time the run is stored already
        execute_run(store, tables, clock, run_id="r")
    for table, ignored in (("data_quality_issue", []), ("data_quality_issue_member", []), ("dq_check_log", ["started_at", "completed_at"]), ("dq_engine_run", ["run_started_at", "run_completed_at"])):
        rows = [sorted(map(str, s.read(table).drop(*ignored).collect())) for s in (calm, store)]
        assert rows[0] == rows[1]
    took = store.read("dq_engine_run").first()
    assert (took.run_completed_at - took.run_started_at).total_seconds() < 600
    store.append("dq_engine_run", store.read("dq_engine_run").limit(0))
    before = store.read("data_quality_issue").count()
    store.vacuum(keep=1)
    assert store.read("data_quality_issue").count() == before


def test_two_writers_on_one_state(spark, make, clock, tmp_path):
    store = Store(spark, str(tmp_path / "dq"))
    first, second = store.begin(), store.begin()
    rows = frame(spark, "dq_check_suppression", [{"suppression_id": "a"}])
    first.append("dq_check_suppression", rows)
    second.append("dq_check_suppression", rows)
    first.publish()
    with pytest.raises(RuntimeError):
        second.publish()
    assert store.read("dq_check_suppression").count() == 1
    assert store.vacuum() == 1
