from conftest import CLOCK, frame

from sieveline.plans import reports, views


def issues(spark, rows):
    base = {
        "check_name": "C01_patient_missing_dob",
        "check_category": "completeness",
        "severity": "high",
        "source_table": "patient",
        "status": "open",
        "facility_id": 1,
        "detected_at": "2024-05-01 08:00:00",
    }
    return frame(spark, "data_quality_issue", [{**base, "issue_id": str(i), **row} for i, row in enumerate(rows)])


def places(make):
    tables = make()
    return views.facility_full(tables["facility"], tables["sub_county"], tables["county"])


def test_scores_include_clean_facilities(spark, make):
    df = issues(spark, [{"severity": s} for s in ("critical", "high", "medium", "low", "info")] + [{"status": "waived"}])
    rows = {r.mfl_code: r for r in reports.facility_scores(df, places(make)).collect()}
    assert list(rows)[0] == "M1"
    assert (rows["M1"].weighted_dq_score, rows["M1"].total_open_issues, float(rows["M1"].avg_severity_weight)) == (18, 5, 3.6)
    assert rows["M2"].weighted_dq_score == 0 and rows["M2"].avg_severity_weight is None
    assert rows["M2"].first_issue_detected is None


def test_breakdown_order_is_by_severity_then_declared_category(spark):
    df = issues(
        spark,
        [
            {"severity": "medium", "check_category": "completeness"},
            {"severity": "high", "check_category": "timeliness"},
            {"severity": "high", "check_category": "consistency"},
            {"severity": "critical", "check_category": "plausibility"},
            {"severity": "high", "check_category": "validity"},
        ],
    )
    got = [(r.severity, r.check_category) for r in reports.category_breakdown(df).collect()]
    assert got == [
        ("critical", "plausibility"),
        ("high", "validity"),
        ("high", "consistency"),
        ("high", "timeliness"),
        ("medium", "completeness"),
    ]


def test_time_to_resolve(spark):
    def closed(at, status="resolved"):
        return {"status": status, "resolved_at": at}

    df = issues(
        spark,
        [
            closed("2024-05-02 07:59:59"),  # under 24 hours: 0 whole days
            closed("2024-05-02 08:00:00"),
            closed("2024-05-05 09:00:00"),
            closed("2024-05-11 08:00:00"),
            closed("2024-06-11 08:00:00", "waived"),
            {"severity": "low"},
        ],
    )
    rows = {r.severity: r for r in reports.time_to_resolve(df).collect()}
    high = rows["high"]
    assert (high.resolved_count, float(high.avg_days_to_resolve), float(high.median_days_to_resolve)) == (4, 3.8, 2.5)
    assert (high.min_days, high.max_days) == (0, 10)
    assert rows["low"].resolved_count == 0 and rows["low"].median_days_to_resolve is None


def test_scorecard_repeats_enrolments_per_overdue_patient_unless_corrected(spark, make):
    overdue = {"check_name": "T04_art_patient_overdue", "source_table": "art_visit"}
    df = issues(spark, [{**overdue, "record_id": r} for r in ("a", "b", "b", "c")])
    start = {"patient_id": "p", "facility_id": 1, "art_start_date": "2020-01-01"}
    enrolled = frame(
        spark,
        "art_enrollment",
        [{**start, "enrollment_id": "1"}, {**start, "enrollment_id": "2", "weight_at_start": 50}, {**start, "enrollment_id": "3", "facility_id": 2}],
    )
    rows = {r.mfl_code: r for r in reports.treatment_scorecard(enrolled, df, places(make)).collect()}
    assert (rows["M1"].total_enrollments, rows["M1"].missing_weight_count, rows["M1"].overdue_patients) == (6, 3, 3)
    assert float(rows["M1"].pct_missing_weight) == 50.0
    assert (rows["M2"].total_enrollments, rows["M2"].overdue_patients) == (1, 0) and "M3" not in rows
    fixed = {r.mfl_code: r for r in reports.treatment_scorecard(enrolled, df, places(make), corrected=True).collect()}
    assert (fixed["M1"].total_enrollments, fixed["M1"].overdue_patients) == (2, 3)


def test_late_reporting_counts_from_the_next_month(spark, make):
    base = {"facility_id": 1, "period_type": "monthly", "period_year": 2023, "period_month": 2, "indicator_code": "X"}
    df = frame(
        spark,
        "aggregate_report",
        [
            {**base, "report_id": "a", "submission_date": "2023-04-29 12:00:00"},  # late for T02, not here
            {**base, "report_id": "b", "submission_date": "2023-04-30 00:00:01"},
            {**base, "report_id": "c", "submission_date": None},
        ],
    )
    row = reports.late_reporting(df, places(make)).first()
    assert (row.total_reports, row.late_reports, row.reporting_facilities) == (2, 1, 1)
    assert float(row.avg_days_after_period_end) == 59.5


def test_open_issues_filters_and_order(spark):
    df = issues(
        spark,
        [
            {"severity": "medium"},
            {"severity": "critical", "detected_at": "2024-05-01 00:00:00"},
            {"severity": "critical", "detected_at": "2024-05-10 00:00:00"},
            {"facility_id": 2},
            {"status": "confirmed"},
        ],
    )
    got = reports.open_issues(df, CLOCK, facility_id=1).collect()
    assert [r.issue_id for r in got] == ["2", "1", "0"] and got[0].days_open == 5
    assert [r.issue_id for r in reports.open_issues(df, CLOCK, 1, severity="medium").collect()] == ["0"]
    assert reports.open_issues(df, CLOCK, 1, category="validity").count() == 0
    assert reports.dq_scores(df, frame(spark, "facility", [{"facility_id": 1}, {"facility_id": 9}])).collect()[0].dq_score == 22


def test_placeless_issues_leave_joined_reports_but_not_the_export(spark, make):
    df = issues(spark, [{"facility_id": None, "severity": "critical"}, {"severity": "critical"}])
    assert reports.critical_actions(df, places(make), CLOCK).count() == 1
    export = reports.full_export(df, places(make), CLOCK)
    assert export.count() == 2 and export.filter("facility_id IS NULL AND severity_weight = 10").count() == 1


def test_views_for_sql_users(spark, make):
    tables = make(data_quality_issue=[], dq_check_log=[])
    views.register(spark, tables)
    assert spark.sql("SELECT * FROM vw_facility_full").count() == 3
    assert spark.sql("SELECT * FROM vw_dq_summary").count() == 0


def test_stock_pairs_without_errors_are_dealt_over_the_sort(spark, make):
    stock = [
        {"stock_id": str(i), "facility_id": 1 + i // 200, "commodity_id": i * 37 % 200, "opening_balance": 1, "closing_balance": 1,
         "received_qty": 0, "dispensed_qty": 0, "losses_adjustments": 0}
        for i in range(400)
    ]
    named = [{"commodity_id": i, "commodity_name": f"item {i:03d}", "category": "c"} for i in range(200)]
    tables = make(stock_record=stock, commodity=named)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = reports.stock_errors(tables["stock_record"], tables["commodity"], places(make))
        parts = rows.rdd.map(lambda r: (r.commodity_name, r.facility_name)).glom().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = [name for part in parts for name in part]
    assert len(names) == 400 and names == sorted(names)
    assert max(map(len, parts)) < 200
