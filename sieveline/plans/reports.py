"""Read-only reports over issues, logs and fact tables.

`facilities` is the facility_full view.  Facts and issues combine to one row per
facility (and whatever else is grouped by) before names join on, so shuffles
carry small integer keys and the join is with an aggregate, not with the facts.
Lists of issues sort by the issue id last: all findings of a run share one
detection time, and the id lets the sort split them over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.scoring import category_rank, percent, ratio, severity_rank, severity_weight
from sieveline.functions.time import Clock, month_start, seconds_between, whole_days
from sieveline.operators.row_rules import stock_balance_wrong, stock_gap

OPEN = "open"


def _is(column: str, value: str) -> Column:
    return F.col(column) == value


def _rows() -> Column:
    return F.count(F.lit(1))


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).alias(column)


# ---- facility management -----------------------------------------------------


def facility_scores(issues: DataFrame, facilities: DataFrame) -> DataFrame:
    """Weighted burden of open issues per facility, heaviest first."""
    severities = ["critical", "high", "medium", "low"]
    per_facility = (
        issues.filter(_is("status", OPEN))
        .groupBy("facility_id")
        .agg(
            *[F.count_if(_is("severity", s)).alias(f"{s}_issues") for s in severities],
            _rows().alias("total_open_issues"),
            F.sum(severity_weight(F.col("severity"))).alias("weighted_dq_score"),
            F.min("detected_at").alias("first_issue_detected"),
            F.max("detected_at").alias("latest_issue_detected"),
        )
    )
    counted = [f"{s}_issues" for s in severities] + ["total_open_issues", "weighted_dq_score"]
    named = (
        facilities.join(per_facility, "facility_id", "left")
        .groupBy("county_name", "facility_name", "mfl_code", "facility_type")
        .agg(
            *[_total(name) for name in counted],
            F.min("first_issue_detected").alias("first_issue_detected"),
            F.max("latest_issue_detected").alias("latest_issue_detected"),
        )
    )
    return named.withColumn(
        "avg_severity_weight", ratio(F.col("weighted_dq_score"), F.col("total_open_issues"), 2)
    ).orderBy(F.desc_nulls_last("weighted_dq_score"))


def category_breakdown(issues: DataFrame) -> DataFrame:
    """Counts and resolution rate by category and severity."""
    grouped = issues.groupBy("check_category", "severity").agg(
        _rows().alias("issue_count"),
        F.count_if(_is("status", OPEN)).alias("open_count"),
        F.count_if(_is("status", "resolved")).alias("resolved_count"),
        F.count_if(_is("status", "false_positive")).alias("false_positive_count"),
        F.countDistinct("facility_id").alias("facilities_affected"),
    )
    return grouped.withColumn("resolution_rate_pct", percent(F.col("resolved_count"), F.col("issue_count"))).orderBy(
        severity_rank(F.col("severity")), category_rank(F.col("check_category"))
    )


def worst_facilities(issues: DataFrame, facilities: DataFrame, clock: Clock) -> DataFrame:
    """The ten facilities with most open critical issues."""
    per_facility = issues.groupBy("facility_id").agg(
        F.count_if(_is("severity", "critical") & _is("status", OPEN)).alias("critical_open"),
        F.count_if(_is("severity", "high") & _is("status", OPEN)).alias("high_open"),
        F.count_if(_is("status", OPEN)).alias("total_open"),
        F.max("detected_at").alias("latest_detection"),
    )
    order = [F.desc("critical_open"), F.desc("high_open"), F.asc("facility_id")]
    top = per_facility.join(facilities, "facility_id").orderBy(*order).limit(10)
    # The rank numbers ten rows.
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        "county_name",
        "facility_name",
        "mfl_code",
        "ownership",
        "facility_type",
        "critical_open",
        "high_open",
        "total_open",
        "latest_detection",
        F.datediff(clock.today, F.to_date("latest_detection")).alias("days_since_last_detection"),
    ).orderBy("rank")


def county_heatmap(issues: DataFrame, facility: DataFrame, county: DataFrame) -> DataFrame:
    """Burden per county over its active facilities.

    The score counts issues of every status, the other figures open ones.
    """
    per_facility = issues.groupBy("facility_id").agg(
        F.count_if(_is("status", OPEN)).alias("open_n"),
        F.count_if(_is("severity", "critical") & _is("status", OPEN)).alias("critical_n"),
        F.sum(severity_weight(F.col("severity"))).alias("burden"),
    )
    active = facility.filter("is_active").select("facility_id", F.col("county_id").alias("in_county"))
    per_county = (
        active.join(per_facility, "facility_id", "left")
        .groupBy("in_county")
        .agg(
            _rows().alias("total_facilities"),
            F.count_if(F.col("open_n") > 0).alias("facilities_with_issues"),
            F.sum("open_n").alias("total_open_issues"),
            F.sum("critical_n").alias("critical_issues"),
            F.sum("burden").alias("county_dq_burden_score"),
        )
    )
    counts = ["total_facilities", "facilities_with_issues", "total_open_issues", "critical_issues"]
    named = county.join(per_county, F.col("county_id") == F.col("in_county"), "left").select(
        "county_id",
        "county_name",
        "region",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in [*counts, "county_dq_burden_score"]],
    )
    return named.withColumn(
        "pct_facilities_affected", percent(F.col("facilities_with_issues"), F.col("total_facilities"))
    ).orderBy(F.desc_nulls_last("county_dq_burden_score"))


def _resolve_days() -> Column:
    return whole_days(F.col("resolved_at"), F.col("detected_at"))


def resolution_rates(issues: DataFrame) -> DataFrame:
    """How each check's issues end."""
    days = F.when(_is("status", "resolved"), _resolve_days())
    grouped = issues.groupBy("check_name", "check_category", "severity").agg(
        _rows().alias("total_issues"),
        F.count_if(_is("status", OPEN)).alias("still_open"),
        F.count_if(_is("status", "resolved")).alias("resolved"),
        F.count_if(_is("status", "false_positive")).alias("false_positives"),
        F.count_if(_is("status", "waived")).alias("waived"),
        F.sum(days).alias("day_sum"),
        F.count(days).alias("day_count"),
    )
    return (
        grouped.withColumn("resolution_rate_pct", percent(F.col("resolved"), F.col("total_issues")))
        .withColumn("false_positive_rate_pct", percent(F.col("false_positives"), F.col("total_issues")))
        .withColumn("avg_days_to_resolve", ratio(F.col("day_sum"), F.col("day_count"), 0).cast("int"))
        .drop("day_sum", "day_count")
        .orderBy(F.desc("total_issues"))
    )


# ---- trends ------------------------------------------------------------------


def detection_trend(issues: DataFrame, clock: Clock) -> DataFrame:
    """Issues per day and category over the last 90 days."""
    return (
        issues.filter(F.col("detected_at") >= clock.days_ago(90))
        .groupBy(F.to_date("detected_at").alias("detection_date"), "check_category")
        .agg(
            _rows().alias("issues_detected"),
            F.count_if(_is("severity", "critical")).alias("critical"),
            F.count_if(_is("severity", "high")).alias("high_severity"),
        )
        .orderBy(F.desc("detection_date"), category_rank(F.col("check_category")))
    )


def monthly_burden(issues: DataFrame, facilities: DataFrame, clock: Clock) -> DataFrame:
    """Issues per month and facility since the month start a year back."""
    since = F.add_months(F.trunc(clock.today, "month"), -12).cast("timestamp")
    per_facility = (
        issues.filter(F.col("detected_at") >= since)
        .groupBy(F.date_format("detected_at", "yyyy-MM").alias("month"), "facility_id")
        .agg(
            _rows().alias("issues_detected"),
            F.count_if(F.col("severity").isin("critical", "high")).alias("high_priority_issues"),
            F.count_if(_is("status", "resolved")).alias("resolved_in_month"),
        )
    )
    names = ["issues_detected", "high_priority_issues", "resolved_in_month"]
    return (
        per_facility.join(facilities.select("facility_id", "county_name", "facility_name"), "facility_id")
        .groupBy("month", "county_name", "facility_name")
        .agg(*[F.sum(name).alias(name) for name in names])
        .orderBy(F.desc("month"), F.desc("issues_detected"))
    )


def time_to_resolve(issues: DataFrame) -> DataFrame:
    """Mean, exact median and range of whole days to resolve, by severity.

    The median is exact: its state is one counter per distinct number of days,
    which the calendar bounds.
    """
    days = F.when(_is("status", "resolved"), _resolve_days())
    return (
        issues.groupBy("severity")
        .agg(
            F.count_if(_is("status", "resolved")).alias("resolved_count"),
            F.sum(days).alias("day_sum"),
            F.count(days).alias("day_count"),
            F.percentile(days, 0.5).alias("median"),
            F.min(days).alias("min_days"),
            F.max(days).alias("max_days"),
        )
        .select(
            "severity",
            "resolved_count",
            ratio(F.col("day_sum"), F.col("day_count"), 1).alias("avg_days_to_resolve"),
            F.round(F.col("median").cast("decimal(20,2)"), 1).alias("median_days_to_resolve"),
            "min_days",
            "max_days",
        )
        .orderBy(severity_rank(F.col("severity")))
    )


def run_history(runs: DataFrame) -> DataFrame:
    """The last twenty runs with their pace."""
    seconds = seconds_between(F.col("run_completed_at"), F.col("run_started_at"))
    checks = F.col("checks_executed").cast("decimal(10,0)")
    return (
        runs.orderBy(F.desc_nulls_first("run_started_at"))
        .limit(20)
        .select(
            "run_id",
            "run_started_at",
            "run_completed_at",
            F.round(seconds, 2).alias("duration_secs"),
            "triggered_by",
            "checks_executed",
            "issues_found",
            F.round(checks / F.nullif(seconds, F.lit(0)), 2).alias("checks_per_second"),
            ratio(F.col("issues_found"), F.col("checks_executed"), 2).alias("avg_issues_per_check"),
        )
    )


# ---- domain reports ----------------------------------------------------------


def treatment_scorecard(
    enrollments: DataFrame, issues: DataFrame, facilities: DataFrame, corrected: bool = False
) -> DataFrame:
    """Missing start weights and overdue patients per facility.

    Enrolments are counted once per overdue patient of their facility, as a join
    of both lists does; `corrected=True` counts each once.  Either way both
    sides are aggregated first and nothing is multiplied out.
    """
    enrolled = enrollments.groupBy("facility_id").agg(
        F.count("enrollment_id").alias("enrolled"),
        F.count_if(F.col("weight_at_start").isNull() & F.col("enrollment_id").isNotNull()).alias("unweighed"),
    )
    overdue = (
        issues.filter(
            _is("check_name", "T04_art_patient_overdue")
            & _is("source_table", "art_visit")
            & _is("status", OPEN)
            & F.col("record_id").isNotNull()
        )
        .groupBy("facility_id")
        .agg(F.countDistinct("record_id").alias("overdue"))
    )
    times = F.lit(1) if corrected else F.greatest(F.coalesce("overdue", F.lit(0)), F.lit(1))
    per_name = (
        facilities.join(enrolled, "facility_id")
        .join(overdue, "facility_id", "left")
        .groupBy("county_name", "facility_name", "mfl_code")
        .agg(
            F.sum(F.col("enrolled") * times).alias("total_enrollments"),
            F.sum(F.col("unweighed") * times).alias("missing_weight_count"),
            _total("overdue").alias("overdue_patients"),
        )
        .filter(F.col("total_enrollments") > 0)
    )
    return per_name.withColumn(
        "pct_missing_weight", percent(F.col("missing_weight_count"), F.col("total_enrollments"))
    ).orderBy(F.desc_nulls_first("pct_missing_weight"))


def _sum_by_name(per_facility: DataFrame, facilities: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Attach place names to per-facility sums and add up equal names."""
    named = per_facility.join(facilities.select("facility_id", "county_name", "facility_name"), "facility_id")
    return named.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names])


def notification_delays(tb_cases: DataFrame, facilities: DataFrame) -> DataFrame:
    """Days from diagnosis to notification in bands."""
    delay = F.datediff("notification_date", "diagnosis_date")
    known = F.col("diagnosis_date").isNotNull()
    per_facility = tb_cases.groupBy("facility_id").agg(
        _rows().alias("total_tb_cases"),
        F.count_if(~known).alias("missing_diagnosis_date"),
        F.count_if(delay <= 14).alias("notified_le_14_days"),
        F.count_if(delay.between(15, 56)).alias("notified_15_56_days"),
        F.count_if(delay > 56).alias("notified_gt_56_days"),
        F.sum(delay).alias("delay_sum"),
        F.count(delay).alias("delay_count"),
        F.count_if(known).alias("diagnosed"),
    )
    sums = [name for name in per_facility.columns if name != "facility_id"]
    return (
        _sum_by_name(per_facility, facilities, ["county_name", "facility_name"], sums)
        .withColumn("avg_notification_delay_days", ratio(F.col("delay_sum"), F.col("delay_count"), 1))
        .withColumn("pct_notified_within_14_days", percent(F.col("notified_le_14_days"), F.col("diagnosed")))
        .drop("delay_sum", "delay_count", "diagnosed")
        .orderBy(F.desc_nulls_last("avg_notification_delay_days"))
    )


def suppression_labels(viral_loads: DataFrame, facilities: DataFrame) -> DataFrame:
    """Results whose suppression label contradicts them, by laboratory and county."""
    high = F.col("vl_result") >= 1000
    per_facility = viral_loads.groupBy("facility_id", "lab_name").agg(
        _rows().alias("total_vl_results"),
        F.count_if(_is("vl_category", "suppressed") & high).alias("mislabeled_suppressed"),
        F.count_if(
            _is("vl_category", "unsuppressed") & ((F.col("vl_result") < 1000) | F.col("is_ldl"))
        ).alias("mislabeled_unsuppressed"),
        F.count_if(F.col("vl_result").isNull() & (F.col("is_ldl") == F.lit(False))).alias("missing_result_not_ldl"),
    )
    sums = [name for name in per_facility.columns if name not in ("facility_id", "lab_name")]
    return (
        _sum_by_name(per_facility, facilities, ["lab_name", "county_name"], sums)
        .withColumn("mislabel_rate_pct", percent(F.col("mislabeled_suppressed"), F.col("total_vl_results"), 2))
        .orderBy(F.desc("mislabeled_suppressed"))
    )


def visit_completeness(anc_visits: DataFrame, facilities: DataFrame) -> DataFrame:
    """Which key fields antenatal visits fill, by visit number and county.

    "Fully complete" asks for the systolic pressure only, "has_bp" for both.
    """
    aged = F.col("gestational_age_wks").isNotNull()
    systolic = F.col("systolic_bp").isNotNull()
    tested = F.col("hiv_test_done")
    weighed = F.col("weight_kg").isNotNull()
    per_facility = anc_visits.groupBy("facility_id", "anc_visit_number").agg(
        _rows().alias("total_visits"),
        F.count_if(aged).alias("has_gestational_age"),
        F.count_if(systolic & F.col("diastolic_bp").isNotNull()).alias("has_bp"),
        F.count_if(tested).alias("hiv_test_done"),
        F.count_if(weighed).alias("has_weight"),
        F.count_if(aged & systolic & tested & weighed).alias("fully_complete"),
    )
    sums = [name for name in per_facility.columns if name not in ("facility_id", "anc_visit_number")]
    return (
        _sum_by_name(per_facility, facilities, ["anc_visit_number", "county_name"], sums)
        .withColumn("completeness_pct", percent(F.col("fully_complete"), F.col("total_visits")))
        .orderBy(F.asc_nulls_last("anc_visit_number"), F.asc_nulls_last("county_name"))
    )


def stock_errors(stock: DataFrame, commodity: DataFrame, facilities: DataFrame) -> DataFrame:
    """Balance errors by commodity and facility."""
    per_key = stock.groupBy("facility_id", "commodity_id").agg(
        F.count("stock_id").alias("total_records"),
        F.count_if(stock_balance_wrong() & F.col("stock_id").isNotNull()).alias("balance_error_count"),
        F.max(F.when(F.col("closing_balance").isNotNull(), stock_gap())).alias("max_discrepancy"),
    )
    named = (
        per_key.join(commodity.select("commodity_id", "commodity_name", "category"), "commodity_id")
        .join(facilities.select("facility_id", "county_name", "facility_name"), "facility_id")
        .groupBy("commodity_name", "category", "county_name", "facility_name")
        .agg(
            F.sum("total_records").alias("total_records"),
            F.sum("balance_error_count").alias("balance_error_count"),
            F.max("max_discrepancy").alias("max_discrepancy"),
        )
        .filter(F.col("total_records") > 0)
    )
    # Most pairs have no error; the names after that tell them apart, so that the sort deals them over all its tasks.
    return named.withColumn("error_rate_pct", percent(F.col("balance_error_count"), F.col("total_records"))).orderBy(
        F.desc("balance_error_count"),
        F.desc_nulls_first("error_rate_pct"),
        "commodity_name",
        "facility_name",
        "category",
        "county_name",
    )


def late_reporting(reports: DataFrame, facilities: DataFrame) -> DataFrame:
    """Late monthly submissions per county, 60 days from the next month's first day."""
    next_month = F.add_months(month_start(F.col("period_year"), F.coalesce("period_month", F.lit(3))), 1)
    late = F.col("submission_date") > F.date_add(next_month, 60).cast("timestamp")
    days = whole_days(F.col("submission_date"), next_month.cast("timestamp"))
    per_facility = (
        reports.filter(_is("period_type", "monthly") & F.col("submission_date").isNotNull())
        .groupBy("facility_id")
        .agg(
            F.count("report_id").alias("total_reports"),
            F.count_if(late & F.col("report_id").isNotNull()).alias("late_reports"),
            F.sum(days).alias("day_sum"),
            F.count(days).alias("day_count"),
        )
        .withColumn("reporting_facilities", F.lit(1))
    )
    sums = [name for name in per_facility.columns if name != "facility_id"]
    return (
        _sum_by_name(per_facility, facilities, ["county_name"], sums)
        .withColumn("late_submission_rate_pct", percent(F.col("late_reports"), F.col("total_reports")))
        .withColumn("avg_days_after_period_end", ratio(F.col("day_sum"), F.col("day_count"), 1))
        .drop("day_sum", "day_count")
        .orderBy(F.desc_nulls_first("late_submission_rate_pct"))
    )


# ---- triage ------------------------------------------------------------------


def _age(clock: Clock, column: str) -> Column:
    return F.datediff(clock.today, F.to_date(column))


def critical_actions(issues: DataFrame, facilities: DataFrame, clock: Clock) -> DataFrame:
    """Every open critical issue, of any run."""
    names = facilities.select("facility_id", "county_name", "facility_name", "mfl_code")
    return (
        issues.filter(_is("severity", "critical") & _is("status", OPEN))
        .join(names, "facility_id")
        .select(
            "issue_id",
            "check_name",
            "check_category",
            "county_name",
            "facility_name",
            "mfl_code",
            "source_table",
            "source_column",
            "record_id",
            "issue_description",
            "raw_value",
            "expected_value",
            "data_source",
            "period_year",
            "period_month",
            "detected_at",
            _age(clock, "detected_at").alias("days_open"),
        )
        .orderBy(F.desc_nulls_first("detected_at"), "issue_id")
    )


def by_channel(issues: DataFrame) -> DataFrame:
    """Open issues by data source."""
    categories = ["completeness", "validity", "consistency", "timeliness"]
    return (
        issues.filter(_is("status", OPEN))
        .groupBy("data_source")
        .agg(
            _rows().alias("total_issues"),
            F.count_if(_is("severity", "critical")).alias("critical"),
            F.count_if(_is("severity", "high")).alias("high_severity"),
            *[F.count_if(_is("check_category", c)).alias(f"{c}_issues") for c in categories],
            F.countDistinct("facility_id").alias("facilities_affected"),
        )
        .withColumn("high_priority_pct", percent(F.col("critical") + F.col("high_severity"), F.col("total_issues")))
        .orderBy(F.desc("total_issues"))
    )


def clean_facilities(
    issues: DataFrame, facilities: DataFrame, patients: DataFrame, enrollments: DataFrame, tb_cases: DataFrame
) -> DataFrame:
    """Active facilities without an open issue, with their data volume."""
    flagged = issues.filter(_is("status", OPEN) & F.col("facility_id").isNotNull()).select("facility_id").distinct()
    clean = facilities.filter("is_active").join(flagged, "facility_id", "left_anti")
    volumes = [("patient_count", patients), ("art_enrollment_count", enrollments), ("tb_case_count", tb_cases)]
    for name, facts in volumes:
        clean = clean.join(facts.groupBy("facility_id").agg(_rows().alias(name)), "facility_id", "left")
    return clean.select(
        "county_name",
        "facility_name",
        "mfl_code",
        "facility_type",
        "ownership",
        *[F.coalesce(name, F.lit(0)).alias(name) for name, _ in volumes],
    ).orderBy(F.asc_nulls_last("county_name"), "facility_name")


def stale_issues(issues: DataFrame, facilities: DataFrame, clock: Clock, days: int = 30) -> DataFrame:
    """Open issues detected more than `days` ago."""
    names = facilities.select("facility_id", "county_name", "facility_name")
    return (
        issues.filter(_is("status", OPEN) & (F.col("detected_at") < clock.days_ago(days)))
        .join(names, "facility_id")
        .select(
            "issue_id",
            "check_name",
            "severity",
            "county_name",
            "facility_name",
            "source_table",
            "issue_description",
            "detected_at",
            _age(clock, "detected_at").alias("days_open"),
            "updated_at",
            _age(clock, "updated_at").alias("days_since_update"),
        )
        .orderBy(F.desc_nulls_first("days_open"), "issue_id")
    )


def false_positive_rates(issues: DataFrame) -> DataFrame:
    """False positives of checks with at least five issues."""
    grouped = (
        issues.groupBy("check_name", "check_category", "severity")
        .agg(
            _rows().alias("total_issues"),
            F.count_if(_is("status", "false_positive")).alias("false_positive_count"),
            F.count_if(_is("status", "resolved")).alias("resolved_count"),
            F.count_if(_is("status", OPEN)).alias("still_open"),
        )
        .filter(F.col("total_issues") >= 5)
    )
    return (
        grouped.withColumn("false_positive_rate_pct", percent(F.col("false_positive_count"), F.col("total_issues")))
        .withColumn(
            "recommendation",
            F.when(F.col("false_positive_count") * 5 > F.col("total_issues"), "REVIEW CHECK LOGIC").otherwise("OK"),
        )
        .orderBy(F.desc("false_positive_rate_pct"))
    )


def full_export(issues: DataFrame, facilities: DataFrame, clock: Clock) -> DataFrame:
    """Every issue with its place, for spreadsheets; issues without a facility stay."""
    places = facilities.select(
        F.col("facility_id").alias("at_facility"),
        F.col("county_id").alias("at_county"),
        "county_name",
        "region",
        "facility_name",
        "mfl_code",
        "facility_type",
        "ownership",
    )
    return (
        issues.join(places, F.col("facility_id") == F.col("at_facility"), "left")
        .select(
            "issue_id",
            "check_run_id",
            "detected_at",
            "check_name",
            "check_category",
            "severity",
            "status",
            F.col("at_county").alias("county_id"),
            "county_name",
            "region",
            F.col("at_facility").alias("facility_id"),
            "facility_name",
            "mfl_code",
            "facility_type",
            "ownership",
            "source_table",
            "source_column",
            "record_id",
            "issue_description",
            "raw_value",
            "expected_value",
            "data_source",
            "period_year",
            "period_month",
            "resolved_by",
            "resolved_at",
            "resolution_notes",
            _age(clock, "detected_at").alias("days_open"),
            severity_weight(F.col("severity")).alias("severity_weight"),
        )
        .orderBy(severity_rank(F.col("severity")), F.desc_nulls_first("detected_at"), "issue_id")
    )


def open_issues(
    issues: DataFrame,
    clock: Clock,
    facility_id: int | None = None,
    severity: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """Open issues of a facility, most severe and newest first.

    Without a facility the list covers all of them and names each row's facility.
    """
    found = issues.filter(_is("status", OPEN))
    if facility_id is not None:
        found = found.filter(F.col("facility_id") == facility_id)
    if severity is not None:
        found = found.filter(_is("severity", severity))
    if category is not None:
        found = found.filter(_is("check_category", category))
    return found.orderBy(severity_rank(F.col("severity")), F.desc_nulls_first("detected_at"), "issue_id").select(
        *(["facility_id"] if facility_id is None else []),
        "issue_id",
        "check_name",
        "check_category",
        "severity",
        "source_table",
        "source_column",
        "record_id",
        "issue_description",
        "raw_value",
        "expected_value",
        "detected_at",
        _age(clock, "detected_at").alias("days_open"),
    )


def dq_scores(issues: DataFrame, facility: DataFrame, facility_id: int | None = None) -> DataFrame:
    """The burden score of every facility (or of one); 0 without open issues."""
    found = issues.filter(_is("status", OPEN))
    places = facility.select("facility_id")
    if facility_id is not None:
        found = found.filter(F.col("facility_id") == facility_id)
        places = places.filter(F.col("facility_id") == facility_id)
    scores = found.groupBy("facility_id").agg(F.sum(severity_weight(F.col("severity"))).alias("dq_score"))
    return places.join(scores, "facility_id", "left").select(
        "facility_id", F.coalesce("dq_score", F.lit(0)).alias("dq_score")
    )
