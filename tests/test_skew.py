"""One key holding most rows: results stay whole."""

import pandas as pd
from conftest import CLOCK, frame
from pyspark.sql import functions as F

from sieveline.operators import lifecycle
from sieveline.operators.dedup import collapse_repeats
from sieveline.operators.fused_scan import patient_findings
from sieveline.plans.run import one_check
from sieveline.sources.landing import conform

N = 60_000


def test_placeholder_birth_date(spark, make):
    """All patients share facility, sex and birth date; three enrolment days, 20 days apart."""
    people = spark.range(N).selectExpr(
        "lpad(cast(id AS string), 8, '0') AS patient_id",
        "1 AS facility_id",
        "'female' AS sex",
        "DATE '1900-01-01' AS date_of_birth",
        "DATE '2024-01-01' + cast(20 * (id % 3) AS int) AS date_enrolled",
    )
    tables = {"facility": make()["facility"], "patient": conform(people, "patient", CLOCK)}
    found = one_check(tables, "U01", CLOCK)
    assert found.count() == N - 3
    assert found.filter("raw_value NOT LIKE 'pid_a=0000000%'").count() == 0


def test_periods_without_a_month(spark, make):
    """Yearly reports of one facility: a join of all tests with all positives would be N * N / 4."""
    reports = spark.range(N).selectExpr(
        "lpad(cast(id AS string), 8, '0') AS report_id",
        "1 AS facility_id",
        "'annual' AS period_type",
        "2023 AS period_year",
        "IF(id % 2 = 0, 'HTS_TST', 'HTS_TST_POS') AS indicator_code",
        "cast(10 + id % 1000 AS decimal(10,2)) AS value",
    )
    tables = {"facility": make()["facility"], "aggregate_report": conform(reports, "aggregate_report", CLOCK)}
    found = one_check(tables, "K06", CLOCK)
    assert found.count() == N // 2
    assert found.select("expected_value").distinct().collect()[0][0] == "≤ HTS_TST (10.00)"
    assert one_check(tables, "U03", CLOCK).count() == 2


def test_one_series_in_one_month(spark, make):
    reports = spark.range(20_000).selectExpr(
        "md5(cast(id AS string)) AS report_id",
        "1 AS facility_id",
        "'monthly' AS period_type",
        "2023 AS period_year",
        "1 + cast(id % 2 AS int) AS period_month",
        "'TX_CURR' AS indicator_code",
        "cast(1 + pmod(hash(id), 50) AS decimal(10,2)) AS value",
    )
    series = reports.select("report_id", "period_month", F.col("value").cast("double")).toPandas()
    series = series.sort_values(["period_month", "report_id"]).reset_index(drop=True)
    expected = set(series.report_id[series.value > 2 * series.value.shift()])
    tables = {"facility": make()["facility"], "aggregate_report": conform(reports, "aggregate_report", CLOCK)}
    found = one_check(tables, "P03", CLOCK).select("record_id").toPandas()
    assert isinstance(found, pd.DataFrame) and set(found.record_id) == expected


def test_a_record_landed_many_times(spark, make):
    people = spark.range(N).selectExpr(
        "IF(id % 3 = 0, cast(id AS string), 'copy') AS patient_id",
        "1 AS facility_id",
        "cast(NULL AS date) AS date_of_birth",
        "DATE '2024-01-01' AS date_enrolled",
    )
    tables = {"facility": make()["facility"], "patient": conform(people, "patient", CLOCK)}
    assert one_check(tables, "C01", CLOCK).count() == N // 3 + 1


def test_a_patient_with_most_visits(spark, make):
    visits = spark.range(N).selectExpr(
        "cast(id AS string) AS anc_visit_id",
        "IF(id % 3 = 0, 'hot', concat('p', id)) AS patient_id",
        "1 AS facility_id",
        "DATE '2024-01-01' AS visit_date",
    )
    people = [{"patient_id": p, "facility_id": 1, "sex": "male", "date_enrolled": "2020-01-01"} for p in ("hot", "p1")]
    tables = {
        "facility": make()["facility"],
        "patient": frame(spark, "patient", people),
        "anc_visit": conform(visits, "anc_visit", CLOCK),
    }
    assert collapse_repeats(patient_findings(tables, "anc_visit", CLOCK)).count() == N // 3 + 1


def test_most_actions_on_one_issue(spark, monkeypatch):
    """Alternate resolving and reopening one issue, in many blocks."""
    monkeypatch.setattr(lifecycle, "_BLOCK", 500)
    registry = frame(spark, "data_quality_issue", [{"issue_id": "a", "check_name": "c", "status": "open"}])
    actions = spark.range(20_001).selectExpr(
        "id AS action_seq", "'a' AS issue_id", "IF(id % 2 = 0, 'resolve', 'reopen') AS action", "'me' AS actor", "'n' AS note"
    )
    outcome = lifecycle.apply_actions(registry, CLOCK, actions)
    assert outcome.registry.first().status == "resolved"
    assert outcome.messages.filter("message NOT LIKE 'OK:%'").count() == 0
    assert outcome.messages.count() == 20_001
