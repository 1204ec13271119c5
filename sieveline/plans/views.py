"""Four named queries over facilities, issues and the check log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scoring import percent
from sieveline.functions.time import seconds_between


def facility_full(facility: DataFrame, sub_county: DataFrame, county: DataFrame) -> DataFrame:
    """Facilities with their place names; the county is the facility's own."""
    f = facility.select(
        "facility_id",
        "mfl_code",
        "facility_name",
        "facility_type",
        "ownership",
        "is_active",
        "dhis2_org_unit",
        "latitude",
        "longitude",
        F.col("sub_county_id").alias("in_sub_county"),
        F.col("county_id").alias("in_county"),
    )
    return (
        f.join(
            sub_county.select("sub_county_id", "sub_county_name"),
            F.col("in_sub_county") == F.col("sub_county_id"),
            "left",
        )
        .join(county.select("county_id", "county_name", "region"), F.col("in_county") == F.col("county_id"), "left")
        .drop("in_sub_county", "in_county", "sub_county_id")
    )


def dq_summary(issues: DataFrame, facilities: DataFrame) -> DataFrame:
    """Open issues by facility, category and severity.

    Issues combine per facility before the names join on.
    """
    per_facility = (
        issues.filter(F.col("status") == "open")
        .groupBy("facility_id", "check_category", "severity")
        .agg(F.count(F.lit(1)).alias("n"), F.max("detected_at").alias("latest"))
    )
    named = per_facility.join(
        facilities.select("facility_id", "county_name", "facility_name", "mfl_code"), "facility_id"
    )
    return named.groupBy("county_name", "facility_name", "mfl_code", "check_category", "severity").agg(
        F.sum("n").alias("issue_count"), F.max("latest").alias("latest_detection")
    )


def daily_trend(issues: DataFrame) -> DataFrame:
    return (
        issues.groupBy(F.to_date("detected_at").alias("detection_date"), "check_category", "severity")
        .agg(F.count(F.lit(1)).alias("issues_detected"))
        .orderBy(F.desc_nulls_first("detection_date"))
    )


def check_performance(check_log: DataFrame) -> DataFrame:
    """Per check: runs, mean duration, totals and issues per hundred records."""
    seconds = seconds_between(F.col("completed_at"), F.col("started_at"))
    return (
        check_log.groupBy("check_name", "check_category", "severity")
        .agg(
            F.count("log_id").alias("total_runs"),
            F.avg(seconds).alias("avg_duration_secs"),
            F.sum("records_scanned").alias("total_records_scanned"),
            F.sum("issues_raised").alias("total_issues_raised"),
        )
        .withColumn("issue_rate_pct", percent(F.col("total_issues_raised"), F.col("total_records_scanned"), 2))
    )


def register(spark, tables: dict[str, DataFrame]) -> None:
    """Offer the four views to SQL users."""
    full = facility_full(tables["facility"], tables["sub_county"], tables["county"])
    full.createOrReplaceTempView("vw_facility_full")
    dq_summary(tables["data_quality_issue"], full).createOrReplaceTempView("vw_dq_summary")
    daily_trend(tables["data_quality_issue"]).createOrReplaceTempView("vw_dq_daily_trend")
    check_performance(tables["dq_check_log"]).createOrReplaceTempView("vw_check_performance")
