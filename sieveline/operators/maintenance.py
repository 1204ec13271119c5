"""Housekeeping jobs over the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.time import Clock, seconds_between
from sieveline.sources.store import Store


def expired(clock: Clock) -> Column:
    return (F.col("valid_until") < clock.today) & F.col("is_active")


def cleanup_suppressions(suppressions: DataFrame, clock: Clock) -> DataFrame:
    """Deactivate requests whose last day has passed."""
    return suppressions.withColumn(
        "is_active", F.when(expired(clock), F.lit(False)).otherwise(F.col("is_active"))
    )


def to_archive(clock: Clock, days: int = 180) -> Column:
    """Resolved (not waived or false-positive) longer than `days` ago."""
    return (F.col("status") == "resolved") & (F.col("resolved_at") < clock.days_ago(days))


def split_archive(issues: DataFrame, clock: Clock, days: int = 180) -> tuple[DataFrame, DataFrame]:
    """(issues that stay, issues that move)."""
    moves = F.coalesce(to_archive(clock, days), F.lit(False))
    return issues.filter(~moves), issues.filter(moves)


def archive_old_resolved(store: Store, clock: Clock, days: int = 180) -> int:
    """Move old resolved issues to the archive and count them.

    Only resolved issues are read and rewritten, and archive and live table
    change together.
    """
    commit = store.begin()
    resolved = store.read("data_quality_issue").filter("status = 'resolved'")
    stay, move = split_archive(resolved, clock, days)
    written = store.read_parts("data_quality_issue_archive", commit.append("data_quality_issue_archive", move))
    moved = written.count()
    if moved:
        commit.replace("data_quality_issue", stay, only=["resolved"])
        commit.publish()
    return moved


def cleanup_expired_suppressions(store: Store, clock: Clock) -> int:
    current = store.read("dq_check_suppression")
    ended = current.filter(expired(clock)).count()
    if ended:
        store.replace("dq_check_suppression", cleanup_suppressions(current, clock))
    return ended


def stale_issue_alert(issues: DataFrame, facilities: DataFrame, clock: Clock, days: int = 30) -> DataFrame:
    """Facilities with issues open longer than `days` days."""
    per_facility = (
        issues.filter((F.col("status") == "open") & (F.col("detected_at") < clock.days_ago(days)))
        .groupBy("facility_id")
        .agg(
            F.count("issue_id").alias("stale_count"),
            F.max(F.datediff(clock.today, F.to_date("detected_at"))).alias("oldest_issue_days"),
        )
    )
    names = facilities.select("facility_id", "county_name", "facility_name", "mfl_code")
    return (
        per_facility.join(names, "facility_id")
        .groupBy("county_name", "facility_name", "mfl_code")
        .agg(F.sum("stale_count").alias("stale_count"), F.max("oldest_issue_days").alias("oldest_issue_days"))
        .orderBy(F.desc("stale_count"))
    )


def engine_health(issues: DataFrame, runs: DataFrame, suppressions: DataFrame, clock: Clock) -> DataFrame:
    """Nine key figures as (metric, value) text rows: one aggregate per table."""
    is_open = F.col("status") == "open"
    critical = is_open & (F.col("severity") == "critical")
    last = F.max(
        F.struct("run_started_at", F.struct("run_completed_at", "run_started_at", "issues_found").alias("run"))
    ).getField("run")
    run_row = runs.agg(last.alias("r"), F.count(F.lit(1)).alias("total_runs"))
    issue_row = issues.agg(
        F.count_if(is_open).alias("total_open_issues"),
        F.count_if(critical).alias("total_critical_open"),
        F.countDistinct(F.when(critical, F.col("facility_id"))).alias("facilities_with_critical_issues"),
        F.count_if((F.col("status") == "resolved") & (F.col("resolved_at") >= clock.days_ago(30))).alias(
            "issues_resolved_last_30_days"
        ),
    )
    suppression_row = suppressions.agg(F.count_if(F.col("is_active")).alias("active_suppressions"))

    def text_rows(row: DataFrame, values: dict[str, Column]) -> DataFrame:
        pairs = [F.struct(F.lit(k).alias("metric"), v.cast("string").alias("value")) for k, v in values.items()]
        return row.select(F.inline(F.array(*pairs)))

    duration = F.round(seconds_between(F.col("r.run_completed_at"), F.col("r.run_started_at")), 2)
    runs_part = text_rows(
        run_row,
        {
            "last_run_at": F.date_format("r.run_completed_at", "yyyy-MM-dd HH:mm:ssx"),
            "last_run_duration_secs": duration,
            "last_run_issues_found": F.col("r.issues_found"),
            "total_runs": F.col("total_runs"),
        },
    )
    issues_part = text_rows(issue_row, {name: F.col(name) for name in issue_row.columns})
    suppression_part = text_rows(suppression_row, {"active_suppressions": F.col("active_suppressions")})
    return runs_part.unionByName(issues_part).unionByName(suppression_part)
