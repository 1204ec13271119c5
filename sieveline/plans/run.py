"""A complete run of the checks."""

from __future__ import annotations

import uuid
from collections import ChainMap
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.text import uuid_text
from sieveline.functions.time import Clock
from sieveline.operators.dedup import collapse_repeats, collapse_staged, describe_checks, without_active
from sieveline.operators.fixed_values import BY_ID
from sieveline.operators.fused_scan import row_scans
from sieveline.operators.scan_counts import scan_counts
from sieveline.operators.set_rules import SET_RULES, SUMMARY, duplicate_case_members, report_summary
from sieveline.operators.suppression import without_suppressed
from sieveline.sources.schemas import SCHEMAS
from sieveline.sources.store import Store

#: Tables a run reads.
RUN_TABLES = [
    "facility",
    "patient",
    "art_enrollment",
    "viral_load",
    "art_visit",
    "tb_case",
    "anc_visit",
    "delivery",
    "chw",
    "chw_service_record",
    "aggregate_report",
    "stock_record",
]


@dataclass
class RunResult:
    """Lazy results of one run."""

    issues: DataFrame
    check_log: DataFrame
    run: DataFrame


def raise_findings(tables: dict[str, DataFrame], clock: Clock, only: set[str] | None = None) -> DataFrame:
    """Every finding of the chosen checks (all by default), repeats included."""
    parts = [builder(tables, table, clock, only) for builder, table in row_scans(only)]
    parts += [build(tables, clock) for check_id, build in SET_RULES.items() if only is None or check_id in only]
    return reduce(DataFrame.unionByName, parts)


def kept_findings(
    tables: dict[str, DataFrame],
    clock: Clock,
    registry: DataFrame | None = None,
    suppressions: DataFrame | None = None,
    only: set[str] | None = None,
) -> DataFrame:
    """Findings that become issues: one per check and record, none already active.

    Suppression requests are recorded but not applied unless they are given here.
    """
    kept = describe_checks(collapse_repeats(raise_findings(tables, clock, only)))
    if suppressions is not None:
        kept = without_suppressed(kept, suppressions, tables["facility"], clock)
    if registry is not None:
        kept = without_active(kept, registry)
    return kept


def as_issues(kept: DataFrame, run_id: str, clock: Clock) -> DataFrame:
    """Complete registry rows.  Ids derive from the content, so a recomputed task
    writes the same ids."""
    nothing = F.lit(None)
    values = {
        "issue_id": uuid_text(
            F.lit(run_id),
            F.col("check_name"),
            F.col("record_id"),
            F.when(F.col("record_id").isNull(), F.col("issue_description")),
            F.col("copy_no"),
        ),
        "status": F.lit("open"),
        "resolved_by": nothing,
        "resolved_at": nothing,
        "resolution_notes": nothing,
        "check_run_id": F.lit(run_id),
        "detected_at": clock.now,
        "updated_at": clock.now,
    }
    return kept.select(
        *[
            values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS["data_quality_issue"].fields
        ]
    )


def log_rows(issue_counts: DataFrame, scanned: DataFrame, run_id: str, started: Clock, completed: Clock) -> DataFrame:
    rows = describe_checks(scanned.join(issue_counts, "check_name", "left")).withColumns(
        {
            "log_id": uuid_text(F.lit(run_id), F.lit("log"), F.col("check_name")),
            "run_id": F.lit(run_id),
            "started_at": started.now,
            "completed_at": completed.now,
            "issues_raised": F.coalesce("issues_raised", F.lit(0)),
            "error_message": F.lit(None),
            "sql_query": F.lit(None),
        }
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS["dq_check_log"].fields])


def run_row(check_log: DataFrame, run_id: str, triggered_by: str, started: Clock, completed: Clock) -> DataFrame:
    totals = check_log.agg(
        F.count(F.lit(1)).alias("checks_executed"), F.coalesce(F.sum("issues_raised"), F.lit(0)).alias("issues_found")
    ).withColumns(
        {
            "run_id": F.lit(run_id),
            "run_started_at": started.now,
            "run_completed_at": completed.now,
            "triggered_by": F.lit(triggered_by),
            "issues_resolved": F.lit(0),
            "run_notes": F.lit(f"Full DQ engine run triggered by {triggered_by}"),
        }
    )
    return totals.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS["dq_engine_run"].fields])


def run_checks(
    tables: dict[str, DataFrame],
    clock: Clock,
    run_id: str,
    triggered_by: str = "manual",
    registry: DataFrame | None = None,
    suppressions: DataFrame | None = None,
) -> RunResult:
    """Compose a run without writing anything."""
    issues = as_issues(kept_findings(tables, clock, registry, suppressions), run_id, clock)
    counts = issues.groupBy("check_name").agg(F.count(F.lit(1)).alias("issues_raised"))
    check_log = log_rows(counts, scan_counts(tables, clock), run_id, clock, clock)
    return RunResult(issues, check_log, run_row(check_log, run_id, triggered_by, clock, clock))


def group_members(tables: dict[str, DataFrame], issues: DataFrame) -> DataFrame:
    """A row per record of the groups that issues stand for (repeated case numbers)."""
    raised = issues.filter(F.col("check_name") == BY_ID["U02"].name).select("issue_id", "check_run_id", F.col("record_id").alias("first_id"))
    members = duplicate_case_members(tables).select("first_id", F.col("tb_case_id").alias("record_id"))
    return raised.join(members, "first_id").select("issue_id", "check_run_id", "record_id")


def execute_run(
    store: Store,
    tables: dict[str, DataFrame],
    clock: Clock,
    run_id: str | None = None,
    triggered_by: str = "manual",
    apply_suppressions: bool = False,
) -> str:
    """Run the checks, store issues, group members, check log and run row, and return the run id.

    All of it becomes visible at once, so a run that dies leaves nothing; a run
    whose id is stored already is not repeated.  The findings are computed once and staged (see
    `collapse_staged`); members and log come from the written issues.  Findings carry the run's
    clock; start and end of the run are wall-clock times.
    """
    run_id = run_id or str(uuid.uuid4())
    commit = store.begin()
    if run_id in commit.runs:
        return run_id
    started = Clock.system()
    registry = store.read("data_quality_issue")
    if SUMMARY not in tables:
        # In front of the given tables, which may be a mapping that builds them when asked.
        tables = ChainMap({SUMMARY: commit.stage(report_summary(tables["aggregate_report"]))}, tables)
    kept = describe_checks(collapse_staged(commit.stage, raise_findings(tables, clock), registry))
    if apply_suppressions:
        kept = without_suppressed(kept, store.read("dq_check_suppression"), tables["facility"], clock)
    issues = as_issues(kept, run_id, clock)
    written = store.read_parts("data_quality_issue", commit.append("data_quality_issue", issues))
    commit.append("data_quality_issue_member", group_members(tables, written))
    counts = written.groupBy("check_name").agg(F.count(F.lit(1)).alias("issues_raised"))
    rows = log_rows(counts, scan_counts(tables, clock), run_id, started, Clock.system())
    log = store.read_parts("dq_check_log", commit.append("dq_check_log", rows))
    commit.append("dq_engine_run", run_row(log, run_id, triggered_by, started, Clock.system()))
    commit.runs.append(run_id)
    commit.publish()
    return run_id


def one_check(tables: dict[str, DataFrame], check_id: str, clock: Clock) -> DataFrame:
    """The kept findings of a single check."""
    return kept_findings(tables, clock, only={check_id})
