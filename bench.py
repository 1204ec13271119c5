"""Headline timings.  Prints one JSON line.

The domain tables are first landed as Parquet (timed as `land_tables`); the jobs
then read the landed files, as they would in use.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS, BENCH_REPEAT (default 1: one run of each job)

`value` is the sum over the jobs, without session start and landing.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sieveline.operators import constraints, lifecycle, maintenance  # noqa: E402
from sieveline.operators.scan_counts import scan_counts  # noqa: E402
from sieveline.operators.set_rules import SET_RULES  # noqa: E402
from sieveline.plans import reports, run, views  # noqa: E402
from sieveline.session import build_session  # noqa: E402
from sieveline.sources.derived import CHECK_CLOCK, REGISTRY_CLOCK, derive  # noqa: E402
from sieveline.sources.store import Store  # noqa: E402

LANDED = [*run.RUN_TABLES, "county", "sub_county", "commodity"]
REGISTRY = ["data_quality_issue", "dq_engine_run", "dq_check_log", "dq_check_suppression"]
BATCH = ["issue_action", "bulk_action"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    started = time.time()
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {"session_start": time.time() - started}

    def clocked(name, job):
        best = None
        for _ in range(repeat):
            begin = time.time()
            job()
            took = time.time() - begin
            best = took if best is None else min(best, took)
        timings[name] = best

    def consumed(name, build):
        clocked(name, lambda: build().write.format("noop").mode("overwrite").save())

    root = tempfile.mkdtemp(prefix="bench-")

    def land():
        for table in LANDED + BATCH:
            # Several files per table, as extracts of many sites arrive.
            derive(spark, sf_dir, table).repartition(cpus).write.parquet(f"{root}/raw/{table}")

    begin = time.time()
    land()
    timings["land_tables"] = time.time() - begin
    # Landed columns are complete, so their own schema is the table's schema.
    t = {name: spark.read.parquet(f"{root}/raw/{name}") for name in LANDED + BATCH}
    now = REGISTRY_CLOCK

    consumed("full_run_cold", lambda: run.run_checks(t, CHECK_CLOCK, "r0").issues)
    consumed("full_run_warm", lambda: run.run_checks(t, CHECK_CLOCK, "r1").issues)
    store = Store(spark, f"{root}/store")
    clocked("execute_run_first", lambda: run.execute_run(store, t, CHECK_CLOCK, "run-first"))
    clocked("execute_run_unchanged", lambda: run.execute_run(store, t, CHECK_CLOCK, "run-again"))
    consumed("scan_counts", lambda: scan_counts(t, CHECK_CLOCK))
    for check_id, build in SET_RULES.items():
        consumed(f"check_{check_id.lower()}", lambda build=build: build(t, CHECK_CLOCK))
    for check_id in ("C01", "V02", "K02", "K05", "T02", "P01"):
        consumed(
            f"check_{check_id.lower()}",
            lambda check_id=check_id: run.raise_findings(t, CHECK_CLOCK, {check_id}),
        )
    consumed("gate_art_visit", lambda: constraints.gate("art_visit", t["art_visit"], t)[1])

    registry = Store(spark, f"{root}/registry")

    def load_registry():
        for table in REGISTRY:
            registry.replace(table, derive(spark, sf_dir, table))

    clocked("load_registry", load_registry)
    issues = registry.read("data_quality_issue")
    runs, log = registry.read("dq_engine_run"), registry.read("dq_check_log")
    places = views.facility_full(t["facility"], t["sub_county"], t["county"])
    jobs = {
        "rpt_a01": lambda: reports.facility_scores(issues, places),
        "rpt_a02": lambda: reports.category_breakdown(issues),
        "rpt_a03": lambda: reports.worst_facilities(issues, places, now),
        "rpt_a04": lambda: reports.county_heatmap(issues, t["facility"], t["county"]),
        "rpt_a05": lambda: reports.resolution_rates(issues),
        "rpt_b01": lambda: reports.detection_trend(issues, now),
        "rpt_b02": lambda: reports.monthly_burden(issues, places, now),
        "rpt_b03": lambda: reports.time_to_resolve(issues),
        "rpt_b04": lambda: reports.run_history(runs),
        "rpt_c01": lambda: reports.treatment_scorecard(t["art_enrollment"], issues, places),
        "rpt_c02": lambda: reports.notification_delays(t["tb_case"], places),
        "rpt_c03": lambda: reports.suppression_labels(t["viral_load"], places),
        "rpt_c04": lambda: reports.visit_completeness(t["anc_visit"], places),
        "rpt_c05": lambda: reports.stock_errors(t["stock_record"], t["commodity"], places),
        "rpt_c06": lambda: reports.late_reporting(t["aggregate_report"], places),
        "rpt_d01": lambda: reports.critical_actions(issues, places, now),
        "rpt_d02": lambda: reports.by_channel(issues),
        "rpt_d03": lambda: reports.clean_facilities(issues, places, t["patient"], t["art_enrollment"], t["tb_case"]),
        "rpt_d04": lambda: reports.stale_issues(issues, places, now),
        "rpt_d05": lambda: reports.false_positive_rates(issues),
        "rpt_export": lambda: reports.full_export(issues, places, now),
        "vw_dq_summary": lambda: views.dq_summary(issues, places),
        "vw_check_performance": lambda: views.check_performance(log),
        "facility_scores": lambda: reports.dq_scores(issues, t["facility"]),
        "mnt_stale_alert": lambda: maintenance.stale_issue_alert(issues, places, now),
        "mnt_health": lambda: maintenance.engine_health(
            issues, runs, registry.read("dq_check_suppression"), now
        ),
        "life_batch_all": lambda: lifecycle.apply_actions(issues, now, t["issue_action"], t["bulk_action"]).registry,
        "life_batch_1pct": lambda: lifecycle.apply_actions(
            issues, now, t["issue_action"].filter(F.col("action_seq") % 400 < 4)
        ).registry,
    }
    for name, build in jobs.items():
        consumed(name, build)
    clocked("mnt_archive", lambda: maintenance.archive_old_resolved(registry, now))

    setup = ("session_start", "land_tables", "load_registry")
    total = sum(v for k, v in timings.items() if k not in setup)
    print(
        json.dumps(
            {
                "metric": "data-quality jobs, wall clock",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in timings.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
