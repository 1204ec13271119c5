"""Entry points: the flagship job, every query, and its SQL reference."""

from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sieveline.functions.time import Clock  # noqa: E402
from sieveline.operators import constraints, lifecycle, maintenance, scan_counts, set_rules, suppression  # noqa: E402
from sieveline.operators.dedup import drop_repeated_active  # noqa: E402
from sieveline.operators.fixed_values import CHECKS  # noqa: E402
from sieveline.operators.fused_scan import row_scans  # noqa: E402
from sieveline.operators.set_rules import SUMMARY, report_summary  # noqa: E402
from sieveline.plans import reports, run, views  # noqa: E402
from sieveline.plans.promotion import promote  # noqa: E402
from sieveline.plans.resolution import execute_actions  # noqa: E402
from sieveline.session import configure, shared_folder  # noqa: E402
from sieveline.sources.derived import CHECK_CLOCK, REGISTRY_CLOCK, derive, derive_all  # noqa: E402
from sieveline.sources.landing import add_new_keys, read_table, upsert_patients  # noqa: E402
from sieveline.sources.store import Store  # noqa: E402

#: The corpus operators are a part of their own; everything else works without them.
_LLM = importlib.util.find_spec("sieveline.llm")
HAS_LLM = _LLM is not None and _LLM.origin is not None  # a folder left without modules is none
HAS_PIPELINE = HAS_LLM and importlib.util.find_spec("corpus_pipeline") is not None

Query = Callable[[SparkSession, str], DataFrame]
FINDING = [
    "record_id",
    "facility_id",
    "county_id",
    "issue_description",
    "raw_value",
    "expected_value",
    "data_source",
    "period_year",
    "period_month",
]
ISSUE = ["check_name", "check_category", "severity", "source_table", "source_column", *FINDING]


def plain(df: DataFrame) -> DataFrame:
    """Types both engines print alike: decimals as doubles, dates and times as text."""

    def convert(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        return col.alias(field.name)

    return df.select(*[convert(field) for field in df.schema.fields])


def _query(build: Query) -> Query:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(configure(spark), sf_dir))

    return call


def _check_tables(check_id: str) -> list[str]:
    fact = next(check.table for check in CHECKS if check.id == check_id)
    tables = {"facility", fact}
    builders = [builder.__name__ for builder, _ in row_scans({check_id})]
    if "patient_findings" in builders or check_id == "T04":
        tables.add("patient")
    if "worker_findings" in builders:
        tables.add("chw")
    return sorted(tables)


def _check(check_id: str) -> Query:
    def build(spark, sf_dir):
        tables = derive_all(spark, sf_dir, *_check_tables(check_id))
        return run.one_check(tables, check_id, CHECK_CLOCK).select(*FINDING)

    return build


def _stage(df: DataFrame) -> DataFrame:
    """The rows, computed once, in a folder that driver and executors share."""
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _run_tables(spark, sf_dir):
    """The reports, which several checks and the counts read, are totalled once, and so is their summary."""
    tables = derive_all(spark, sf_dir, *run.RUN_TABLES)
    tables["aggregate_report"] = _stage(tables["aggregate_report"])
    tables[SUMMARY] = _stage(report_summary(tables["aggregate_report"]))
    return tables


def _run(spark, sf_dir) -> run.RunResult:
    return run.run_checks(_run_tables(spark, sf_dir), CHECK_CLOCK, "run-1")


def _issues(spark, sf_dir):
    return derive(spark, sf_dir, "data_quality_issue")


def _places(spark, sf_dir):
    tables = derive_all(spark, sf_dir, "facility", "sub_county", "county")
    return views.facility_full(tables["facility"], tables["sub_county"], tables["county"])


def _rerun(spark, sf_dir):
    kept = run.kept_findings(_run_tables(spark, sf_dir), CHECK_CLOCK, registry=_issues(spark, sf_dir))
    return kept.select(*ISSUE)


def _suppressed_run(spark, sf_dir):
    # The requests belong to the registry's clock; move them to the checks'.
    shift = F.datediff(CHECK_CLOCK.today, REGISTRY_CLOCK.today)
    requests = derive(spark, sf_dir, "dq_check_suppression").withColumns(
        {
            "valid_from": F.date_add("valid_from", shift),
            "valid_until": F.date_add("valid_until", shift),
        }
    )
    kept = run.kept_findings(_run_tables(spark, sf_dir), CHECK_CLOCK, suppressions=requests)
    return kept.select(*ISSUE)


def _deduplicated(spark, sf_dir):
    kept = drop_repeated_active(_issues(spark, sf_dir))
    return kept.select("issue_id", "check_name", "source_table", "record_id", "status")


def _life(kind: str | None, bulk: bool, messages: bool) -> Query:
    """A lifecycle batch: the actions of one kind (None: no single actions, "": all)."""

    def build(spark, sf_dir):
        actions = None
        if kind is not None:
            actions = derive(spark, sf_dir, "issue_action")
            if kind:
                actions = actions.filter(F.col("action") == kind)
        bulk_actions = derive(spark, sf_dir, "bulk_action") if bulk else None
        outcome = lifecycle.apply_actions(_issues(spark, sf_dir), REGISTRY_CLOCK, actions, bulk_actions, _stage if messages else None)
        if messages:
            return outcome.messages
        return outcome.registry.select(
            "issue_id", "status", "resolved_by", "resolved_at", "resolution_notes", "updated_at"
        )

    return build


def _stored_run(spark, sf_dir):
    """A run that is stored and one that finds all of it active, read back."""
    store = Store(spark, f"{shared_folder(spark)}/registry-{uuid.uuid4().hex}")
    tables = _run_tables(spark, sf_dir)
    for run_id in ("run-1", "run-2"):
        run.execute_run(store, tables, CHECK_CLOCK, run_id)
    return store.read("data_quality_issue").select(*ISSUE, "status")


def _fp_alert(spark, sf_dir):
    marks = derive(spark, sf_dir, "issue_action").filter(F.col("action") == "false_positive")
    registry = _issues(spark, sf_dir)
    judged = lifecycle.judge(registry, REGISTRY_CLOCK, marks)
    after = lifecycle.with_changes(registry, lifecycle.changed_issues(judged, REGISTRY_CLOCK), REGISTRY_CLOCK)
    return lifecycle.false_positive_alerts(after, judged.filter("verdict = 'fp_ok'"))


def _fp_alert_each(spark, sf_dir):
    registry = _issues(spark, sf_dir)
    actions, bulk = derive(spark, sf_dir, "issue_action"), derive(spark, sf_dir, "bulk_action")
    judged = lifecycle.judge(registry, REGISTRY_CLOCK, actions, bulk)
    return lifecycle.alerts_per_marking(judged, registry)


def _stored_batch(table: str, *columns: str) -> Query:
    """The same batch applied to a stored registry, read back."""

    def build(spark, sf_dir):
        store = Store(spark, f"{shared_folder(spark)}/registry-{uuid.uuid4().hex}")
        store.append("data_quality_issue", _issues(spark, sf_dir))
        tables = derive_all(spark, sf_dir, "issue_action", "bulk_action", "suppression_request")
        execute_actions(store, REGISTRY_CLOCK, tables["issue_action"], tables["bulk_action"], tables["suppression_request"], "batch")
        return store.read(table).select(*columns)

    return build


def _suppress(part: int) -> Query:
    def build(spark, sf_dir):
        result = lifecycle.suppress_checks(derive(spark, sf_dir, "suppression_request"), REGISTRY_CLOCK)[part]
        return result.drop("suppression_id")

    return build


def _gate(table: str) -> Query:
    def build(spark, sf_dir):
        rules = constraints.CONSTRAINTS[table]
        parents = {parent for parent, _ in rules.parents.values()}
        tables = derive_all(spark, sf_dir, *({table} | parents))
        return constraints.gate(table, tables[table], tables, stage=_stage)[1].select(
            F.col(rules.key).alias("record_id"), "reasons"
        )

    return build


def _promoted(table: str, *columns: str) -> Query:
    """The reference tables and all patients arrive, then all patients again with unknown sex corrected."""

    def build(spark, sf_dir):
        store = Store(spark, f"{shared_folder(spark)}/canonical-{uuid.uuid4().hex}")
        landed = derive_all(spark, sf_dir, "county", "sub_county", "facility", "patient")
        promote(store, landed, REGISTRY_CLOCK, "first", buckets=4)
        sex = F.when(F.col("sex") == "unknown", F.lit("intersex")).otherwise(F.col("sex"))
        promote(store, {"patient": landed["patient"].withColumn("sex", sex)}, REGISTRY_CLOCK, "second")
        return store.read(table).select(*columns).distinct()

    return build


def _add_new_keys(spark, sf_dir):
    """The active facilities are known; the whole list arrives again under new names."""
    arriving = derive(spark, sf_dir, "facility")
    known = arriving.filter("is_active")
    renamed = arriving.withColumn("facility_name", F.concat(F.lit("renamed "), "facility_name"))
    return add_new_keys(known, renamed, ["mfl_code"]).select("facility_id", "mfl_code", "facility_name")


def _extracts(layer: str) -> Query:
    """Viral loads landed as two extracts, one of which lacks `is_ldl` and `vl_category`, read back."""

    def build(spark, sf_dir):
        loads = derive(spark, sf_dir, "viral_load")
        root = f"{shared_folder(spark)}/extracts-{uuid.uuid4().hex}"
        whole = F.pmod(F.col("vl_id").cast("bigint"), F.lit(2)) == 0
        kept = [c for c in ("vl_id", "patient_id", "facility_id", "vl_result", "is_ldl", "vl_category")]
        loads.filter(whole).select(*kept).write.parquet(f"{root}/{layer}/viral_load/a")
        loads.filter(~whole).select(*kept[:4]).write.parquet(f"{root}/{layer}/viral_load/b")
        return read_table(spark, root, "viral_load", CHECK_CLOCK, layer=layer).select(*kept)

    return build


def _upsert_patients(spark, sf_dir):
    """Patients of unknown sex arrive corrected."""
    patients = derive(spark, sf_dir, "patient")
    corrected = patients.filter("sex = 'unknown'").withColumn("sex", F.lit("intersex"))
    return upsert_patients(patients, corrected, REGISTRY_CLOCK).select("patient_id", "sex", "updated_at")


def _archive(part: int) -> Query:
    def build(spark, sf_dir):
        rows = maintenance.split_archive(_issues(spark, sf_dir), REGISTRY_CLOCK)[part]
        return rows.select("issue_id", "status", "resolved_at")

    return build


def _pairs_suppressed(spark, sf_dir):
    pairs = _issues(spark, sf_dir).filter("facility_id IS NOT NULL").select("check_name", "facility_id").distinct()
    tables = derive_all(spark, sf_dir, "dq_check_suppression", "facility")
    return suppression.check_is_suppressed(
        pairs, tables["dq_check_suppression"], tables["facility"], REGISTRY_CLOCK
    )


def _with_issues(report, *more: str, places: bool = False, clock: Clock | None = None) -> Query:
    """A report over the issues, then the fact tables `more`, the places and the clock."""

    def build(spark, sf_dir):
        args = [_issues(spark, sf_dir)]
        args += [derive(spark, sf_dir, table) for table in more]
        args += [_places(spark, sf_dir)] if places else []
        args += [clock] if clock else []
        return report(*args)

    return build


def _over_facts(report, *facts: str) -> Query:
    def build(spark, sf_dir):
        return report(*[derive(spark, sf_dir, table) for table in facts], _places(spark, sf_dir))

    return build


def entry(spark: SparkSession) -> DataFrame:
    """A full run of the checks, then the facility scorecard over its issues."""
    sf_dir = "/root/testdata/sf0.001"
    configure(spark)
    return plain(reports.facility_scores(_run(spark, sf_dir).issues, _places(spark, sf_dir)))


def queries() -> dict[str, Query]:
    now = REGISTRY_CLOCK
    found: dict[str, Query] = {f"chk_{check.id.lower()}": _check(check.id) for check in CHECKS}
    found |= {
        "chk_u02_members": lambda s, d: set_rules.duplicate_case_members(derive_all(s, d, "facility", "tb_case")),
        "scan_counts": lambda s, d: scan_counts.scan_counts(derive_all(s, d, *run.RUN_TABLES), CHECK_CLOCK),
        "check_log": lambda s, d: _run(s, d).check_log.select(
            "check_name", "check_category", "severity", "source_table", "records_scanned", "issues_raised"
        ),
        "run_row": lambda s, d: _run(s, d).run.select(
            "checks_executed", "issues_found", "issues_resolved", "triggered_by", "run_notes"
        ),
        "dedup_first_run": lambda s, d: _run(s, d).issues.select(*ISSUE, "status"),
        "dedup_rerun": _rerun,
        "dedup_stored_runs": _stored_run,
        "dedup_batch": _deduplicated,
        "run_with_suppressions": _suppressed_run,
        "io_landing_defaults": lambda s, d: derive(s, d, "tb_case").select(
            "tb_case_id", "case_type", "site", "hiv_status_at_dx", "treatment_outcome", "created_at"
        ),
        "io_add_new_keys": _add_new_keys,
        "io_upsert_patients": _upsert_patients,
        "io_promote": _promoted("patient", "patient_id", "facility_id", "nupi_number", "sex", "updated_at"),
        "io_promote_rejected": _promoted("rejected_row", "table_name", "record_id", "reasons"),
        "io_read_mixed": _extracts("raw"),
        "io_read_canonical": _extracts("canonical"),
        "vw_facility_full": _places,
        "vw_dq_summary": _with_issues(views.dq_summary, places=True),
        "vw_dq_daily_trend": _with_issues(views.daily_trend),
        "vw_check_performance": lambda s, d: views.check_performance(derive(s, d, "dq_check_log")).withColumn(
            "avg_duration_secs", F.round("avg_duration_secs", 4)
        ),
        "rpt_a01": _with_issues(reports.facility_scores, places=True),
        "rpt_a02": _with_issues(reports.category_breakdown),
        "rpt_a03": _with_issues(reports.worst_facilities, places=True, clock=now),
        "rpt_a04": _with_issues(reports.county_heatmap, "facility", "county"),
        "rpt_a05": _with_issues(reports.resolution_rates),
        "rpt_b01": _with_issues(reports.detection_trend, clock=now),
        "rpt_b02": _with_issues(reports.monthly_burden, places=True, clock=now),
        "rpt_b03": _with_issues(reports.time_to_resolve),
        "rpt_b04": lambda s, d: reports.run_history(derive(s, d, "dq_engine_run")),
        "rpt_c01": lambda s, d: reports.treatment_scorecard(
            derive(s, d, "art_enrollment"), _issues(s, d), _places(s, d)
        ),
        "rpt_c01_corrected": lambda s, d: reports.treatment_scorecard(
            derive(s, d, "art_enrollment"), _issues(s, d), _places(s, d), corrected=True
        ),
        "rpt_c02": _over_facts(reports.notification_delays, "tb_case"),
        "rpt_c03": _over_facts(reports.suppression_labels, "viral_load"),
        "rpt_c04": _over_facts(reports.visit_completeness, "anc_visit"),
        "rpt_c05": _over_facts(reports.stock_errors, "stock_record", "commodity"),
        "rpt_c06": _over_facts(reports.late_reporting, "aggregate_report"),
        "rpt_d01": _with_issues(reports.critical_actions, places=True, clock=now),
        "rpt_d02": _with_issues(reports.by_channel),
        "rpt_d03": lambda s, d: reports.clean_facilities(
            _issues(s, d), _places(s, d), *[derive(s, d, t) for t in ("patient", "art_enrollment", "tb_case")]
        ),
        "rpt_d04": _with_issues(reports.stale_issues, places=True, clock=now),
        "rpt_d05": _with_issues(reports.false_positive_rates),
        "rpt_export": _with_issues(reports.full_export, places=True, clock=now),
        "life_batch": _life("", True, False),
        "life_batch_messages": _life("", True, True),
        "life_bulk_resolve": _life(None, True, False),
        "life_bulk_messages": _life(None, True, True),
        "life_fp_alert": _fp_alert,
        "life_fp_alert_each": _fp_alert_each,
        "life_stored": _stored_batch(
            "data_quality_issue", "issue_id", "status", "resolved_by", "resolved_at", "resolution_notes", "updated_at"
        ),
        "life_stored_messages": _stored_batch("dq_action_message", "kind", "seq", "message"),
        "life_suppress": _suppress(0),
        "life_suppress_messages": _suppress(1),
        "facility_scores": _with_issues(reports.dq_scores, "facility"),
        "suppressed_pairs": lambda s, d: suppression.suppressed_pairs(
            derive(s, d, "dq_check_suppression"), derive(s, d, "facility"), now
        ),
        "check_is_suppressed": _pairs_suppressed,
        "open_issues": _with_issues(reports.open_issues, clock=now),
        "mnt_cleanup": lambda s, d: maintenance.cleanup_suppressions(
            derive(s, d, "dq_check_suppression"), now
        ).select("suppression_id", "check_name", "valid_until", "is_active"),
        "mnt_archive_live": _archive(0),
        "mnt_archive_moved": _archive(1),
        "mnt_stale_alert": _with_issues(maintenance.stale_issue_alert, places=True, clock=now),
        "mnt_health": _with_issues(maintenance.engine_health, "dq_engine_run", "dq_check_suppression", clock=now),
    }
    for kind in ("resolve", "waive", "false_positive", "reopen"):
        found[f"life_{kind}"] = _life(kind, False, False)
        found[f"life_{kind}_messages"] = _life(kind, False, True)
    for table in constraints.CONSTRAINTS:
        found[f"gate_{table}"] = _gate(table)
    result = {name: _query(build) for name, build in found.items()}
    if HAS_LLM:
        from sieveline.llm.queries import queries as corpus_queries

        result |= corpus_queries()
    if HAS_PIPELINE:
        import corpus_pipeline

        result["pipeline"] = corpus_pipeline.run
    return result


def oracle_sql() -> dict[str, str]:
    from oracle import checks, gate
    from oracle import lifecycle as life
    from oracle import reports as rpt

    found = {f"chk_{check.id.lower()}": checks.one_check(check.id) for check in CHECKS}
    found |= {
        "chk_u02_members": checks.case_members(),
        "scan_counts": checks.scan_counts(),
        "check_log": checks.check_log(),
        "run_row": checks.run_row(),
        "dedup_first_run": checks.run_issues(),
        "dedup_rerun": checks.rerun_issues(),
        "dedup_stored_runs": checks.run_issues(),
        "io_promote": gate.promoted_patients(),
        "io_promote_rejected": gate.set_aside("county", "sub_county", "facility", "patient"),
        "dedup_batch": checks.dedup_batch(),
        "run_with_suppressions": checks.suppressed_run(),
    }
    found |= rpt.SQL
    found |= life.SQL
    found |= {f"gate_{table}": gate.rejected(table) for table in gate.GATES}
    if HAS_LLM:
        from sieveline.llm.sql import SQL as CORPUS_SQL

        found |= CORPUS_SQL
    if HAS_PIPELINE:
        import corpus_pipeline

        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
