"""Checks decided by one row (with its facility, patient or worker)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.text import fill_sql, literal
from sieveline.functions.time import Clock, month_end
from sieveline.operators import fixed_values as fx

Predicate = Callable[[Clock], Column]


@dataclass(frozen=True)
class RowRule:
    """How one check reads a row; the texts come from the catalogue."""

    check: fx.Check
    key: str
    violates: Predicate
    scanned: Predicate | None = None  # None: every row of the table
    # SQL of what the finding quotes:
    slots: dict[str, str] = field(default_factory=dict)
    channel: str = "data_source"  # the row's own, unless the check has a fixed one
    year: str = "NULL"  # reporting period the finding belongs to
    month: str = "NULL"


def _c(name: str) -> Column:
    return F.col(name)


def _present(name: str) -> Predicate:
    return lambda clock: F.col(name).isNotNull()


def _rule(id_: str, key: str, violates: Predicate, **more) -> RowRule:
    return RowRule(fx.BY_ID[id_], key, violates, **more)


# What the closing balance should be; a missing loss counts as none.
_BALANCE = "(opening_balance + received_qty - dispensed_qty - coalesce(losses_adjustments, 0))"


def stock_gap() -> Column:
    return F.expr(f"abs(closing_balance - {_BALANCE})")


def stock_balance_wrong() -> Column:
    return (
        _c("closing_balance").isNotNull() & _c("opening_balance").isNotNull() & (stock_gap() > fx.STOCK_TOLERANCE)
    )


_PERIOD = {"year": "period_year", "month": "period_month"}
_EMR = literal(fx.EMR_CHANNEL)
_PERIOD_END = "last_day(make_date(period_year, period_month, 1))"

#: Checks needing the row and at most its facility.
FACILITY_RULES: dict[str, list[RowRule]] = {
    "patient": [
        _rule("C01", "patient_id", lambda k: _c("date_of_birth").isNull()),
        _rule("C02", "patient_id", lambda k: _c("sex") == "unknown"),
        _rule(
            "V01",
            "patient_id",
            lambda k: _c("date_of_birth") > k.today,
            scanned=_present("date_of_birth"),
        ),
        _rule(
            "K08",
            "patient_id",
            lambda k: _c("date_enrolled") < _c("date_of_birth"),
            scanned=_present("date_of_birth"),
        ),
    ],
    "tb_case": [
        _rule(
            "C03",
            "tb_case_id",
            lambda k: _c("treatment_start").isNull() & (_c("treatment_outcome") != "on_treatment"),
            year="year(notification_date)",
        ),
        _rule(
            "K03",
            "tb_case_id",
            lambda k: _c("treatment_start").isNull() & _c("treatment_outcome").isin(fx.FINISHED_TB_OUTCOMES),
        ),
        _rule(
            "T01",
            "tb_case_id",
            lambda k: F.datediff("notification_date", "diagnosis_date") > fx.TB_NOTIFICATION_DAYS,
            scanned=_present("diagnosis_date"),
            slots={"days": "datediff(notification_date, diagnosis_date)"},
            year="year(notification_date)",
        ),
    ],
    "art_enrollment": [
        _rule("C04", "enrollment_id", lambda k: _c("weight_at_start").isNull(), channel=_EMR),
        _rule(
            "V03",
            "enrollment_id",
            lambda k: _c("cd4_at_start") < 0,
            scanned=_present("cd4_at_start"),
            channel=_EMR,
        ),
        _rule(
            "P02",
            "enrollment_id",
            lambda k: _c("cd4_at_start") > fx.MAX_CD4,
            scanned=_present("cd4_at_start"),
            channel=_EMR,
        ),
    ],
    "viral_load": [
        _rule("C06", "vl_id", lambda k: _c("vl_result").isNull() & ~F.coalesce(_c("is_ldl"), F.lit(False))),
        _rule(
            "V04",
            "vl_id",
            lambda k: _c("result_date") < _c("sample_date"),
            scanned=_present("result_date"),
            slots={"days": "datediff(sample_date, result_date)"},
        ),
        _rule(
            "K02",
            "vl_id",
            lambda k: (_c("vl_category") == "suppressed")
            & (_c("vl_result") >= fx.SUPPRESSION_LIMIT)
            & (_c("is_ldl") == F.lit(False)),
            scanned=_present("vl_category"),
        ),
        _rule("P04", "vl_id", lambda k: _c("vl_result") > fx.MAX_VIRAL_LOAD, scanned=_present("vl_result")),
    ],
    "art_visit": [
        _rule(
            "V07",
            "visit_id",
            lambda k: ~_c("adherence_score").between(*fx.ADHERENCE_RANGE),
            scanned=_present("adherence_score"),
        ),
    ],
    "anc_visit": [
        _rule(
            "V05",
            "anc_visit_id",
            lambda k: _c("gestational_age_wks") > fx.MAX_GESTATION_WEEKS,
            scanned=_present("gestational_age_wks"),
        ),
        _rule(
            "P06",
            "anc_visit_id",
            lambda k: _c("systolic_bp") > fx.MAX_SYSTOLIC_BP,
            scanned=_present("systolic_bp"),
        ),
    ],
    "delivery": [
        _rule(
            "V08",
            "delivery_id",
            lambda k: _c("birth_weight_g") < fx.MIN_BIRTH_WEIGHT_G,
            scanned=_present("birth_weight_g"),
        ),
        _rule(
            "K04",
            "delivery_id",
            lambda k: (_c("baby_hiv_status") == "positive") & (_c("mother_hiv_status") == "negative"),
        ),
    ],
    "aggregate_report": [
        _rule("V06", "report_id", lambda k: _c("value") < 0, scanned=_present("value"), **_PERIOD),
        _rule(
            "T02",
            "report_id",
            lambda k: (_c("period_type") == "monthly")
            & (
                _c("submission_date")
                > F.date_add(month_end(_c("period_year"), _c("period_month")), fx.REPORT_LATE_DAYS).cast("timestamp")
            ),
            scanned=lambda k: (_c("period_type") == "monthly") & _c("submission_date").isNotNull(),
            slots={
                "period_end": _PERIOD_END,
                "days": f"extract(DAY FROM submission_date - cast({_PERIOD_END} AS timestamp))",
            },
            **_PERIOD,
        ),
        _rule("R01", "report_id", lambda k: _c("f_is_active") == F.lit(False), **_PERIOD),
    ],
    "stock_record": [
        _rule(
            "C05",
            "stock_id",
            lambda k: _c("closing_balance").isNull() & (_c("days_out_of_stock") == 0),
        ),
        _rule(
            "K05",
            "stock_id",
            lambda k: stock_balance_wrong(),
            scanned=lambda k: _c("closing_balance").isNotNull() & _c("opening_balance").isNotNull(),
            slots={"computed": f"round({_BALANCE}, 2)", "delta": f"round(abs(closing_balance - {_BALANCE}), 2)"},
        ),
        _rule("P05", "stock_id", lambda k: _c("days_out_of_stock") > fx.MAX_STOCKOUT_DAYS),
    ],
}

#: Checks needing the row's patient as well.  `scanned` of V02 and K01 is every
#: row; K07 and P01 count joined rows (see scan_counts).
PATIENT_RULES: dict[str, list[RowRule]] = {
    "art_enrollment": [
        _rule(
            "V02",
            "enrollment_id",
            lambda k: _c("art_start_date") < _c("p_date_enrolled"),
            slots={"days": "datediff(p_date_enrolled, art_start_date)"},
            channel=_EMR,
        ),
        _rule(
            "K07",
            "enrollment_id",
            lambda k: _c("art_start_date") > _c("p_date_of_death"),
            channel=_EMR,
        ),
    ],
    "anc_visit": [_rule("K01", "anc_visit_id", lambda k: _c("p_sex") == "male")],
    "art_visit": [
        _rule(
            "P01",
            "visit_id",
            lambda k: (_c("p_date_of_birth") < F.lit(fx.ADULT_BORN_BEFORE).cast("date"))
            & (_c("weight_kg") < fx.MIN_ADULT_WEIGHT_KG),
        ),
    ],
}

#: The check whose facility is that of the community worker.
WORKER_RULES: dict[str, list[RowRule]] = {
    "chw_service_record": [
        _rule(
            "T03",
            "service_id",
            lambda k: F.datediff(_c("created_at").cast("date"), _c("service_date")) > fx.CHW_SYNC_DAYS,
            slots={"created_on": "cast(created_at AS date)", "days": "datediff(cast(created_at AS date), service_date)"},
        ),
    ],
}


#: A raw finding: what differs from row to row.  Category, severity, table and
#: column follow from the check name and are attached after de-duplication.
FINDING_DDL = (
    "check_name string, record_id string, facility_id int, county_id int, issue_description string, "
    "raw_value string, expected_value string, data_source string, period_year int, period_month int"
)
PAYLOAD = [part.split()[0] for part in FINDING_DDL.split(", ")][2:]


def finding(
    check: fx.Check,
    key: str,
    clock: Clock,
    slots: dict[str, str] | None = None,
    facility: str = "facility_id",
    county: str = "f_county_id",
    channel: str = "data_source",
    year: str = "NULL",
    month: str = "NULL",
) -> dict[str, str]:
    """SQL of the finding columns of one check, in FINDING_DDL order."""
    texts = {"today": clock.today_sql, **(slots or {})}
    return {
        "check_name": literal(check.name),
        "record_id": f"cast({key} AS string)",
        "facility_id": f"cast({facility} AS int)",
        "county_id": f"cast({county} AS int)",
        "issue_description": fill_sql(check.message, texts),
        "raw_value": "cast(NULL AS string)" if check.raw is None else fill_sql(check.raw, texts),
        "expected_value": fill_sql(check.expected, texts),
        "data_source": f"cast({channel} AS string)",
        "period_year": f"cast({year} AS int)",
        "period_month": f"cast({month} AS int)",
    }


def select_finding(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def rule_finding(rule: RowRule, clock: Clock, facility: str = "facility_id") -> Column:
    """The finding struct of a row rule, to be evaluated only where it fires."""
    columns = finding(
        rule.check,
        rule.key,
        clock,
        rule.slots,
        facility=facility,
        channel=rule.channel,
        year=rule.year,
        month=rule.month,
    )
    return F.expr("named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in columns.items()) + ")")
