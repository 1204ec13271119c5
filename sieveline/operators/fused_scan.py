"""All row checks of a table in one pass over it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.time import Clock
from sieveline.operators.row_rules import (
    FACILITY_RULES,
    PATIENT_RULES,
    WORKER_RULES,
    RowRule,
    rule_finding,
)


_FACILITY_COLUMNS = ["facility_id", "county_id", "facility_name", "mfl_code", "is_active"]
_PATIENT_COLUMNS = [
    "patient_id",
    "nupi_number",
    "sex",
    "date_of_birth",
    "date_enrolled",
    "date_of_death",
    "is_transferred_out",
]


def facility_side(facility: DataFrame) -> DataFrame:
    """The facility columns checks use.  Small: joined without a hint, so it is
    broadcast while its size is below the session's threshold."""
    return facility.selectExpr(*[f"{name} AS f_{name}" for name in _FACILITY_COLUMNS])


def patient_side(patient: DataFrame) -> DataFrame:
    return patient.selectExpr(*[f"{name} AS p_{name}" for name in _PATIENT_COLUMNS])


def emit(joined: DataFrame, rules: list[RowRule], clock: Clock, facility_column: str = "facility_id") -> DataFrame:
    """Unfold the findings of each row.

    The disjunction first drops clean rows: it is pushed below the joins (and
    into the file scan) where it touches one side only.  A finding's texts are
    built only where its rule fires.
    """
    violations = [rule.violates(clock) for rule in rules]
    dirty = joined.filter(reduce(lambda a, b: a | b, violations))
    fired = [F.when(bad, rule_finding(rule, clock, facility_column)) for bad, rule in zip(violations, rules)]
    # A rule that did not fire unfolds to a row of NULLs; an ordinary filter on it stays in generated code.
    return dirty.select(F.inline(F.array(*fired))).filter(F.col("check_name").isNotNull())


def _with_facility(df: DataFrame, facility: DataFrame, column: str = "facility_id", how: str = "inner") -> DataFrame:
    side = facility_side(facility)
    return df.join(side, df[column] == side["f_facility_id"], how)


def _with_patient(df: DataFrame, patient: DataFrame) -> DataFrame:
    side = patient_side(patient)
    return df.join(side, df["patient_id"] == side["p_patient_id"], "inner")


def facility_findings(
    tables: dict[str, DataFrame], table: str, clock: Clock, only: set[str] | None = None
) -> DataFrame:
    """Map-only when the facility list is broadcast."""
    rules = _chosen(FACILITY_RULES[table], only)
    return emit(_with_facility(tables[table], tables["facility"]), rules, clock)


def patient_findings(tables: dict[str, DataFrame], table: str, clock: Clock, only: set[str] | None = None) -> DataFrame:
    """One shuffle join on the patient; a hot patient's partition is split by AQE.

    Predicates on one side (weight below the limit, sex male) reach that side's
    scan before the shuffle.
    """
    rules = _chosen(PATIENT_RULES[table], only)
    joined = _with_facility(_with_patient(tables[table], tables["patient"]), tables["facility"])
    return emit(joined, rules, clock)


def worker_findings(tables: dict[str, DataFrame], table: str, clock: Clock, only: set[str] | None = None) -> DataFrame:
    """The worker must be known; the worker's facility need not be."""
    workers = tables["chw"].select(
        F.col("chw_id").alias("w_chw_id"),
        F.col("facility_id").alias("w_facility_id"),
    )
    facts = tables[table]
    joined = facts.join(workers, facts["chw_id"] == workers["w_chw_id"], "inner")
    joined = _with_facility(joined, tables["facility"], "w_facility_id", "left")
    return emit(joined, _chosen(WORKER_RULES[table], only), clock, "w_facility_id")


def _chosen(rules: list[RowRule], only: set[str] | None) -> list[RowRule]:
    return rules if only is None else [rule for rule in rules if rule.check.id in only]


def row_scans(only: set[str] | None = None) -> list[tuple]:
    """(builder, table) of every scan that has a rule to run."""
    plan = []
    for builder, family in (
        (facility_findings, FACILITY_RULES),
        (patient_findings, PATIENT_RULES),
        (worker_findings, WORKER_RULES),
    ):
        for table, rules in family.items():
            if _chosen(rules, only):
                plan.append((builder, table))
    return plan
