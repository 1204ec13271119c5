"""How many records each check looked at."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.time import Clock
from sieveline.operators import fixed_values as fx
from sieveline.operators.row_rules import FACILITY_RULES, PATIENT_RULES, WORKER_RULES

#: Counted over joined rows or distinct keys, not over the plain table.
_SPECIAL = {"K07", "P01", "T04"}


def _set_rule_conditions() -> dict[str, dict[str, Column | None]]:
    indicator = F.col("indicator_code")
    return {
        "aggregate_report": {
            "K06": indicator.isin("HTS_TST", "HTS_TST_POS"),
            "U03": None,
            "P03": (indicator == "TX_CURR") & (F.col("period_type") == "monthly"),
        },
        "patient": {"U01": F.col("date_of_birth").isNotNull()},
        "tb_case": {"U02": F.col("case_number").isNotNull()},
    }


def _table_counts(df: DataFrame, conditions: dict[str, Column | None]) -> DataFrame:
    """One pass over a table, one counter per check, turned into rows."""
    counters = [
        (F.count(F.lit(1)) if cond is None else F.count_if(cond)).alias(check_id)
        for check_id, cond in conditions.items()
    ]
    rows = [
        F.struct(F.lit(fx.BY_ID[i].name).alias("check_name"), F.col(i).cast("bigint").alias("records_scanned"))
        for i in conditions
    ]
    return df.agg(*counters).select(F.inline(F.array(*rows)))


def _one(df: DataFrame, check_id: str, count: Column) -> DataFrame:
    return df.agg(count.alias("n")).select(
        F.lit(fx.BY_ID[check_id].name).alias("check_name"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("records_scanned"),
    )


def _joined_counts(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Facts shrink to one counter per patient before they meet the patients."""
    visits = (
        tables["art_visit"]
        .groupBy("patient_id")
        .agg(F.count("next_appointment").alias("appointments"), F.count("weight_kg").alias("weights"))
    )
    adults = tables["patient"].filter(F.col("date_of_birth") < F.lit(fx.ADULT_BORN_BEFORE).cast("date"))
    deceased = tables["patient"].filter(F.col("date_of_death").isNotNull())
    starts = tables["art_enrollment"].groupBy("patient_id").agg(F.count(F.lit(1)).alias("starts"))
    return [
        _one(visits, "T04", F.count_if((F.col("appointments") > 0) & F.col("patient_id").isNotNull())),
        _one(visits.join(adults.select("patient_id"), "patient_id"), "P01", F.sum("weights")),
        _one(starts.join(deceased.select("patient_id"), "patient_id"), "K07", F.sum("starts")),
    ]


def scan_counts(tables: dict[str, DataFrame], clock: Clock) -> DataFrame:
    """(check_name, records_scanned) for every check."""
    conditions: dict[str, dict[str, Column | None]] = {}
    for family in (FACILITY_RULES, PATIENT_RULES, WORKER_RULES):
        for table, rules in family.items():
            for rule in rules:
                if rule.check.id not in _SPECIAL:
                    cond = None if rule.scanned is None else rule.scanned(clock)
                    conditions.setdefault(table, {})[rule.check.id] = cond
    for table, extra in _set_rule_conditions().items():
        conditions.setdefault(table, {}).update(extra)
    parts = [_table_counts(tables[table], conds) for table, conds in conditions.items()]
    return reduce(DataFrame.unionByName, parts + _joined_counts(tables))
