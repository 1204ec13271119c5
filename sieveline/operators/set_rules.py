"""Checks that compare rows with other rows of their table.

None of them pairs up the rows of a group: each compares a row with one
aggregate of its group, and the aggregates combine before the shuffle, so a
group holding a large share of the table costs no more than its distinct keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.time import Clock
from sieveline.operators import fixed_values as fx
from sieveline.operators.fused_scan import facility_side, patient_side
from sieveline.functions.text import literal
from sieveline.operators.row_rules import finding, select_finding

_EMR = literal(fx.EMR_CHANNEL)
_RPT = literal(fx.REPORTING_CHANNEL)


_PERIOD = ["facility_id", "period_year", "period_month"]


def _plain_reports(reports: DataFrame) -> DataFrame:
    """Each report in the shape of a summary of one."""
    monthly = F.coalesce(F.col("period_type") == "monthly", F.lit(False))
    own = F.struct("report_id", "value")
    return reports.select(
        *_PERIOD,
        "indicator_code",
        F.lit(1).cast("bigint").alias("n"),
        F.col("report_id").alias("first_id"),
        own.alias("last"),
        F.col("value").alias("lowest"),
        F.when(monthly, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("n_monthly"),
        F.when(monthly, own).alias("last_monthly"),
    )


def report_summary(reports: DataFrame) -> DataFrame:
    """What K06, U03 and P03 need of the reports: a row per facility, period and indicator.

    A stored run makes it in one pass and puts it into the tables as SUMMARY; without it the rules read the reports
    themselves, which are summaries of one.
    """
    return (
        _plain_reports(reports)
        .groupBy(*_PERIOD, "indicator_code")
        .agg(
            F.sum("n").alias("n"),
            F.min("first_id").alias("first_id"),
            F.max("last").alias("last"),
            F.min("lowest").alias("lowest"),
            F.sum("n_monthly").alias("n_monthly"),
            F.max("last_monthly").alias("last_monthly"),
        )
    )


SUMMARY = "aggregate_report_summary"


def _summary(tables: dict[str, DataFrame]) -> DataFrame:
    return tables[SUMMARY] if SUMMARY in tables else _plain_reports(tables["aggregate_report"])


def _surely_none(tables: dict[str, DataFrame], repeated: DataFrame) -> bool:
    """Whether a run's summary shows that there are no repeated reports, so that nothing goes back to the reports."""
    return SUMMARY in tables and repeated.isEmpty()


def positives_over_tests(tables: dict[str, DataFrame], clock: Clock) -> DataFrame:
    """Some test report of the period is lower than the positives.

    "Some report is lower" is "the lowest is lower".  Reports shrink to one row per facility and period with
    the lowest tests, and the positives where only one report has them; only periods with several of
    these go back to the reports.
    """
    tests, positive = F.col("indicator_code") == "HTS_TST", F.col("indicator_code") == "HTS_TST_POS"
    slot = F.coalesce(F.col("period_month"), F.lit(0)).alias("slot")
    periods = (
        _summary(tables)
        .filter(tests | positive)
        .groupBy("facility_id", "period_year", slot)
        .agg(
            F.min(F.when(tests & F.col("lowest").isNotNull(), F.struct(F.col("lowest").alias("value"), "period_month"))).alias("tst"),
            F.sum(F.when(positive, F.col("n"))).alias("n"),
            F.max(F.when(positive, F.col("last"))).alias("last"),
        )
        .filter("tst IS NOT NULL AND n > 0 AND facility_id IS NOT NULL AND period_year IS NOT NULL")
    )
    columns = ["report_id", "facility_id", "period_year", "positives", "tst"]
    found = periods.filter("n = 1").select(F.col("last.report_id"), "facility_id", "period_year", F.col("last.value").alias("positives"), "tst")
    repeated = periods.filter("n > 1").select("facility_id", "period_year", "slot", "tst")
    if not _surely_none(tables, repeated):
        rows = tables["aggregate_report"].filter(positive).select("report_id", "facility_id", "period_year", slot, F.col("value").alias("positives"))
        found = found.unionByName(rows.join(repeated, ["facility_id", "period_year", "slot"]).select(*columns))
    side = facility_side(tables["facility"])
    hit = (
        found.filter(F.col("positives") > F.col("tst.value"))
        .withColumn("period_month", F.col("tst.period_month"))
        .join(side, F.col("facility_id") == side["f_facility_id"])
    )
    columns = finding(
        fx.BY_ID["K06"], "report_id", clock, {"tested": "tst.value"}, channel=_RPT, year="period_year", month="period_month"
    )
    return select_finding(hit, columns)


def overdue_patients(tables: dict[str, DataFrame], clock: Clock) -> DataFrame:
    """The last appointment at a facility passed long ago.

    Visits combine to one row per patient and facility, and only overdue ones go
    on to the patient join.
    """
    latest = (
        tables["art_visit"]
        .groupBy("patient_id", "facility_id")
        .agg(F.max("visit_date").alias("last_visit"), F.max("next_appointment").alias("last_appointment"))
        .filter(F.col("last_appointment") < F.date_sub(clock.today, fx.OVERDUE_DAYS))
    )
    patients = patient_side(tables["patient"]).filter(
        F.col("p_date_of_death").isNull() & (F.col("p_is_transferred_out") == F.lit(False))
    )
    side = facility_side(tables["facility"])
    hit = latest.join(patients, F.col("patient_id") == F.col("p_patient_id")).join(
        side, F.col("facility_id") == side["f_facility_id"]
    )
    slots = {"days": f"datediff({clock.today_sql}, last_appointment)"}
    return select_finding(hit, finding(fx.BY_ID["T04"], "patient_id", clock, slots, channel=_EMR))


def duplicate_patients(tables: dict[str, DataFrame], clock: Clock) -> DataFrame:
    """A lower patient id with the same facility, sex and birth date enrolled
    within two weeks.

    "Some lower id nearby" is "the lowest id nearby is lower".  Registrations
    shrink to one row per group and enrolment day; the window runs over those
    days (bounded by the calendar, however many rows share a placeholder birth
    date), and only days that have a hit are joined back to the patients.
    """
    group = ["facility_id", "sex", "date_of_birth"]
    people = tables["patient"].select("patient_id", *group, "date_enrolled").dropna()
    days = people.groupBy(*group, "date_enrolled").agg(
        F.min("patient_id").alias("lowest"), F.max("patient_id").alias("highest")
    )
    near = (
        Window.partitionBy(*group)
        .orderBy(F.datediff("date_enrolled", F.lit("1970-01-01").cast("date")))
        .rangeBetween(-fx.DUPLICATE_ENROLMENT_DAYS, fx.DUPLICATE_ENROLMENT_DAYS)
    )
    hit_days = (
        days.withColumn("partner_id", F.min("lowest").over(near))
        .filter(F.col("highest") > F.col("partner_id"))
        .select(*group, "date_enrolled", "partner_id")
    )
    side = facility_side(tables["facility"])
    hit = (
        people.join(hit_days, [*group, "date_enrolled"])
        .filter(F.col("partner_id") < F.col("patient_id"))
        .join(side, F.col("facility_id") == side["f_facility_id"])
    )
    return select_finding(hit, finding(fx.BY_ID["U01"], "patient_id", clock, channel=_EMR))


def _cases_with_county(tables: dict[str, DataFrame]) -> DataFrame:
    side = facility_side(tables["facility"]).select("f_facility_id", "f_county_id")
    return (
        tables["tb_case"]
        .filter(F.col("case_number").isNotNull())
        .select("tb_case_id", "case_number", "facility_id")
        .join(side, F.col("facility_id") == side["f_facility_id"])
        .select("tb_case_id", "case_number", F.col("f_county_id").alias("county_id"))
    )


def _repeated_cases(cases: DataFrame) -> DataFrame:
    return (
        cases.groupBy("case_number", "county_id")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("tb_case_id").alias("first_id"))
        .filter(F.col("copies") > 1)
    )


def duplicate_case_members(tables: dict[str, DataFrame]) -> DataFrame:
    """Every case of every repeated case number, one row each."""
    cases = _cases_with_county(tables)
    groups = _repeated_cases(cases).select(
        F.col("case_number").alias("g_case"), F.col("county_id").alias("g_county"), "copies", "first_id"
    )
    same = (F.col("case_number") == F.col("g_case")) & F.col("county_id").eqNullSafe(F.col("g_county"))
    return cases.join(groups, same).drop("g_case", "g_county")


def duplicate_case_numbers(tables: dict[str, DataFrame], clock: Clock) -> DataFrame:
    """A case number used more than once in a county.

    Counting combines before the shuffle, and the text carries only what does not
    grow with the group.  All ids are rows of `duplicate_case_members`, which a
    stored run keeps with the issue.
    """
    hit = _repeated_cases(_cases_with_county(tables))
    return select_finding(
        hit, finding(fx.BY_ID["U02"], "first_id", clock, facility="NULL", county="county_id", channel=_RPT)
    )


def duplicate_reports(tables: dict[str, DataFrame], clock: Clock) -> DataFrame:
    """One facility, period and indicator reported more than once."""
    groups = (
        _summary(tables)
        .groupBy(*_PERIOD, "indicator_code")
        .agg(F.sum("n").alias("copies"), F.min("first_id").alias("first_id"))
        .filter(F.col("copies") > 1)
    )
    side = facility_side(tables["facility"])
    hit = groups.join(side, F.col("facility_id") == side["f_facility_id"])
    return select_finding(
        hit, finding(fx.BY_ID["U03"], "first_id", clock, channel=_RPT, year="period_year", month="period_month")
    )


#: Reports that a block of a month's series holds about.
BLOCK_REPORTS = 500_000
_MONTH = ["facility_id", "no_year", "sort_year", "no_month", "sort_month"]


def _repeated_months(series: DataFrame, carried: DataFrame) -> DataFrame:
    """Reports, with the value before, of months that have several of a facility.

    Equal reports are one: none of the others can exceed the one before it.  A month of many reports is
    cut into blocks at splitters: about one report in BLOCK_REPORTS, chosen by its hash, so that the blocks hold
    about as many reports each, whatever the ids look like.  A splitter starts its block and also ends the one before,
    where it finds its own predecessor; so no block needs another one's result.
    """
    own = F.struct("report_id", "value")
    drawn = F.pmod(F.xxhash64("report_id", "value"), F.lit(BLOCK_REPORTS)) == 0
    multi = series.groupBy(*_MONTH).agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.when(drawn, own)).alias("splitters"))
    multi = multi.filter("n > 1").join(carried, _MONTH)
    rows = series.join(multi, _MONTH).select(*_MONTH, "report_id", "value", "carried", "splitters").distinct()
    block = F.size(F.filter("splitters", lambda splitter: splitter <= own))
    both = F.array(F.struct(F.col("block").alias("block"), F.lit(True).alias("head")), F.struct((F.col("block") - 1).alias("block"), F.lit(False).alias("head")))
    place = F.when(F.array_contains("splitters", own), both).otherwise(F.array(F.struct(F.col("block").alias("block"), F.lit(False).alias("head"))))
    dealt = rows.withColumn("block", block).withColumn("place", place).drop("splitters", "block").select("*", F.inline("place"))
    inside = Window.partitionBy(*_MONTH, "block").orderBy(F.col("report_id").asc_nulls_first(), F.col("value").asc_nulls_first())
    first = (F.row_number().over(inside) == 1) & (F.col("block") == 0)
    ranked = dealt.withColumn("previous", F.when(first, F.col("carried")).otherwise(F.lag("value").over(inside)))
    return ranked.filter(~F.col("head")).select(*_MONTH, "report_id", "value", "previous")


def treatment_jumps(tables: dict[str, DataFrame], clock: Clock) -> DataFrame:
    """The count more than doubled since the facility's previous report.

    Reports shrink to a row per facility and month, of which a facility has as many as the calendar
    allows, and each month takes the last value of the month before.  A month with one report is thereby
    done; only months with several go back to the reports (see `_repeated_months`).
    """
    place = {
        "no_year": F.col("period_year").isNull(),
        "sort_year": F.coalesce("period_year", F.lit(0)),
        "no_month": F.col("period_month").isNull(),
        "sort_month": F.coalesce("period_month", F.lit(0)),
    }
    current = (F.col("indicator_code") == "TX_CURR") & F.col("facility_id").isNotNull()
    monthly = _summary(tables).filter(current & (F.col("n_monthly") > 0)).withColumns(place)
    months = monthly.groupBy(*_MONTH).agg(F.sum("n_monthly").alias("n"), F.max("last_monthly").alias("last"))
    along = Window.partitionBy("facility_id").orderBy(*_MONTH[1:])
    months = months.withColumn("carried", F.lag("last.value").over(along))
    found = months.filter("n = 1").select(*_MONTH, "last.*", F.col("carried").alias("previous"))
    if not _surely_none(tables, months.filter("n > 1")):
        rows = tables["aggregate_report"].filter(current & (F.col("period_type") == "monthly")).withColumns(place)
        carried = months.filter("n > 1").select(*_MONTH, "carried")
        found = found.unionByName(_repeated_months(rows.select(*_MONTH, "report_id", "value"), carried))
    side = facility_side(tables["facility"])
    hit = (
        found.filter((F.col("previous") > 0) & (F.col("value") > F.col("previous") * 2))
        .withColumns(
            {
                "period_year": F.when(~F.col("no_year"), F.col("sort_year")),
                "period_month": F.when(~F.col("no_month"), F.col("sort_month")),
            }
        )
        .join(side, F.col("facility_id") == side["f_facility_id"])
    )
    slots = {
        "doubled": "cast(previous * 2 AS decimal(12,2))",
        "month_before": "period_month - 1",
        "growth": "round((value - previous) / previous * 100, 1)",
    }
    return select_finding(
        hit, finding(fx.BY_ID["P03"], "report_id", clock, slots, channel=_RPT, year="period_year", month="period_month")
    )


#: check id -> builder
SET_RULES = {
    "K06": positives_over_tests,
    "T04": overdue_patients,
    "U01": duplicate_patients,
    "U02": duplicate_case_numbers,
    "U03": duplicate_reports,
    "P03": treatment_jumps,
}
