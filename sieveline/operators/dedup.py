"""One active finding per check and record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scoring import ACTIVE_STATUSES
from sieveline.functions.text import literal
from sieveline.operators.fixed_values import CHECKS
from sieveline.operators.row_rules import PAYLOAD

_RUN = 10_000  # repeats unfolded per array, to keep arrays small


def collapse_repeats(findings: DataFrame) -> DataFrame:
    """Keep the least finding of each (check, record); findings without a record id
    are all kept.

    Copies combine before the shuffle, so a record landed millions of times
    costs one row per task.  Id-less findings are grouped by their whole content
    and counted, then unfolded again, numbered in `copy_no`.
    """
    anonymous = F.col("record_id").isNull()
    grouped = (
        findings.withColumn("content", F.when(anonymous, F.struct(*PAYLOAD)))
        .groupBy("record_id", "check_name", "content")  # the id first: it tells rows apart soonest when sorting
        .agg(F.min(F.struct(*PAYLOAD)).alias("kept"), F.count(F.lit(1)).alias("copies"))
    )
    copies = F.when(anonymous, F.col("copies")).otherwise(F.lit(1).cast("bigint"))
    last_block = F.call_function("div", copies - 1, F.lit(_RUN).cast("bigint"))
    blocks = grouped.select(
        "check_name",
        "record_id",
        "kept",
        copies.alias("copies"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("block"),
    )
    in_block = F.least(F.col("copies") - F.col("block") * _RUN, F.lit(_RUN).cast("bigint"))
    return blocks.select(
        "check_name",
        "record_id",
        *[F.col(f"kept.{name}").alias(name) for name in PAYLOAD],
        F.explode(F.sequence(F.col("block") * _RUN, F.col("block") * _RUN + in_block - 1)).alias("copy_no"),
    )


def collapse_staged(
    stage: Callable[[DataFrame], DataFrame], findings: DataFrame, registry: DataFrame | None = None
) -> DataFrame:
    """The same rows as `collapse_repeats`, less those of active issues, with the texts fetched late.

    The findings are computed once and staged.  What happens to them is decided on fingerprints of
    128 bits, which aggregate by hash in fixed width: which subjects are active already, and which occur
    more than once.  Texts are then read for the findings that stay, in one join on the fingerprint; only
    repeated ones are compared by content.
    """
    anonymous = F.col("record_id").isNull()
    subject = ["check_name", "record_id", F.when(anonymous, F.struct(*PAYLOAD))]
    prints = {"k1": F.xxhash64(F.lit(1), *subject), "k2": F.xxhash64(F.lit(2), *subject)}
    staged = stage(findings.withColumns(prints))
    keys = staged.select("k1", "k2", "check_name", "record_id")
    if registry is not None:
        keys = without_active(describe_checks(keys), registry)
    times = stage(keys.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("times")))
    once = staged.join(times.filter("times = 1"), ["k1", "k2"])
    kept = once.select("check_name", "record_id", *PAYLOAD, F.lit(0).cast("bigint").alias("copy_no"))
    repeated = times.filter("times > 1")
    if repeated.isEmpty():
        return kept
    again = staged.join(repeated, ["k1", "k2"], "left_semi").drop("k1", "k2")
    return kept.unionByName(collapse_repeats(again))


def describe_checks(findings: DataFrame) -> DataFrame:
    """Attach category, severity, table and column of each finding's check."""

    def by_check(attribute: str):
        pairs = ", ".join(f"{literal(check.name)}, {literal(getattr(check, attribute))}" for check in CHECKS)
        return F.expr(f"element_at(map({pairs}), check_name)")

    return findings.withColumns(
        {
            "check_category": by_check("category"),
            "severity": by_check("severity"),
            "source_table": by_check("table"),
            "source_column": by_check("column"),
        }
    )


def without_active(findings: DataFrame, registry: DataFrame) -> DataFrame:
    """Drop findings that already have an open or confirmed issue.

    NULL record ids match nothing and stay.  Only three columns of the active
    part of the registry (its `open` and `confirmed` partitions) are read.
    """
    active = registry.filter(F.col("status").isin(ACTIVE_STATUSES) & F.col("record_id").isNotNull()).select(
        "check_name", "source_table", "record_id"
    )
    return findings.join(active, ["check_name", "source_table", "record_id"], "left_anti")


def drop_repeated_active(issues: DataFrame) -> DataFrame:
    """The same rule for a batch of complete issue rows: of active rows with equal
    check, table and record the first detected stays; all other rows stay."""
    subject = F.col("status").isin(ACTIVE_STATUSES) & F.col("record_id").isNotNull()
    first = (
        issues.filter(subject)
        .groupBy("check_name", "source_table", "record_id")
        .agg(F.min(F.struct("detected_at", "issue_id")).getField("issue_id").alias("issue_id"))
        .select("issue_id")
    )
    return issues.filter(~subject | subject.isNull()).unionByName(issues.filter(subject).join(first, "issue_id", "left_semi"))
