"""Which findings a suppression request covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.time import Clock


def in_force(suppressions: DataFrame, clock: Clock) -> DataFrame:
    return suppressions.filter(
        F.col("is_active") & (F.col("valid_from") <= clock.today) & (F.col("valid_until") >= clock.today)
    )


def suppressed_pairs(suppressions: DataFrame, facility: DataFrame, clock: Clock) -> DataFrame:
    """Every (check, facility) covered by a request for it or for its county."""
    current = in_force(suppressions, clock).select("check_name", "facility_id", "county_id")
    places = facility.select(F.col("facility_id").alias("at_facility"), F.col("county_id").alias("at_county"))
    own = current.join(places, F.col("facility_id") == F.col("at_facility"))
    by_county = current.filter(F.col("county_id").isNotNull()).select("check_name", "county_id").distinct()
    wide = by_county.join(places, F.col("county_id") == F.col("at_county"))
    pick = ["check_name", F.col("at_facility").alias("facility_id")]
    return own.select(*pick).unionByName(wide.select(*pick)).distinct()


def check_is_suppressed(pairs: DataFrame, suppressions: DataFrame, facility: DataFrame, clock: Clock) -> DataFrame:
    """Flag each asked (check_name, facility_id) pair; an unknown facility is not suppressed."""
    covered = suppressed_pairs(suppressions, facility, clock).withColumn("covered", F.lit(True))
    return pairs.join(covered, ["check_name", "facility_id"], "left").select(
        "check_name", "facility_id", F.coalesce("covered", F.lit(False)).alias("is_suppressed")
    )


def without_suppressed(findings: DataFrame, suppressions: DataFrame, facility: DataFrame, clock: Clock) -> DataFrame:
    return findings.join(
        suppressed_pairs(suppressions, facility, clock), ["check_name", "facility_id"], "left_anti"
    )
