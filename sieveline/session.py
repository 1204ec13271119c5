"""Session settings the jobs are designed for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: Settings that change results.  They are applied to any session handed in.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

#: Settings that change plans only.  Joins carry no broadcast hints: a side is
#: broadcast when its (estimated or measured) size is below the thresholds and
#: is sort-merge joined beyond them, where skewed partitions are split.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # A full run compiles more classes than the default cache of 100 holds.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the result-changing options on an existing session."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new one where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="sieveline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def build_session(
    app_name: str = "sieveline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session; `shuffle_partitions` is an upper bound that AQE coalesces."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = {**RESULT_SETTINGS, **PLAN_SETTINGS, **(extra or {})}
    if shuffle_partitions:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
