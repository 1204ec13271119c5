"""Checking files as they land.

The row checks of one landing table run over each micro-batch of new files, and
what they find goes through the same de-duplication into the same registry as a
full run.  Checks that compare rows with other rows of their table need the
whole table and stay with the full run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sieveline.functions.time import Clock
from sieveline.operators.dedup import collapse_repeats, describe_checks, without_active
from sieveline.operators.fused_scan import row_scans
from sieveline.operators.row_rules import FACILITY_RULES, PATIENT_RULES, WORKER_RULES
from sieveline.plans.run import as_issues, log_rows, run_row
from sieveline.sources.landing import conform
from sieveline.sources.store import Store


def check_batch(batch: DataFrame, table: str, dimensions: dict[str, DataFrame], clock: Clock) -> DataFrame:
    """The collapsed findings of one table's row checks over some of its rows."""
    tables = {**dimensions, table: batch}
    parts = [build(tables, table, clock) for build, name in row_scans() if name == table]
    raised = parts[0]
    for part in parts[1:]:
        raised = raised.unionByName(part)
    return describe_checks(collapse_repeats(raised))


def batch_checks(table: str) -> list[str]:
    """Names of the row checks of a table."""
    families = (FACILITY_RULES, PATIENT_RULES, WORKER_RULES)
    return [rule.check.name for family in families for rule in family.get(table, [])]


def stream_checks(
    spark: SparkSession,
    landing_path: str,
    table: str,
    schema: StructType,
    dimensions: Callable[[], dict[str, DataFrame]],
    store: Store,
    clock: Callable[[], Clock],
    checkpoint: str,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Check every file not seen yet under `landing_path`, then stop.

    `schema` is that of the files (columns they leave out take their defaults);
    `dimensions` gives facility, patient and chw as of now.  A batch is a run of
    its own, named after the query (whose id the checkpoint keeps) and stored as a
    whole with its log and run row, so a batch replayed after a failure is not
    stored twice, and a new checkpoint starts new runs.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        run_id = f"stream-{table}-{query}-{batch_id}"
        commit = store.begin()
        if run_id in commit.runs:
            return
        now, started = clock(), Clock.system()
        rows = conform(batch, table, now)
        tables = {**dimensions(), table: rows}
        kept = without_active(check_batch(rows, table, tables, now), store.read("data_quality_issue"))
        written = store.read_parts("data_quality_issue", commit.append("data_quality_issue", as_issues(kept, run_id, now)))
        counts = written.groupBy("check_name").agg(F.count(F.lit(1)).alias("issues_raised"))
        names = [(name, 0) for name in batch_checks(table)]
        scanned = spark.createDataFrame(names, "check_name string, records_scanned bigint").withColumn(
            "records_scanned", F.lit(rows.count())
        )
        log = store.read_parts(
            "dq_check_log", commit.append("dq_check_log", log_rows(counts, scanned, run_id, started, Clock.system()))
        )
        commit.append("dq_engine_run", run_row(log, run_id, "stream", started, Clock.system()))
        commit.runs.append(run_id)
        commit.publish()

    files = spark.readStream.schema(schema).format(fmt).load(landing_path)
    return (
        files.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
