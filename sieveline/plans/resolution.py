"""A stored batch of status changes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.time import Clock
from sieveline.operators import lifecycle
from sieveline.sources.schemas import SCHEMAS
from sieveline.sources.store import Store

ISSUES = "data_quality_issue"


def _message_rows(rows: DataFrame, kind: str, seq: str, batch_id: str, clock: Clock) -> DataFrame:
    values = {
        "batch_id": F.lit(batch_id),
        "kind": F.lit(kind),
        "seq": F.col(seq),
        "recorded_at": clock.now,
    }
    return rows.select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SCHEMAS["dq_action_message"].fields]
    )


def execute_actions(
    store: Store,
    clock: Clock,
    actions: DataFrame | None = None,
    bulk: DataFrame | None = None,
    requests: DataFrame | None = None,
    batch_id: str | None = None,
) -> str:
    """Apply single actions, bulk resolutions and suppression requests to the stored registry; returns the batch id.

    The actions are judged once and their verdicts staged; messages, alerts and changes all
    derive from these.  Only the files that hold a changed issue are written anew, with the issue now in
    the folder of its status; which files those are comes from the scan that found the issues.  Registry,
    messages and suppressions become visible at once, so a batch that dies leaves nothing, and one whose id is
    stored already is not repeated.
    """
    batch_id = batch_id or str(uuid.uuid4())
    commit = store.begin()
    if f"actions:{batch_id}" in commit.runs:
        return batch_id
    messages = []
    if actions is not None or bulk is not None:
        parts = commit.tables.get(ISSUES, [])
        registry = store.read_files(ISSUES, parts)
        judged = commit.stage(lifecycle.judge(registry, clock, actions, bulk, ["file"]))
        changes = commit.stage(lifecycle.changed_issues(judged, clock, ["file"]))
        files = [store.file_name(ISSUES, row.file) for row in changes.select("file").distinct().collect()]
        told = lifecycle.batch_messages(judged, clock, actions, bulk)
        messages.append(_message_rows(told, "action", "action_seq", batch_id, clock))
        if actions is not None:
            alerts = lifecycle.alerts_per_marking(judged, store.read_parts(ISSUES, parts))
            messages.append(_message_rows(alerts, "alert", "action_seq", batch_id, clock))
        if files:
            touched = store.read_parts(ISSUES, files)
            commit.rewrite(ISSUES, files, lifecycle.with_changes(touched, changes.drop("file"), clock))
    if requests is not None:
        rows, told = lifecycle.suppress_checks(requests, clock)
        commit.append("dq_check_suppression", rows)
        messages.append(_message_rows(told, "suppression", "request_seq", batch_id, clock))
    if messages:
        commit.append("dq_action_message", reduce(DataFrame.unionByName, messages))
    commit.runs.append(f"actions:{batch_id}")
    commit.publish()
    return batch_id
