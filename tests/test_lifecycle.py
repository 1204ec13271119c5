"""Status changes: every status with every action, and batches against a row-by-row fold."""

import random

import pytest
from conftest import CLOCK, frame
from pyspark.sql import functions as F

from sieveline.operators import lifecycle

STATUSES = ["open", "confirmed", "resolved", "waived", "false_positive"]
ACTION_DDL = "action_seq bigint, issue_id string, action string, actor string, note string"
BULK_DDL = "action_seq bigint, check_name string, facility_id int, county_id int, actor string, note string"
STAMP = "2024-05-15 06:00:00+00"


def registry(spark, rows):
    base = {"check_name": "chk", "severity": "high", "source_table": "t", "detected_at": "2024-01-01 00:00:00"}
    return frame(spark, "data_quality_issue", [{**base, "resolved_by": "someone", **row} for row in rows])


def expected(action, state, blank, issue="i"):
    """(new status, start of the message)."""
    if action == "resolve":
        if state not in ("open", "confirmed"):
            return state, f"ERROR: Issue {issue} has status '{state}'"
        return (state, "ERROR: resolution_notes") if blank else ("resolved", f"OK: Issue {issue} (chk) resolved by me at {STAMP}.")
    if action == "waive":
        if state == "resolved":
            return state, f"ERROR: Issue {issue} is already resolved"
        if state == "waived":
            return state, f"WARNING: Issue {issue} is already waived"
        return (state, "ERROR: waiver_reason") if blank else ("waived", f"OK: Issue {issue} waived by me.")
    if action == "false_positive":
        return (state, "ERROR: explanation") if blank else ("false_positive", f"OK: Issue {issue} marked")
    if state == "open":
        return state, f"WARNING: Issue {issue} is already open"
    return (state, "ERROR: reason") if blank else ("open", f"OK: Issue {issue} reopened by me.")


def test_every_status_and_action(spark):
    rows, actions, wanted = [], [], {}
    for action in ("resolve", "waive", "false_positive", "reopen"):
        for state in STATUSES:
            for note in ("fixed", None, "   ", "\t"):
                issue = f"{action}-{state}-{note!r}"
                rows.append({"issue_id": issue, "status": state})
                actions.append((len(actions), issue, action, "me", note))
                wanted[issue] = expected(action, state, note in (None, "   "), issue)
    outcome = lifecycle.apply_actions(registry(spark, rows), CLOCK, spark.createDataFrame(actions, ACTION_DDL))
    after = {r.issue_id: r for r in outcome.registry.collect()}
    messages = {r.action_seq: r.message for r in outcome.messages.collect()}
    assert len(after) == len(rows) and len(messages) == len(actions)
    for seq, issue, action, _, note in actions:
        status, start = wanted[issue]
        assert after[issue].status == status
        assert messages[seq].startswith(start)
        changed = messages[seq].startswith("OK")
        assert (after[issue].updated_at is not None and str(after[issue].updated_at) == "2024-05-15 06:00:00") == changed
        if changed and action == "reopen":
            assert after[issue].resolved_by is None and after[issue].resolved_at is None
            assert after[issue].resolution_notes == f"REOPENED by me at {STAMP}: {note}"
        elif changed:
            prefix = {"resolve": "", "waive": "WAIVED: ", "false_positive": "FALSE POSITIVE: "}[action]
            assert after[issue].resolved_by == "me" and after[issue].resolution_notes == prefix + note


@pytest.mark.parametrize("seed", range(3))
def test_batches_equal_a_row_by_row_fold(spark, seed, monkeypatch):
    # Blocks of a few actions, so that statuses carry over many blocks.
    monkeypatch.setattr(lifecycle, "_BLOCK", [7, 40, 10_000][seed])
    rng = random.Random(seed)
    rows = [
        {"issue_id": f"i{n}", "status": rng.choice(STATUSES), "check_name": rng.choice(["chk", "other"]), "facility_id": rng.choice([1, 2, None]), "county_id": rng.choice([10, 20])}
        for n in range(12)
    ]
    script = []
    for seq in range(150):
        if rng.random() < 0.15:
            script.append((seq, "bulk", rng.choice(["chk", "other"]), rng.choice([None, 1, 2]), rng.choice([None, 10]), rng.choice(["n", " "])))
        else:
            script.append((seq, "one", f"i{rng.randrange(14)}", rng.choice(["resolve", "waive", "false_positive", "reopen"]), None, rng.choice(["n", "n", None])))
    state = {r["issue_id"]: r["status"] for r in rows}
    check = {r["issue_id"]: r["check_name"] for r in rows}
    wanted = {}
    for seq, kind, x, y, z, note in script:
        blank = note is None or note.strip(" ") == ""
        if kind == "bulk":
            hit = [
                r["issue_id"]
                for r in rows
                if r["check_name"] == x
                and (y is None or r["facility_id"] == y)
                and (z is None or r["county_id"] == z)
                and state[r["issue_id"]] in ("open", "confirmed")
            ]
            if blank:
                wanted[seq] = "ERROR: resolution_notes is required for bulk resolution."
            else:
                for i in hit:
                    state[i] = "resolved"
                wanted[seq] = (
                    f"OK: {len(hit)} issues for check '{x}' resolved by me. "
                    f"Scope: facility={y if y else 'all'}, county={z if z else 'all'}."
                )
        elif x not in state:
            wanted[seq] = f"ERROR: issue_id {x} not found."
        else:
            state[x], start = expected(y, state[x], blank, x)
            wanted[seq] = start.replace("(chk)", f"({check[x]})")
    actions = spark.createDataFrame([(s, x, y, "me", n) for s, k, x, y, _, n in script if k == "one"], ACTION_DDL)
    bulk = spark.createDataFrame([(s, x, y, z, "me", n) for s, k, x, y, z, n in script if k == "bulk"], BULK_DDL)
    outcome = lifecycle.apply_actions(registry(spark, rows), CLOCK, actions, bulk)
    assert {r.issue_id: r.status for r in outcome.registry.collect()} == state
    messages = {r.action_seq: r.message for r in outcome.messages.collect()}
    assert set(messages) == set(wanted)
    assert all(messages[s].startswith(wanted[s]) for s in wanted)


def test_single_issue_helpers(spark):
    reg = registry(spark, [{"issue_id": "a", "status": "open"}, {"issue_id": "b", "status": "confirmed", "facility_id": 2}])

    def status(outcome):
        return {r.issue_id: r.status for r in outcome.registry.collect()}

    assert status(lifecycle.resolve_issue(spark, reg, CLOCK, "a", "me", "done"))["a"] == "resolved"
    assert status(lifecycle.waive_issue(spark, reg, CLOCK, "a", "me", "done"))["a"] == "waived"
    assert status(lifecycle.mark_false_positive(spark, reg, CLOCK, "b", "me", "fine"))["b"] == "false_positive"
    assert status(lifecycle.reopen_issue(spark, reg, CLOCK, "b", "me", "again"))["b"] == "open"
    bulk = lifecycle.bulk_resolve_by_check(spark, reg, CLOCK, "chk", "me", "fix", facility_id=2)
    assert status(bulk) == {"a": "open", "b": "resolved"}
    assert bulk.messages.first().message == "OK: 1 issues for check 'chk' resolved by me. Scope: facility=2, county=all."


def test_false_positive_alert(spark):
    rows = [{"issue_id": f"h{i}", "status": "false_positive" if i < 3 else "open", "check_name": "high"} for i in range(10)]
    rows += [{"issue_id": f"e{i}", "status": "false_positive" if i < 2 else "open", "check_name": "even"} for i in range(10)]
    alerts = lifecycle.false_positive_alerts(registry(spark, rows)).collect()
    assert [(a.check_name, float(a.false_positive_rate_pct)) for a in alerts] == [("high", 30.0)]
    assert "rate of 30.0 percent" in alerts[0].message
    marked = spark.createDataFrame([("e1",)], "issue_id string")
    assert lifecycle.false_positive_alerts(registry(spark, rows), marked).collect() == []


def test_suppression_requests(spark):
    def ask(reason="why", until="2024-05-16", facility=1, county=None):
        rows, message = lifecycle.suppress_check(spark, CLOCK, "chk", "me", reason, until, facility, county)
        return rows.collect(), message.first().message

    rows, message = ask()
    assert message == "OK: Suppression request for check 'chk' recorded for facility=1 / county=n/a until 2024-05-16 by me."
    assert str(rows[0].valid_from) == "2024-05-15" and rows[0].is_active
    assert ask(facility=None)[1].startswith("ERROR: Either facility_id or county_id")
    assert ask(until="2024-05-15")[1] == "ERROR: valid_until must be a future date."
    assert ask(reason=" ")[0] == []


def test_equal_bulk_actions_do_not_multiply(spark):
    rows = [{"issue_id": f"i{k}", "check_name": "chk", "facility_id": k % 3, "county_id": 10, "status": "open" if k % 5 else "waived"} for k in range(50)]
    reg = registry(spark, rows)
    scopes = [(None, None), (1, None), (None, 10), (1, 10)]
    bulk = spark.createDataFrame([(seq, "chk", *scopes[seq % 4], "me", "n") for seq in range(1, 201)], BULK_DDL)
    assert lifecycle._bulk_targets(bulk, reg).count() <= 4 * 40
    touched = reg.filter("issue_id = 'i1'").select("issue_id", "check_name", "facility_id", "county_id", "status", F.lit(100).cast("bigint").alias("action_seq"))
    assert lifecycle._bulk_targets(bulk, reg, touched).count() <= 4 * 39 + 8
    outcome = lifecycle.apply_actions(reg, CLOCK, bulk=bulk)
    assert {r.status for r in outcome.registry.collect()} == {"resolved", "waived"}
    done = [r.message for r in outcome.messages.collect() if "OK: 0 issues" not in r.message]
    assert sum(int(m.split()[1]) for m in done) == 40


def test_scopes_unfold_only_for_kinds_that_are_asked(spark):
    rows = [("C", 1, 20, [1]), ("C", None, 30, [1, 2]), ("C", 4, None, [2, 3])]
    issues = spark.createDataFrame(rows, "check_name string, facility_id int, county_id int, kinds array<int>")
    found = lifecycle._with_scopes(issues, "kinds").collect()
    assert sorted((r.kind, r.in_facility, r.in_county) for r in found) == [(1, 1, 0), (2, 0, 30)]


def test_verdicts_are_computed_once_where_they_can_be_staged(spark, clock):
    registry = frame(
        spark,
        "data_quality_issue",
        [{"issue_id": i, "check_name": c, "status": "open", "facility_id": 1, "county_id": 10} for i, c in (("a", "X"), ("b", "X"), ("c", "Y"))],
    )
    actions = spark.createDataFrame(
        [(1, "a", "reopen", "u", "n"), (3, "a", "reopen", "u", "n"), (5, "z", "waive", "u", "n"), (7, "c", "resolve", "u", "n")],
        "action_seq bigint, issue_id string, action string, actor string, note string",
    )
    bulk = spark.createDataFrame(
        [(2, "X", 1, None, "u", "n"), (4, "X", None, 10, "u", "n"), (6, "W", None, None, "u", "n")],
        "action_seq bigint, check_name string, facility_id int, county_id int, actor string, note string",
    )
    staged = []

    def stage(df):
        staged.append(df.localCheckpoint())
        return staged[-1]

    outcome = lifecycle.apply_actions(registry, clock, actions, bulk, stage)
    told = {r.action_seq: r.message for r in outcome.messages.collect()}
    assert told == {r.action_seq: r.message for r in lifecycle.apply_actions(registry, clock, actions, bulk).messages.collect()}
    assert len(staged) == 1 and sorted(told) == [1, 2, 3, 4, 5, 6, 7]
    assert told[2].startswith("OK: 2 issues") and told[4].startswith("OK: 1 issues") and told[6].startswith("OK: 0 issues")
    assert {r.issue_id: r.status for r in outcome.registry.collect()} == {"a": "resolved", "b": "resolved", "c": "resolved"}
