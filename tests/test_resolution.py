"""Stored batches of status changes, and the registry storage below them."""

import random
import threading

import pytest
from conftest import CLOCK, frame
from pyspark.sql import functions as F

from sieveline.operators import lifecycle
from sieveline.plans.resolution import execute_actions
from sieveline.sources.schemas import SCHEMAS
from sieveline.sources.store import Store

ACTION_DDL = "action_seq bigint, issue_id string, action string, actor string, note string"
BULK_DDL = "action_seq bigint, check_name string, facility_id int, county_id int, actor string, note string"
REQUEST_DDL = "request_seq bigint, check_name string, facility_id int, county_id int, actor string, reason string, valid_until string"


def issues(spark, low, high, status="open"):
    """Issues i<low> to i<high - 1>, as wide as the registry's."""
    given = {
        "issue_id": F.concat(F.lit("i"), F.col("id").cast("string")),
        "check_name": F.concat(F.lit("chk"), (F.col("id") % 3).cast("string")),
        "facility_id": (F.col("id") % 5).cast("int"),
        "county_id": (F.col("id") % 2).cast("int"),
        "status": F.lit(status),
        "detected_at": CLOCK.now,
    }
    fields = SCHEMAS["data_quality_issue"].fields
    return spark.range(low, high).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def stored(spark, root, parts=((0, 60, "open"), (60, 90, "open"), (90, 120, "resolved"), (120, 140, "false_positive"))):
    store = Store(spark, str(root))
    for part in parts:
        store.append("data_quality_issue", issues(spark, *part))
    return store


def state(store):
    names = ["data_quality_issue", "dq_action_message", "dq_check_suppression"]
    return {name: sorted(map(str, store.read(name).collect())) for name in names}


def batch(spark):
    actions = [
        (1, "i3", "resolve", "me", "done"), (2, "i125", "waive", "me", "fine"), (3, "i95", "reopen", "me", "again"), (4, "i95", "false_positive", "me", "no fault"),
        (5, "i70", "false_positive", "me", "no fault"), (6, "nobody", "resolve", "me", "x"), (7, "i4", "resolve", "me", " "),
    ]
    bulk = [(8, "chk1", 2, None, "you", "all gone")]
    requests = [(1, "chk1", 2, None, "you", "known", "2024-07-01"), (2, "chk1", None, None, "you", "known", "2024-07-01")]
    return (
        spark.createDataFrame(actions, ACTION_DDL),
        spark.createDataFrame(bulk, BULK_DDL),
        spark.createDataFrame(requests, REQUEST_DDL).withColumn("valid_until", F.col("valid_until").cast("date")),
    )


def test_a_stored_batch_is_the_batch_applied(spark, tmp_path):
    store = stored(spark, tmp_path / "dq")
    actions, bulk, requests = batch(spark)
    outcome = lifecycle.apply_actions(store.read("data_quality_issue"), CLOCK, actions, bulk)
    registry = sorted(map(str, outcome.registry.collect()))
    messages = sorted((r.action_seq, r.message) for r in outcome.messages.collect())
    for _ in range(2):  # the second time the batch is stored already
        execute_actions(store, CLOCK, actions, bulk, requests, "b")
    assert sorted(map(str, store.read("data_quality_issue").collect())) == registry
    told = store.read("dq_action_message").collect()
    assert sorted((r.seq, r.message) for r in told if r.kind == "action") == messages
    assert sorted(r.seq for r in told if r.kind == "suppression") == [1, 2]
    assert {r.batch_id for r in told} == {"b"}
    assert [r.facility_id for r in store.read("dq_check_suppression").collect()] == [2]


def test_one_action_on_many_issues_rewrites_one_file(spark, tmp_path):
    store = stored(spark, tmp_path / "dq", [(k * 12_500, (k + 1) * 12_500, "open") for k in range(8)])
    files = lambda: {store.file_name("data_quality_issue", r.file) for r in store.read_files("data_quality_issue", store.manifest()["tables"]["data_quality_issue"]).select("file").distinct().collect()}
    before = files()
    assert len(before) >= 8
    execute_actions(store, CLOCK, spark.createDataFrame([(1, "i60000", "resolve", "me", "done")], ACTION_DDL))
    after = files()
    assert len(before - after) == 1 and len(after - before) == 2  # the others of the file, and the resolved one
    by_status = {r.status: r["count"] for r in store.read("data_quality_issue").groupBy("status").count().collect()}
    assert by_status == {"open": 99_999, "resolved": 1}
    assert store.read("data_quality_issue").select("issue_id").distinct().count() == 100_000
    store.append("data_quality_issue", issues(spark, 0, 0))
    assert store.vacuum(keep=1) >= 1
    assert files() == after and store.read("data_quality_issue").count() == 100_000


def test_a_file_of_several_is_replaced_within_its_folder(spark, tmp_path):
    store = Store(spark, str(tmp_path / "dq"))
    folder = tmp_path / "dq" / "data_quality_issue" / "commit=x"
    issues(spark, 0, 40).repartition(4, "issue_id").write.partitionBy("status").parquet(str(folder))
    commit = store.begin()
    commit.tables["data_quality_issue"] = ["commit=x/status=open"]
    commit.publish()
    execute_actions(store, CLOCK, spark.createDataFrame([(1, "i7", "waive", "me", "fine")], ACTION_DDL))
    parts = store.manifest()["tables"]["data_quality_issue"]
    assert sum(p.startswith("commit=x/status=open/") for p in parts) == 3
    execute_actions(store, CLOCK, spark.createDataFrame([(1, "i8", "waive", "me", "fine"), (2, "i7", "reopen", "me", "no")], ACTION_DDL))
    assert sorted(r.issue_id for r in store.read("data_quality_issue").filter("status = 'waived'").collect()) == ["i8"]
    assert store.read("data_quality_issue").count() == 40
    store.vacuum(keep=1)
    assert store.read("data_quality_issue").count() == 40
    left = {p.name for p in (folder / "status=open").iterdir() if p.name.endswith(".parquet")}
    assert left == {p.split("/")[-1] for p in store.manifest()["tables"]["data_quality_issue"] if p.startswith("commit=x/")}
    store.replace("data_quality_issue", issues(spark, 0, 1, "waived"), only=["open"])
    assert sorted((r.issue_id, r.status) for r in store.read("data_quality_issue").collect()) == [("i0", "waived"), ("i8", "waived")]


@pytest.mark.parametrize("stop_after", range(4))
def test_a_batch_that_dies_leaves_the_old_state(spark, tmp_path, monkeypatch, stop_after):
    store = stored(spark, tmp_path / "dq")
    before, writes = state(store), []
    write, publish = Store._write, Store._publish

    def dying(method):
        def call(self, *args):
            if len(writes) == stop_after:
                raise KeyboardInterrupt
            writes.append(args[0])
            return method(self, *args)

        return call

    monkeypatch.setattr(Store, "_write", dying(write))
    monkeypatch.setattr(Store, "_publish", dying(publish))
    with pytest.raises(KeyboardInterrupt):
        execute_actions(store, CLOCK, *batch(spark), "b")
    monkeypatch.undo()
    assert state(store) == before
    execute_actions(store, CLOCK, *batch(spark), "b")
    calm = stored(spark, tmp_path / "calm")
    execute_actions(calm, CLOCK, *batch(spark), "b")
    assert state(store) == state(calm) != before


def test_a_batch_without_effect_and_one_on_an_empty_registry(spark, tmp_path):
    store = stored(spark, tmp_path / "dq")
    parts = store.manifest()["tables"]["data_quality_issue"]
    execute_actions(store, CLOCK, spark.createDataFrame([(1, "i1", "resolve", "me", None)], ACTION_DDL))
    assert store.manifest()["tables"]["data_quality_issue"] == parts
    empty = Store(spark, str(tmp_path / "empty"))
    execute_actions(empty, CLOCK, *batch(spark))
    assert empty.read("data_quality_issue").count() == 0
    assert {r.message for r in empty.read("dq_action_message").filter("kind = 'action' AND seq = 1").collect()} == {"ERROR: issue_id i3 not found."}


@pytest.mark.parametrize("seed, block", [(1, 10_000), (2, 4), (3, 1)])
def test_alerts_and_bulk_actions_against_a_fold(spark, monkeypatch, seed, block):
    """Every marking sees the rate of its moment, and every bulk action closes what is active at its own."""
    monkeypatch.setattr(lifecycle, "_BLOCK", block)
    rng = random.Random(seed)
    rows = [
        {"issue_id": f"i{i}", "check_name": f"c{i % 3}", "facility_id": rng.choice([1, 2, None]), "county_id": rng.choice([1, 2, None]), "status": rng.choice(["open", "confirmed", "resolved", "false_positive"])}
        for i in range(30)
    ]
    now, actions, bulk, alerts, applied = {r["issue_id"]: dict(r) for r in rows}, [], [], [], {}
    for seq in range(1, 161):
        note = rng.choice(["why", "why", "why", " ", None])
        if rng.random() < 0.25:
            own = (f"c{rng.randrange(3)}", rng.choice([1, 2, None]), rng.choice([1, 2, None]))
            bulk.append((seq, *own, "you", note))
            hit = [r for r in now.values() if r["check_name"] == own[0] and own[1] in (None, r["facility_id"]) and own[2] in (None, r["county_id"]) and r["status"] in ("open", "confirmed")]
            applied[seq] = len(hit) if note == "why" else None
            for r in hit if note == "why" else []:
                r["status"] = "resolved"
            continue
        issue, action = rng.choice([*now, "nobody"]), rng.choice(["resolve", "waive", "false_positive", "false_positive", "reopen"])
        actions.append((seq, issue, action, "me", note))
        if issue not in now or note != "why":
            continue
        r = now[issue]
        if action == "resolve" and r["status"] in ("open", "confirmed"):
            r["status"] = "resolved"
        elif action == "waive" and r["status"] not in ("resolved", "waived"):
            r["status"] = "waived"
        elif action == "reopen" and r["status"] != "open":
            r["status"] = "open"
        elif action == "false_positive":
            r["status"] = "false_positive"
            own = [x["status"] == "false_positive" for x in now.values() if x["check_name"] == r["check_name"]]
            tenths = (2000 * sum(own) + len(own)) // (2 * len(own))
            if tenths > 200:
                alerts.append((seq, r["check_name"], tenths))
    registry = frame(spark, "data_quality_issue", rows)
    acts, bulks = spark.createDataFrame(actions, ACTION_DDL), spark.createDataFrame(bulk, BULK_DDL)
    judged = lifecycle.judge(registry, CLOCK, acts, bulks)
    got = lifecycle.alerts_per_marking(judged, registry).collect()
    assert sorted((r.action_seq, r.check_name, round(r.false_positive_rate_pct * 10)) for r in got) == alerts
    outcome = lifecycle.apply_actions(registry, CLOCK, acts, bulks)
    assert {r.issue_id: r.status for r in outcome.registry.collect()} == {i: r["status"] for i, r in now.items()}
    told = {r.action_seq: r.message for r in outcome.messages.collect()}
    assert len(told) == 160
    assert all(told[seq].startswith("ERROR" if n is None else f"OK: {n} issues") for seq, n in applied.items())


def test_marks_raise_no_alerts_for_other_checks(spark):
    rows = [{"issue_id": f"a{i}", "check_name": "a", "status": "open"} for i in range(4)] + [{"issue_id": "b", "check_name": "b", "status": "false_positive"}]
    registry = frame(spark, "data_quality_issue", rows)
    judged = lifecycle.judge(registry, CLOCK, spark.createDataFrame([(1, "a1", "false_positive", "me", "no")], ACTION_DDL))
    assert [r.check_name for r in lifecycle.alerts_per_marking(judged, registry).collect()] == ["a"]


def test_small_parts_are_merged_and_older_states_stay_readable(spark, tmp_path):
    store = Store(spark, str(tmp_path / "dq"))
    commit = store.begin()
    for k in range(60):
        commit.append("data_quality_issue", issues(spark, 10 * k, 10 * k + 10, ["open", "resolved"][k % 2]).coalesce(1))
        commit.append("dq_check_log", frame(spark, "dq_check_log", [{"log_id": str(k)}]))
    commit.publish()
    rows = sorted(map(str, store.read("data_quality_issue").collect()))
    old = store.manifest()["tables"]["data_quality_issue"]
    assert store.compact("data_quality_issue") == 60 and store.compact("dq_check_log") == 60
    parts = store.manifest()["tables"]
    assert len(parts["data_quality_issue"]) == 2 and len(parts["dq_check_log"]) == 1
    assert sorted(map(str, store.read("data_quality_issue").collect())) == rows
    assert sorted(map(str, store.read_parts("data_quality_issue", old).collect())) == rows
    assert store.read("dq_check_log").count() == 60
    assert store.compact("data_quality_issue") == 0
    store.vacuum(keep=1)
    assert sorted(map(str, store.read("data_quality_issue").collect())) == rows


def test_of_publishers_at_once_exactly_one_succeeds(spark, tmp_path):
    store = Store(spark, str(tmp_path / "dq"))
    for number in range(1, 9):
        won, ready = [], threading.Barrier(6)

        def publish(k, number=number, won=won, ready=ready):
            ready.wait()
            if store._create(f"{store.root}/_manifests/{number:09d}.json", f'{{"tables": {{}}, "runs": ["{k}"]}}'.encode()):
                won.append(str(k))

        threads = [threading.Thread(target=publish, args=(k,)) for k in range(6)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(won) == 1 and store.manifest()["runs"] == won
