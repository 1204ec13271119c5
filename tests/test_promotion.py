"""Promotion of landed rows into the canonical layer, and the gate's failing keys."""

import pytest
from conftest import CLOCK, frame

from sieveline.functions.time import Clock
from sieveline.operators.constraints import gate
from sieveline.plans.promotion import promote
from sieveline.sources.store import Store

LATER = Clock.at("2024-06-01 00:00:00")
PERSON = {"facility_id": 1, "date_enrolled": "2020-01-01", "sex": "male", "created_at": "2024-01-01 00:00:00", "updated_at": "2024-01-01 00:00:00"}


def people(spark, rows):
    return frame(spark, "patient", [{**PERSON, **row} for row in rows])


def canonical(store, table, *columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in store.read(table).collect())


@pytest.fixture
def places(make):
    tables = make(sub_county=[{"sub_county_id": 101, "county_id": 10, "sub_county_name": "S"}, {"sub_county_id": 102, "county_id": 10, "sub_county_name": "T"}])
    return {name: tables[name] for name in ("county", "sub_county", "facility")}


def test_batches_merge_by_key_and_others_are_set_aside(spark, places, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    rows = [{"patient_id": "a"}, {"patient_id": "b", "nupi_number": "7"}, {"patient_id": "c", "facility_id": 99}, {"patient_id": "d"}, {"patient_id": "d", "sex": "female"}]
    landed = {**places, "patient": people(spark, rows + rows[:1])}
    for _ in range(2):  # the second time the batch is stored already
        promote(store, landed, CLOCK, "one", buckets=3)
    assert canonical(store, "patient", "patient_id", "updated_at") == [("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:00")]
    assert canonical(store, "rejected_row", "table_name", "record_id", "reasons") == [
        ("patient", "c", "parent:facility_id"), ("patient", "d", "duplicate:patient_id"), ("patient", "d", "duplicate:patient_id"),
    ]
    assert store.read("facility").count() == 3
    first = store.manifest()["tables"]["patient"]
    again = [{"patient_id": "a", "updated_at": "2024-05-30 00:00:00"}, {"patient_id": "b", "nupi_number": "7", "sex": "unknown", "created_at": "2024-05-30 00:00:00"}, {"patient_id": "f"}]
    promote(store, {"patient": people(spark, again)}, LATER, "two")
    assert canonical(store, "patient", "patient_id", "sex", "created_at", "updated_at") == [
        ("a", "male", "2024-01-01 00:00:00", "2024-01-01 00:00:00"),  # the same again: untouched
        ("b", "unknown", "2024-01-01 00:00:00", "2024-06-01 00:00:00"),
        ("f", "male", "2024-01-01 00:00:00", "2024-01-01 00:00:00"),
    ]
    promote(store, {"patient": people(spark, [{"patient_id": "e", "nupi_number": "7"}])}, LATER, "taken")
    assert [(r.batch_id, r.reasons) for r in store.read("rejected_row").filter("batch_id <> 'one'").collect()] == [("taken", "duplicate:nupi_number")]
    before = store.manifest()["tables"]["patient"]
    assert before != first and all("of00003" in part for part in before)
    promote(store, {"patient": people(spark, again[:2])}, LATER, "three")
    assert store.manifest()["tables"]["patient"] == before  # nothing changed, no bucket is written


def test_only_touched_buckets_are_written(spark, places, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    promote(store, {**places, "patient": people(spark, [{"patient_id": f"p{i}"} for i in range(200)])}, CLOCK, "one", buckets=8)
    before = set(store.manifest()["tables"]["patient"])
    assert len(before) == 8
    promote(store, {"patient": people(spark, [{"patient_id": "p7", "sex": "female"}])}, LATER, "two")
    after = set(store.manifest()["tables"]["patient"])
    assert len(before - after) == len(after - before) == 1
    assert store.read("patient").count() == 200 and store.read("patient").filter("sex = 'female'").count() == 1


def test_a_promotion_that_dies_leaves_the_old_state(spark, places, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "lake"))
    monkeypatch.setattr(Store, "_publish", lambda self, commit: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        promote(store, places, CLOCK, "one")
    monkeypatch.undo()
    assert store.read("county").count() == 0
    promote(store, places, CLOCK, "one")
    assert store.read("county").count() == 2


def test_gate_shuffles_no_rows_where_no_key_fails(spark, make, tmp_path):
    stored = []

    def stage(df):
        stored.append(str(tmp_path / str(len(stored))))
        df.write.parquet(stored[-1])
        return spark.read.schema(df.schema).parquet(stored[-1])

    def visits(rows):
        base = {"patient_id": "a", "facility_id": 1, "visit_date": "2024-01-01"}
        return make(patient=[{**PERSON, "patient_id": "a"}], art_visit=[{**base, "visit_id": i, **row} for i, row in rows])

    fine = visits([("1", {}), ("2", {}), (None, {})])
    accepted, rejected = gate("art_visit", fine["art_visit"], fine, stage=stage)
    for df in (accepted, rejected):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
    assert [r.reasons for r in rejected.collect()] == ["missing:visit_id"]
    bad = visits([("1", {}), ("1", {"patient_id": "x"}), ("3", {"patient_id": None}), ("4", {"facility_id": 9})])
    judged = gate("art_visit", bad["art_visit"], bad, stage=stage)
    plan = judged[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    found = sorted((r.visit_id, r.reasons) for r in judged[1].collect())
    assert found == sorted((r.visit_id, r.reasons) for r in gate("art_visit", bad["art_visit"], bad)[1].collect())
    assert found == [("1", "duplicate:visit_id"), ("1", "duplicate:visit_id,parent:patient_id"), ("3", "missing:patient_id"), ("4", "parent:facility_id")]
