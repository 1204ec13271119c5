import pytest
from conftest import CLOCK, frame

from sieveline.sources.landing import add_new_keys, read_table, upsert_patients
from sieveline.sources.schemas import SCHEMAS
from sieveline.sources.store import export


def test_defaults_apply_only_to_absent_columns(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2)], "tb_case_id string, facility_id int").write.parquet(
        str(tmp_path / "raw" / "tb_case")
    )
    df = read_table(spark, str(tmp_path), "tb_case", CLOCK)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SCHEMAS["tb_case"]]
    row = df.first()
    assert (row.treatment_outcome, row.case_type, row.data_source, row.site) == ("on_treatment", "new", "DHIS2", None)
    assert str(row.created_at) == "2024-05-15 06:00:00"
    spark.createDataFrame([("a", None)], "tb_case_id string, treatment_outcome string").write.parquet(
        str(tmp_path / "canonical" / "tb_case")
    )
    assert read_table(spark, str(tmp_path), "tb_case", CLOCK, layer="canonical").first().treatment_outcome is None
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path), "tb_case", CLOCK, layer="other")


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
def test_formats_round_trip(spark, tmp_path, fmt):
    df = frame(
        spark,
        "stock_record",
        [{"stock_id": "a, \"b\"", "facility_id": 1, "record_date": "2024-01-31", "closing_balance": 12.5, "days_out_of_stock": 3}],
    )
    export(df, str(tmp_path / "raw" / "stock_record"), fmt)
    back = read_table(spark, str(tmp_path), "stock_record", CLOCK, fmt=fmt)
    assert back.collect() == df.collect()


def test_known_reference_keys_are_skipped(spark):
    old = frame(spark, "county", [{"county_id": 1, "county_name": "One"}])
    new = frame(spark, "county", [{"county_id": 1, "county_name": "Uno"}, {"county_id": 2, "county_name": "Two"}])
    rows = {r.county_id: r.county_name for r in add_new_keys(old, new, ["county_id"]).collect()}
    assert rows == {1: "One", 2: "Two"}


def test_patient_changes_are_stamped(spark):
    base = {"facility_id": 1, "date_enrolled": "2020-01-01", "updated_at": "2020-01-01 00:00:00"}
    old = frame(spark, "patient", [{**base, "patient_id": "a"}, {**base, "patient_id": "b"}])
    new = frame(spark, "patient", [{**base, "patient_id": "b", "sex": "male"}])
    rows = {r.patient_id: (r.sex, str(r.updated_at)) for r in upsert_patients(old, new, CLOCK).collect()}
    assert rows == {"a": ("unknown", "2020-01-01 00:00:00"), "b": ("male", "2024-05-15 06:00:00")}


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
@pytest.mark.parametrize("first", [0, 1])
def test_each_extract_takes_defaults_for_what_it_lacks(spark, tmp_path, fmt, first):
    parts = [
        spark.createDataFrame([("a", True, "5"), ("b", None, "6"), ("c", None, None)], "vl_id string, is_ldl boolean, vl_result string"),
        spark.createDataFrame([("d", 7)], "vl_id string, facility_id int"),
        spark.createDataFrame([("e", 8)], "vl_id string, facility_id bigint"),
    ]
    for k, part in enumerate(parts[first:] + parts[:first]):
        export(part.coalesce(1), str(tmp_path / "raw" / "viral_load" / str(k)), fmt)
    rows = {r.vl_id: r for r in read_table(spark, str(tmp_path), "viral_load", CLOCK, fmt=fmt).collect()}
    assert {k: r.is_ldl for k, r in rows.items()} == {"a": True, "b": None, "c": None, "d": False, "e": False}
    assert (rows["b"].vl_result, rows["d"].facility_id, rows["e"].facility_id) == (6, 7, 8)


def test_winners_do_not_depend_on_position(spark):
    rows = [{"county_id": 2, "county_name": name} for name in ("Two", "Twin", "Duo")]
    old = frame(spark, "county", [{"county_id": 1, "county_name": "One"}])
    for order in (rows, rows[::-1]):
        new = frame(spark, "county", order)
        assert {r.county_name for r in add_new_keys(old, new, ["county_id"]).collect()} == {"One", "Two"}
    people = [{"patient_id": "p", "sex": sex, "updated_at": f"2024-01-0{k} 00:00:00"} for k, sex in ((1, "male"), (3, "female"), (2, "unknown"))]
    for order in (people, people[::-1]):
        found = upsert_patients(frame(spark, "patient", people[:1]), frame(spark, "patient", order), CLOCK).collect()
        assert [r.sex for r in found] == ["female"]


def test_facilities_are_known_by_their_code(spark):
    old = frame(spark, "facility", [{"facility_id": 1, "mfl_code": "M1", "facility_name": "A"}])
    new = frame(spark, "facility", [{"facility_id": 9, "mfl_code": "M1", "facility_name": "B"}])
    assert [r.facility_id for r in add_new_keys(old, new, ["mfl_code"]).collect()] == [1]


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
def test_many_files_are_looked_at_in_one_job_and_once(spark, tmp_path, fmt):
    folder = tmp_path / "raw" / "viral_load"
    kinds = ["vl_id string, is_ldl boolean", "vl_id string, facility_id int", "vl_id string"]
    for k, ddl in enumerate(kinds):
        rows = [(f"{k}-{i} +%20é", *[None if "bool" in ddl else i] * ("," in ddl)) for i in range(40)]
        export(spark.createDataFrame(rows, ddl).repartition(40), str(folder / f"kind {k}+é"), fmt)
    catalogue = str(tmp_path / "catalogue")
    jobs = []
    for n in range(2):
        spark.sparkContext.setJobGroup(f"look-{fmt}-{n}", "")
        df = read_table(spark, str(tmp_path), "viral_load", CLOCK, fmt=fmt, catalogue=catalogue)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"look-{fmt}-{n}")))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[0] <= 10 and jobs[1] <= 6  # 120 files
    rows = {r.vl_id: (r.is_ldl, r.facility_id) for r in df.collect()}
    expected = {f"{k}-{i} +%20é": ((None if fmt != "json" else False, None) if k == 0 else (False, i if k == 1 else None)) for k in range(3) for i in range(40)}
    assert rows == expected
    export(spark.createDataFrame([("new", 5)], "vl_id string, facility_id bigint").coalesce(1), str(folder / "later"), fmt)
    later = read_table(spark, str(tmp_path), "viral_load", CLOCK, fmt=fmt, catalogue=catalogue)
    assert later.count() == 121 and later.filter("vl_id = 'new'").first().facility_id == 5


def test_files_that_a_worker_cannot_open_are_read_one_by_one(spark, tmp_path, monkeypatch):
    from sieveline.sources import landing

    monkeypatch.setattr(landing, "file_kinds", lambda spark, files, fmt: spark.createDataFrame([(f, None) for f in files], "file string, kind string"))
    for k, ddl in enumerate(["vl_id string, is_ldl boolean", "vl_id string, facility_id int"]):
        export(spark.createDataFrame([(str(k), None)], ddl).coalesce(1), str(tmp_path / "raw" / "viral_load" / str(k)))
    rows = {r.vl_id: r.is_ldl for r in read_table(spark, str(tmp_path), "viral_load", CLOCK).collect()}
    assert rows == {"0": None, "1": False}
