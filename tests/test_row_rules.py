"""Boundary rows of every row check: just inside, just outside, NULLs, orphans."""

import pytest

from sieveline.plans.run import one_check

P = {"patient_id": "p1", "facility_id": 1, "date_of_birth": "1980-01-01", "sex": "female", "date_enrolled": "2020-01-01"}
DEAD = {**P, "patient_id": "p2", "date_of_death": "2021-01-01", "sex": "male"}
CHILD = {**P, "patient_id": "p3", "date_of_birth": "2010-01-01"}
ADULT = {**P, "patient_id": "p4", "date_of_birth": "2009-12-31"}
PEOPLE = [P, DEAD, CHILD, ADULT]


def e(i, **more):
    return {"enrollment_id": i, "patient_id": "p1", "facility_id": 1, "art_start_date": "2020-06-01", **more}


def v(i, **more):
    return {"vl_id": i, "patient_id": "p1", "facility_id": 1, "sample_date": "2023-01-10", **more}


def a(i, **more):
    return {"visit_id": i, "patient_id": "p1", "facility_id": 1, "visit_date": "2024-05-01", **more}


def tb(i, **more):
    return {"tb_case_id": i, "facility_id": 1, "notification_date": "2023-03-01", **more}


def anc(i, **more):
    return {"anc_visit_id": i, "patient_id": "p1", "facility_id": 1, "visit_date": "2023-03-01", **more}


def d(i, **more):
    return {"delivery_id": i, "patient_id": "p1", "facility_id": 1, "delivery_date": "2023-03-01", **more}


def r(i, **more):
    return {
        "report_id": i,
        "facility_id": 1,
        "period_type": "monthly",
        "period_year": 2023,
        "period_month": 2,
        "indicator_code": "TX_NEW",
        **more,
    }


def s(i, **more):
    return {"stock_id": i, "facility_id": 1, "commodity_id": 1, "record_date": "2023-01-31", **more}


BALANCED = {"opening_balance": 100, "received_qty": 50, "dispensed_qty": 30, "losses_adjustments": 5}

# check, table, rows, ids expected
CASES = [
    ("C01", "patient", [P, {**P, "patient_id": "x", "date_of_birth": None}], {"x"}),
    ("C01", "patient", [{**P, "patient_id": "orphan", "facility_id": 99, "date_of_birth": None}], set()),
    ("C02", "patient", [P, {**P, "patient_id": "u", "sex": "unknown"}, {**P, "patient_id": "n", "sex": None}], {"u"}),
    (
        "C03",
        "tb_case",
        [
            tb("done", treatment_outcome="cured"),
            tb("going", treatment_outcome="on_treatment"),
            tb("null", treatment_outcome=None),
            tb("started", treatment_outcome="cured", treatment_start="2023-03-02"),
        ],
        {"done"},
    ),
    ("C03", "tb_case", [tb("left out")], set()),  # the default outcome is on_treatment
    ("C04", "art_enrollment", [e("w", weight_at_start=50), e("n", weight_at_start=None)], {"n"}),
    (
        "C05",
        "stock_record",
        [
            s("a", closing_balance=None, days_out_of_stock=0),
            s("b", closing_balance=None, days_out_of_stock=1),
            s("c", closing_balance=None, days_out_of_stock=None),
            s("d", closing_balance=1, days_out_of_stock=0),
        ],
        {"a"},
    ),
    (
        "C06",
        "viral_load",
        [v("a", is_ldl=False), v("b", is_ldl=None), v("c", is_ldl=True), v("d", is_ldl=False, vl_result=5)],
        {"a", "b"},
    ),
    (
        "V01",
        "patient",
        [{**P, "patient_id": "today", "date_of_birth": "2024-05-15"}, {**P, "patient_id": "next", "date_of_birth": "2024-05-16"}],
        {"next"},
    ),
    (
        "V02",
        "art_enrollment",
        [
            e("same", art_start_date="2020-01-01"),
            e("before", art_start_date="2019-12-31"),
            e("stranger", art_start_date="2019-12-31", patient_id="nobody"),
        ],
        {"before"},
    ),
    ("V03", "art_enrollment", [e("z", cd4_at_start=0), e("m", cd4_at_start=-0.1), e("n", cd4_at_start=None)], {"m"}),
    (
        "V04",
        "viral_load",
        [v("same", result_date="2023-01-10"), v("early", result_date="2023-01-09"), v("none", result_date=None)],
        {"early"},
    ),
    (
        "V05",
        "anc_visit",
        [anc("44", gestational_age_wks=44), anc("45", gestational_age_wks=45), anc("1", gestational_age_wks=1)],
        {"45"},
    ),
    ("V06", "aggregate_report", [r("0", value=0), r("-", value=-0.01), r("n", value=None)], {"-"}),
    (
        "V07",
        "art_visit",
        [a("-1", adherence_score=-1), a("0", adherence_score=0), a("100", adherence_score=100), a("101", adherence_score=101), a("n")],
        {"-1", "101"},
    ),
    (
        "V08",
        "delivery",
        [d("199", birth_weight_g=199.9), d("200", birth_weight_g=200), d("9000", birth_weight_g=9000), d("n")],
        {"199"},
    ),
    ("K01", "anc_visit", [anc("f"), anc("m", patient_id="p2"), anc("x", patient_id="nobody")], {"m"}),
    (
        "K02",
        "viral_load",
        [
            v("at", vl_category="suppressed", vl_result=1000, is_ldl=False),
            v("under", vl_category="suppressed", vl_result=999.99, is_ldl=False),
            v("ldl", vl_category="suppressed", vl_result=5000, is_ldl=True),
            v("null flag", vl_category="suppressed", vl_result=5000, is_ldl=None),
            v("other", vl_category="unsuppressed", vl_result=5000, is_ldl=False),
        ],
        {"at"},
    ),
    (
        "K03",
        "tb_case",
        [
            tb(o, treatment_outcome=o)
            for o in (
                "cured",
                "treatment_completed",
                "treatment_failed",
                "died",
                "lost_to_follow_up",
                "not_evaluated",
                "on_treatment",
            )
        ],
        {"cured", "treatment_completed", "treatment_failed", "died", "lost_to_follow_up"},
    ),
    (
        "K04",
        "delivery",
        [
            d("bad", baby_hiv_status="positive", mother_hiv_status="negative"),
            d("unknown", baby_hiv_status="positive", mother_hiv_status="unknown"),
            d("null", baby_hiv_status="positive", mother_hiv_status=None),
        ],
        {"bad"},
    ),
    (
        "K05",
        "stock_record",
        [
            s("exact", **BALANCED, closing_balance=115),
            s("one off", **BALANCED, closing_balance=116),
            s("over", **BALANCED, closing_balance=116.01),
            s("under", **BALANCED, closing_balance=113.99),
            s("no loss", **{**BALANCED, "losses_adjustments": None}, closing_balance=122),
            s("no receipt", **{**BALANCED, "received_qty": None}, closing_balance=500),
            s("no opening", **{**BALANCED, "opening_balance": None}, closing_balance=500),
        ],
        {"over", "under", "no loss"},
    ),
    (
        "K07",
        "art_enrollment",
        [
            e("on", patient_id="p2", art_start_date="2021-01-01"),
            e("after", patient_id="p2", art_start_date="2021-01-02"),
            e("alive", art_start_date="2021-01-02"),
        ],
        {"after"},
    ),
    (
        "K08",
        "patient",
        [
            {**P, "patient_id": "same", "date_enrolled": "1980-01-01"},
            {**P, "patient_id": "before", "date_enrolled": "1979-12-31"},
            {**P, "patient_id": "no dob", "date_of_birth": None},
        ],
        {"before"},
    ),
    (
        "T01",
        "tb_case",
        [tb("56", diagnosis_date="2023-01-04"), tb("57", diagnosis_date="2023-01-03"), tb("none")],
        {"57"},
    ),
    (
        "T02",
        "aggregate_report",
        [
            r("on midnight", submission_date="2023-04-29 00:00:00"),
            r("a second later", submission_date="2023-04-29 00:00:01"),
            r("quarter", submission_date="2023-12-01 00:00:00", period_type="quarterly"),
            r("bad month", submission_date="2023-12-01 00:00:00", period_month=13),
            r("none"),
        ],
        {"a second later"},
    ),
    ("R01", "aggregate_report", [r("open"), r("shut", facility_id=3), r("orphan", facility_id=99)], {"shut"}),
    (
        "P01",
        "art_visit",
        [
            a("adult 15", patient_id="p4", weight_kg=15),
            a("adult 14.9", patient_id="p4", weight_kg=14.9),
            a("child", patient_id="p3", weight_kg=4),
            a("none", patient_id="p4"),
        ],
        {"adult 14.9"},
    ),
    ("P02", "art_enrollment", [e("at", cd4_at_start=2500), e("over", cd4_at_start=2500.1)], {"over"}),
    ("P04", "viral_load", [v("at", vl_result=10000000), v("over", vl_result=10000000.01)], {"over"}),
    ("P05", "stock_record", [s("31", days_out_of_stock=31), s("32", days_out_of_stock=32)], {"32"}),
    ("P06", "anc_visit", [anc("200", systolic_bp=200), anc("201", systolic_bp=201), anc("n")], {"201"}),
]


@pytest.mark.parametrize("check,table,rows,expected", CASES, ids=[f"{c[0]}-{i}" for i, c in enumerate(CASES)])
def test_boundaries(make, clock, check, table, rows, expected):
    tables = make(**{"patient": PEOPLE, table: rows})
    found = [row.record_id for row in one_check(tables, check, clock).collect()]
    assert sorted(found) == sorted(expected)


def test_late_sync_uses_the_workers_facility(make, clock):
    record = {"service_date": "2024-01-01", "created_at": "2024-02-01 00:30:00"}
    tables = make(
        chw=[
            {"chw_id": "w1", "chw_code": "1", "facility_id": 1},
            {"chw_id": "w2", "chw_code": "2", "facility_id": None},
            {"chw_id": "w3", "chw_code": "3", "facility_id": 99},
        ],
        chw_service_record=[
            {**record, "service_id": "late", "chw_id": "w1"},
            {**record, "service_id": "placeless", "chw_id": "w2"},
            {**record, "service_id": "unknown place", "chw_id": "w3"},
            {**record, "service_id": "no worker", "chw_id": "w9"},
            {**record, "service_id": "30 days", "chw_id": "w1", "service_date": "2024-01-02"},
        ],
    )
    found = {r.record_id: (r.facility_id, r.county_id, r.raw_value) for r in one_check(tables, "T03", clock).collect()}
    assert found == {
        "late": (1, 10, "31 days lag"),
        "placeless": (None, None, "31 days lag"),
        "unknown place": (99, None, "31 days lag"),
    }


def test_missing_values_leave_no_text(make, clock):
    tables = make(patient=[{**P, "patient_id": "x", "date_of_birth": None, "nupi_number": None}])
    row = one_check(tables, "C01", clock).first()
    assert row.issue_description.startswith("Patient  has no date_of_birth.")
    assert row.raw_value is None


def test_decimal_text_keeps_its_scale(make, clock):
    tables = make(viral_load=[v("a", vl_category="suppressed", vl_result=8500, is_ldl=False)])
    assert one_check(tables, "K02", clock).first().raw_value == "result=8500.00, category=suppressed"
