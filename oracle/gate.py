"""SQL for the constraint gate: each rejected row with its reasons."""

from __future__ import annotations

from sieveline.sources.derived import oracle_ctes

# table -> (key, [(reason, condition)], parents {column: (table, key)}, extra unique columns)
_FAC = {"facility_id": ("facility", "facility_id")}
_PAT = {"patient_id": ("patient", "patient_id")}
GATES = {
    "patient": (
        "patient_id",
        [
            ("check:death_after_birth", "date_of_death < date_of_birth"),
            ("check:enrolled_before_death", "date_enrolled > date_of_death"),
        ],
        _FAC,
        ["nupi_number"],
    ),
    "art_enrollment": ("enrollment_id", [], {**_FAC, **_PAT}, []),
    "viral_load": ("vl_id", [("check:result_after_sample", "result_date < sample_date")], {**_FAC, **_PAT}, []),
    "art_visit": (
        "visit_id",
        [
            ("check:adherence_range", "adherence_score NOT BETWEEN 0 AND 100"),
            ("check:appointment_after_visit", "next_appointment <= visit_date"),
        ],
        {**_FAC, **_PAT},
        [],
    ),
    "tb_case": (
        "tb_case_id",
        [
            ("check:notified_after_diagnosis", "notification_date < diagnosis_date"),
            ("check:treated_after_notification", "treatment_start < notification_date"),
        ],
        {**_FAC, **_PAT},
        [],
    ),
    "anc_visit": (
        "anc_visit_id",
        [
            ("check:visit_number_range", "anc_visit_number NOT BETWEEN 1 AND 12"),
            ("check:gestation_range", "gestational_age_wks NOT BETWEEN 4 AND 44"),
            ("check:systolic_range", "systolic_bp NOT BETWEEN 50 AND 300"),
            ("check:diastolic_range", "diastolic_bp NOT BETWEEN 30 AND 200"),
        ],
        {**_FAC, **_PAT},
        [],
    ),
    "delivery": (
        "delivery_id",
        [("check:birth_weight_range", "birth_weight_g NOT BETWEEN 200 AND 8000")],
        {**_FAC, **_PAT},
        [],
    ),
    "chw": ("chw_id", [("missing:chw_code", "chw_code IS NULL")], _FAC, ["chw_code"]),
    "chw_service_record": ("service_id", [], {"chw_id": ("chw", "chw_id")}, []),
    "aggregate_report": (
        "report_id",
        [
            ("check:month_range", "period_month NOT BETWEEN 1 AND 12"),
            ("check:period_type_domain", "period_type NOT IN ('monthly','quarterly','annual')"),
            ("check:value_not_negative", "value < 0"),
        ],
        _FAC,
        [],
    ),
    "stock_record": (
        "stock_id",
        [
            ("check:stockout_days_range", "days_out_of_stock NOT BETWEEN 0 AND 31"),
            ("check:opening_not_negative", "opening_balance < 0"),
            ("check:received_not_negative", "received_qty < 0"),
            ("check:dispensed_not_negative", "dispensed_qty < 0"),
        ],
        {**_FAC, "commodity_id": ("commodity", "commodity_id")},
        [],
    ),
    "county": ("county_id", [("missing:county_name", "county_name IS NULL")], {}, []),
    "sub_county": ("sub_county_id", [], {"county_id": ("county", "county_id")}, []),
    "facility": (
        "facility_id",
        [("missing:facility_name", "facility_name IS NULL")],
        {"sub_county_id": ("sub_county", "sub_county_id"), "county_id": ("county", "county_id")},
        ["mfl_code"],
    ),
    "commodity": ("commodity_id", [("missing:commodity_name", "commodity_name IS NULL")], {}, []),
    "dq_check_suppression": (
        "suppression_id",
        [
            ("check:scope_given", "facility_id IS NULL AND county_id IS NULL"),
            ("check:ends_after_start", "valid_until <= valid_from"),
        ],
        {**_FAC, "county_id": ("county", "county_id")},
        [],
    ),
}


def rejected(table: str) -> str:
    key, conditions, parents, unique = GATES[table]
    flags = [f"CASE WHEN {cond} THEN '{reason}' END" for reason, cond in conditions]
    for column in [key, *unique]:
        flags.append(f"CASE WHEN {column} IS NOT NULL AND count(*) OVER (PARTITION BY {column}) > 1 THEN 'duplicate:{column}' END")
    for column, (parent, parent_key) in parents.items():
        flags.append(
            f"CASE WHEN {column} IS NOT NULL AND {column} NOT IN (SELECT {parent_key} FROM {parent}) THEN 'parent:{column}' END"
        )
    tables = dict.fromkeys([table, *[parent for parent, _ in parents.values()]])
    return f"""{oracle_ctes(*tables)},
judged AS (SELECT {key} AS record_id, array_to_string(list_sort(list_filter([{", ".join(flags)}], lambda x: x IS NOT NULL)), ',') AS reasons
  FROM {table})
SELECT record_id, reasons FROM judged WHERE reasons <> ''"""


def promoted_patients() -> str:
    """Patients whose parents are accepted themselves and that break nothing, those of unknown sex corrected and stamped."""
    return f"""WITH patients AS ({oracle_ctes("patient")} SELECT * FROM patient),
bad AS ({rejected("patient")}), bad_places AS ({rejected("facility")})
SELECT patient_id, facility_id, nupi_number, CASE WHEN sex = 'unknown' THEN 'intersex' ELSE sex END AS sex,
  CASE WHEN sex = 'unknown' THEN '2001-08-15 00:00:00' ELSE '2024-05-15 00:00:00' END AS updated_at
FROM patients WHERE patient_id NOT IN (SELECT record_id FROM bad WHERE record_id IS NOT NULL)
  AND facility_id NOT IN (SELECT record_id FROM bad_places)"""


def set_aside(*tables: str) -> str:
    return " UNION ".join(
        f"SELECT DISTINCT '{table}' AS table_name, CAST(record_id AS VARCHAR) AS record_id, reasons FROM ({rejected(table)}) AS r_{table}"
        for table in tables
    )
