"""Column types, landing defaults and value domains of every table."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Column names and types of the tables users already have.
_DDL = {
    "county": "county_id int, county_name string, region string, created_at timestamp",
    "sub_county": "sub_county_id int, sub_county_name string, county_id int, created_at timestamp",
    "facility": (
        "facility_id int, mfl_code string, facility_name string, facility_type string, ownership string, "
        "sub_county_id int, county_id int, latitude decimal(9,6), longitude decimal(9,6), is_active boolean, "
        "dhis2_org_unit string, opened_date date, closed_date date, created_at timestamp, updated_at timestamp"
    ),
    "commodity": "commodity_id int, commodity_name string, category string, unit string, is_tracer boolean",
    "patient": (
        "patient_id string, facility_id int, nupi_number string, date_of_birth date, sex string, "
        "county_of_birth int, date_enrolled date, date_of_death date, is_transferred_out boolean, "
        "transfer_out_date date, data_source string, created_at timestamp, updated_at timestamp"
    ),
    "art_enrollment": (
        "enrollment_id string, patient_id string, facility_id int, art_start_date date, entry_point string, "
        "who_stage_at_start int, cd4_at_start decimal(6,1), weight_at_start decimal(5,1), "
        "height_at_start decimal(5,1), initial_regimen string, is_active boolean, created_at timestamp"
    ),
    "viral_load": (
        "vl_id string, patient_id string, facility_id int, enrollment_id string, sample_date date, "
        "result_date date, vl_result decimal(10,2), is_ldl boolean, vl_category string, "
        "ordering_clinician string, lab_name string, data_source string, created_at timestamp"
    ),
    "art_visit": (
        "visit_id string, patient_id string, facility_id int, visit_date date, next_appointment date, "
        "weight_kg decimal(5,1), current_regimen string, days_dispensed int, adherence_score int, "
        "clinician_notes string, data_source string, created_at timestamp"
    ),
    "tb_case": (
        "tb_case_id string, patient_id string, facility_id int, case_number string, notification_date date, "
        "diagnosis_date date, case_type string, site string, smear_result string, xpert_result string, "
        "hiv_status_at_dx string, on_art_at_dx boolean, treatment_start date, treatment_outcome string, "
        "outcome_date date, data_source string, created_at timestamp"
    ),
    "anc_visit": (
        "anc_visit_id string, patient_id string, facility_id int, visit_date date, anc_visit_number int, "
        "gestational_age_wks int, weight_kg decimal(5,1), muac_cm decimal(4,1), systolic_bp int, "
        "diastolic_bp int, hiv_test_done boolean, hiv_result string, syphilis_test_done boolean, "
        "syphilis_result string, iron_given boolean, data_source string, created_at timestamp"
    ),
    "delivery": (
        "delivery_id string, patient_id string, facility_id int, delivery_date date, delivery_mode string, "
        "birth_outcome string, birth_weight_g decimal(6,1), gestational_age_wks int, baby_hiv_status string, "
        "mother_hiv_status string, apgar_1min int, apgar_5min int, data_source string, created_at timestamp"
    ),
    "chw": (
        "chw_id string, chw_code string, full_name string, facility_id int, sub_county_id int, "
        "is_active boolean, start_date date, created_at timestamp"
    ),
    "chw_service_record": (
        "service_id string, chw_id string, patient_id string, service_date date, service_type string, "
        "outcome string, gps_latitude decimal(9,6), gps_longitude decimal(9,6), data_source string, "
        "created_at timestamp"
    ),
    "aggregate_report": (
        "report_id string, facility_id int, period_type string, period_year int, period_month int, "
        "period_quarter int, indicator_code string, numerator decimal(10,2), denominator decimal(10,2), "
        "value decimal(10,2), submission_date timestamp, submitted_by string, data_source string, "
        "created_at timestamp"
    ),
    "stock_record": (
        "stock_id string, facility_id int, commodity_id int, record_date date, opening_balance decimal(10,2), "
        "received_qty decimal(10,2), dispensed_qty decimal(10,2), losses_adjustments decimal(10,2), "
        "closing_balance decimal(10,2), days_out_of_stock int, data_source string, created_at timestamp"
    ),
    "data_quality_issue": (
        "issue_id string, check_name string, check_category string, severity string, source_table string, "
        "source_column string, record_id string, facility_id int, county_id int, issue_description string, "
        "raw_value string, expected_value string, status string, resolved_by string, resolved_at timestamp, "
        "resolution_notes string, check_run_id string, data_source string, period_year int, period_month int, "
        "detected_at timestamp, updated_at timestamp"
    ),
    "dq_engine_run": (
        "run_id string, run_started_at timestamp, run_completed_at timestamp, triggered_by string, "
        "checks_executed int, issues_found bigint, issues_resolved bigint, run_notes string"
    ),
    "dq_check_log": (
        "log_id string, run_id string, check_name string, check_category string, severity string, "
        "source_table string, started_at timestamp, completed_at timestamp, records_scanned bigint, "
        "issues_raised bigint, error_message string, sql_query string"
    ),
    "data_quality_issue_member": "issue_id string, check_run_id string, record_id string",
    "dq_check_suppression": (
        "suppression_id string, check_name string, facility_id int, county_id int, suppressed_by string, "
        "suppressed_at timestamp, suppression_reason string, valid_from date, valid_until date, "
        "is_active boolean"
    ),
    "rejected_row": "batch_id string, table_name string, record_id string, reasons string, content string, rejected_at timestamp",
    "dq_action_message": "batch_id string, kind string, seq bigint, message string, recorded_at timestamp",
}

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _schema(ddl: str) -> T.StructType:
    """A schema without needing a running session; every column may be NULL."""
    fields = []
    for name, kind in re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", ddl):
        digits = re.findall(r"\d+", kind)
        datatype = T.DecimalType(*map(int, digits)) if kind.startswith("decimal") else _TYPES[kind]
        fields.append(T.StructField(name, datatype, True))
    return T.StructType(fields)


SCHEMAS: dict[str, T.StructType] = {name: _schema(ddl) for name, ddl in _DDL.items()}

FACT_TABLES = [
    "patient",
    "art_enrollment",
    "viral_load",
    "art_visit",
    "tb_case",
    "anc_visit",
    "delivery",
    "chw",
    "chw_service_record",
    "aggregate_report",
    "stock_record",
]
REFERENCE_TABLES = ["county", "sub_county", "facility", "commodity"]

#: Marks a default of "the moment of loading".
NOW = object()

# What a column holds when an extract leaves it out.
DEFAULTS: dict[str, dict[str, object]] = {
    "county": {"created_at": NOW},
    "sub_county": {"created_at": NOW},
    "facility": {"is_active": True, "created_at": NOW, "updated_at": NOW},
    "commodity": {"is_tracer": False},
    "patient": {
        "sex": "unknown",
        "is_transferred_out": False,
        "data_source": "KenyaEMR",
        "created_at": NOW,
        "updated_at": NOW,
    },
    "art_enrollment": {"is_active": True, "created_at": NOW},
    "viral_load": {"is_ldl": False, "data_source": "lab_LIMS", "created_at": NOW},
    "art_visit": {"data_source": "KenyaEMR", "created_at": NOW},
    "tb_case": {
        "case_type": "new",
        "hiv_status_at_dx": "unknown",
        "treatment_outcome": "on_treatment",
        "data_source": "DHIS2",
        "created_at": NOW,
    },
    "anc_visit": {
        "hiv_test_done": False,
        "hiv_result": "unknown",
        "syphilis_test_done": False,
        "iron_given": False,
        "data_source": "KenyaEMR",
        "created_at": NOW,
    },
    "delivery": {
        "baby_hiv_status": "unknown",
        "mother_hiv_status": "unknown",
        "data_source": "KenyaEMR",
        "created_at": NOW,
    },
    "chw": {"is_active": True, "created_at": NOW},
    "chw_service_record": {"data_source": "mobile_CHW", "created_at": NOW},
    "aggregate_report": {"data_source": "DHIS2", "created_at": NOW},
    "stock_record": {
        "received_qty": 0,
        "dispensed_qty": 0,
        "losses_adjustments": 0,
        "days_out_of_stock": 0,
        "data_source": "DHIS2",
        "created_at": NOW,
    },
}

# Allowed codes.
SEX = ["male", "female", "intersex", "unknown"]
HIV_STATUS = ["positive", "negative", "unknown", "not_tested"]
REGIMEN = ["TLD", "TLE", "AZT_3TC_NVP", "ABC_3TC_LPV", "DTG_based_other", "other"]
TB_OUTCOME = [
    "cured",
    "treatment_completed",
    "treatment_failed",
    "died",
    "lost_to_follow_up",
    "not_evaluated",
    "on_treatment",
]
TB_CASE_TYPE = [
    "new",
    "relapse",
    "treatment_after_failure",
    "treatment_after_ltfu",
    "other_previously_treated",
    "unknown",
]
CHANNEL = ["DHIS2", "KenyaEMR", "KHIS", "OpenMRS", "paper_CIF", "mobile_CHW", "lab_LIMS", "manual_entry"]
STATUS = ["open", "confirmed", "resolved", "waived", "false_positive"]
