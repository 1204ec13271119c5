"""The check catalogue as text.

Fixed values: every name, severity, expected value and message below is part of
the output contract and is stated as text, in catalogue order.  Slots are
column names of the checked row; `p_` marks the joined patient, `f_` the joined
facility.  A missing value fills its slot with empty text.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Check:
    id: str
    name: str
    category: str
    severity: str
    table: str
    column: str
    raw: str | None
    expected: str
    message: str


# ---- fixed values: begin ----------------------------------------------------
CHECKS = [
    Check(
        "C01", "C01_patient_missing_dob", "completeness", "high", "patient", "date_of_birth",
        None,
        "A valid date ≤ today",
        "Patient {nupi_number} has no date_of_birth. Age band disaggregation and paediatric dosing checks will fail.",
    ),
    Check(
        "C02", "C02_patient_sex_unknown", "completeness", "medium", "patient", "sex",
        "{sex}",
        "male | female | intersex",
        "Patient {nupi_number} has sex = 'unknown'. Required for disaggregated reporting.",
    ),
    Check(
        "C03", "C03_tb_missing_treatment_start", "completeness", "critical", "tb_case", "treatment_start",
        None,
        "A date ≥ notification_date",
        "TB case {case_number} notified {notification_date} has no treatment_start_date. Outcome = {treatment_outcome}. Cohort analysis blocked.",
    ),
    Check(
        "C04", "C04_art_missing_weight", "completeness", "medium", "art_enrollment", "weight_at_start",
        None,
        "Weight in kg (expected range: 5–150)",
        "ART enrollment {enrollment_id} (patient {patient_id}, started {art_start_date}) has no weight_at_start.",
    ),
    Check(
        "C05", "C05_stock_missing_closing_balance", "completeness", "high", "stock_record", "closing_balance",
        None,
        "Non-negative numeric value",
        "Stock record for commodity_id={commodity_id} at facility {f_facility_name} on {record_date} has NULL closing_balance with no stockout indicator.",
    ),
    Check(
        "C06", "C06_vl_result_missing_without_ldl", "completeness", "high", "viral_load", "vl_result",
        None,
        "A numeric vl_result or is_ldl = TRUE",
        "Viral-load record {vl_id} for patient {patient_id} has no result and is not marked as LDL.",
    ),
    Check(
        "V01", "V01_patient_dob_future", "validity", "critical", "patient", "date_of_birth",
        "{date_of_birth}",
        "Date ≤ {today}",
        "Patient {nupi_number} has date_of_birth {date_of_birth} which is in the future (today = {today}). Likely data entry error.",
    ),
    Check(
        "V02", "V02_art_start_before_enrollment", "validity", "critical", "art_enrollment", "art_start_date",
        "{art_start_date}",
        "Date ≥ patient.date_enrolled ({p_date_enrolled})",
        "ART enrollment {enrollment_id}: art_start_date ({art_start_date}) is before patient enrollment_date ({p_date_enrolled}). Delta = {days} days.",
    ),
    Check(
        "V03", "V03_negative_cd4_count", "validity", "critical", "art_enrollment", "cd4_at_start",
        "{cd4_at_start}",
        "Non-negative number (0–2000 cells/µL typical)",
        "ART enrollment {enrollment_id} has cd4_at_start = {cd4_at_start}. CD4 count cannot be negative.",
    ),
    Check(
        "V04", "V04_vl_result_before_sample", "validity", "high", "viral_load", "result_date",
        "{result_date}",
        "Date ≥ sample_date ({sample_date})",
        "Viral load {vl_id}: result_date ({result_date}) is {days} days before sample_date ({sample_date}).",
    ),
    Check(
        "V05", "V05_anc_gestational_age_impossible", "validity", "high", "anc_visit", "gestational_age_wks",
        "{gestational_age_wks}",
        "4–44 weeks",
        "ANC visit {anc_visit_id} recorded gestational_age_wks = {gestational_age_wks} which exceeds the maximum possible human gestation of 44 weeks.",
    ),
    Check(
        "V06", "V06_aggregate_negative_value", "validity", "high", "aggregate_report", "value",
        "{value}",
        "≥ 0",
        "Aggregate report for {indicator_code} at {f_facility_name} ({period_year}-{period_month}) has value = {value}. Counts cannot be negative.",
    ),
    Check(
        "V07", "V07_adherence_score_out_of_range", "validity", "medium", "art_visit", "adherence_score",
        "{adherence_score}",
        "0 to 100 inclusive",
        "ART visit {visit_id} has adherence_score = {adherence_score}, which is outside the valid range 0–100.",
    ),
    Check(
        "V08", "V08_birth_weight_below_minimum", "validity", "high", "delivery", "birth_weight_g",
        "{birth_weight_g}",
        "200g – 8000g",
        "Delivery {delivery_id} on {delivery_date} has birth_weight_g = {birth_weight_g}g. Minimum clinically viable weight is 200g.",
    ),
    Check(
        "K01", "K01_anc_on_male_patient", "consistency", "high", "anc_visit", "patient_id",
        "{p_sex}",
        "female",
        "ANC visit {anc_visit_id} (date: {visit_date}) is recorded for patient {p_nupi_number} whose sex = 'male'. ANC services apply only to female patients.",
    ),
    Check(
        "K02", "K02_vl_suppressed_mislabeled", "consistency", "critical", "viral_load", "vl_category",
        "result={vl_result}, category=suppressed",
        "vl_category = 'unsuppressed' for result ≥ 1000",
        "Viral load {vl_id} has vl_result = {vl_result} copies/mL but vl_category = 'suppressed'. WHO threshold is <1000 copies/mL.",
    ),
    Check(
        "K03", "K03_tb_cured_no_treatment_start", "consistency", "high", "tb_case", "treatment_start",
        None,
        "treatment_start must be populated when outcome ≠ on_treatment",
        "TB case {case_number} has outcome = '{treatment_outcome}' but treatment_start is NULL. A successful outcome requires a treatment start date.",
    ),
    Check(
        "K04", "K04_mtct_inconsistency", "consistency", "high", "delivery", "baby_hiv_status",
        "baby=positive, mother=negative",
        "If baby is HIV-positive, mother must be HIV-positive or unknown",
        "Delivery {delivery_id} ({delivery_date}): baby_hiv_status = 'positive' but mother_hiv_status = 'negative'. MTCT cannot occur if mother is HIV-negative.",
    ),
    Check(
        "K05", "K05_stock_balance_arithmetic", "consistency", "high", "stock_record", "closing_balance",
        "{closing_balance}",
        "{computed}",
        "Stock record {stock_id}: closing_balance = {closing_balance} but arithmetic gives {computed} (delta = {delta}). Facility: {f_facility_name}, commodity_id: {commodity_id}, date: {record_date}.",
    ),
    Check(
        "K06", "K06_pos_exceeds_total_tests", "consistency", "critical", "aggregate_report", "HTS_TST_POS",
        "{positives}",
        "≤ HTS_TST ({tested})",
        "Facility {f_facility_name} in {period_year}-{period_month}: HTS_TST_POS ({positives}) exceeds HTS_TST ({tested}). Positives cannot exceed total tests.",
    ),
    Check(
        "K07", "K07_art_after_death", "consistency", "critical", "art_enrollment", "art_start_date",
        "{art_start_date}",
        "Date ≤ patient.date_of_death ({p_date_of_death})",
        "ART enrollment {enrollment_id}: art_start_date ({art_start_date}) is after patient date_of_death ({p_date_of_death}).",
    ),
    Check(
        "K08", "K08_patient_enrolled_before_birth", "consistency", "high", "patient", "date_enrolled",
        "{date_enrolled}",
        "date_enrolled >= date_of_birth",
        "Patient {nupi_number} was enrolled on {date_enrolled} before recorded date_of_birth {date_of_birth}.",
    ),
    Check(
        "T01", "T01_tb_notification_delay", "timeliness", "high", "tb_case", "notification_date",
        "{days} days",
        "≤ 56 days from diagnosis",
        "TB case {case_number}: notification_date ({notification_date}) is {days} days after diagnosis_date ({diagnosis_date}). Threshold is 56 days.",
    ),
    Check(
        "T02", "T02_aggregate_late_submission", "timeliness", "high", "aggregate_report", "submission_date",
        "{days} days late",
        "≤ 60 days after period end",
        "Aggregate report for {indicator_code} at {f_facility_name}: submitted {days} days after period end ({period_end}). Threshold = 60 days.",
    ),
    Check(
        "T03", "T03_chw_late_sync", "timeliness", "medium", "chw_service_record", "created_at",
        "{days} days lag",
        "≤ 30 days from service_date",
        "CHW service record {service_id}: created_at ({created_on}) is {days} days after service_date ({service_date}). CHW={chw_id}.",
    ),
    Check(
        "T04", "T04_art_patient_overdue", "timeliness", "medium", "art_visit", "next_appointment",
        "overdue by {days} days",
        "Visit within 90 days of next_appointment",
        "Patient {p_nupi_number}: last visit {last_visit}, next_appointment was {last_appointment} ({days} days ago). No visit recorded since. Possible LTFU.",
    ),
    Check(
        "U01", "U01_duplicate_patient", "uniqueness", "high", "patient", "patient_id",
        "pid_a={partner_id}, pid_b={patient_id}",
        "Each patient should have a unique NUPI and a single active record",
        "Possible duplicate patient: patient {partner_id} and {patient_id} share facility_id={facility_id}, DOB={date_of_birth}, sex={sex} and enrolled within 14 days.",
    ),
    Check(
        "U02", "U02_duplicate_tb_case_number", "uniqueness", "medium", "tb_case", "case_number",
        "{case_number}",
        "Unique case_number per county",
        "TB case number '{case_number}' appears {copies} times in county_id={county_id}. Lowest id: {first_id}",
    ),
    Check(
        "U03", "U03_duplicate_aggregate_report", "uniqueness", "high", "aggregate_report", "indicator_code",
        "{copies} submissions",
        "1 submission per facility-period-indicator",
        "Indicator {indicator_code} at facility {f_facility_name} for {period_year}-{period_month} has {copies} submissions. Duplicate submissions inflate aggregate totals.",
    ),
    Check(
        "R01", "R01_report_for_inactive_facility", "referential", "medium", "aggregate_report", "facility_id",
        "facility_id={facility_id} (inactive)",
        "Only active facilities should submit reports",
        "Aggregate report for {indicator_code} at facility '{f_facility_name}' (mfl={f_mfl_code}), which is marked inactive (closed). Reporting should have ceased.",
    ),
    Check(
        "P01", "P01_adult_weight_implausible", "plausibility", "high", "art_visit", "weight_kg",
        "{weight_kg}",
        "≥ 15kg for adults (DOB < 2010-01-01)",
        "ART visit {visit_id}: adult patient (DOB={p_date_of_birth}) has weight_kg = {weight_kg}. Minimum plausible adult weight is 15kg.",
    ),
    Check(
        "P02", "P02_cd4_implausibly_high", "plausibility", "medium", "art_enrollment", "cd4_at_start",
        "{cd4_at_start}",
        "≤ 2500 cells/µL (typical ART initiation range: 0–1500)",
        "ART enrollment {enrollment_id}: cd4_at_start = {cd4_at_start} cells/µL. Values >2500 are implausible; verify whether a CD4% was entered as an absolute count.",
    ),
    Check(
        "P03", "P03_tx_curr_jump", "plausibility", "high", "aggregate_report", "TX_CURR",
        "{value}",
        "≤ {doubled} (200% of previous month)",
        "TX_CURR at {f_facility_name} jumped from {previous} ({period_year}-{month_before}) to {value} ({period_year}-{period_month}): a {growth}% increase. Threshold = 200%.",
    ),
    Check(
        "P04", "P04_vl_implausibly_high", "plausibility", "medium", "viral_load", "vl_result",
        "{vl_result}",
        "≤ 10,000,000 copies/mL",
        "Viral load {vl_id}: vl_result = {vl_result} copies/mL exceeds the upper detection limit of most assays (10,000,000). Probable transcription error.",
    ),
    Check(
        "P05", "P05_days_stockout_exceeds_month", "plausibility", "high", "stock_record", "days_out_of_stock",
        "{days_out_of_stock}",
        "0–31 days",
        "Stock record {stock_id} at {f_facility_name}: days_out_of_stock = {days_out_of_stock} which exceeds the maximum possible days in a month (31).",
    ),
    Check(
        "P06", "P06_anc_systolic_bp_extreme", "plausibility", "critical", "anc_visit", "systolic_bp",
        "{systolic_bp}",
        "< 200 mmHg (expected normal: 90–140)",
        "ANC visit {anc_visit_id} ({visit_date}): systolic_bp = {systolic_bp} mmHg. Values >200 mmHg indicate hypertensive crisis or data entry error. Requires immediate clinical review.",
    ),
]

# Thresholds used by the checks.
MAX_GESTATION_WEEKS = 44
ADHERENCE_RANGE = (0, 100)
MIN_BIRTH_WEIGHT_G = 200
SUPPRESSION_LIMIT = 1000
STOCK_TOLERANCE = 1
TB_NOTIFICATION_DAYS = 56
REPORT_LATE_DAYS = 60
CHW_SYNC_DAYS = 30
OVERDUE_DAYS = 90
DUPLICATE_ENROLMENT_DAYS = 14
ADULT_BORN_BEFORE = "2010-01-01"
MIN_ADULT_WEIGHT_KG = 15
MAX_CD4 = 2500
MAX_VIRAL_LOAD = 10_000_000
MAX_STOCKOUT_DAYS = 31
MAX_SYSTOLIC_BP = 200
FINISHED_TB_OUTCOMES = ["cured", "treatment_completed", "treatment_failed", "died", "lost_to_follow_up"]
EMR_CHANNEL = "KenyaEMR"
REPORTING_CHANNEL = "DHIS2"
# ---- fixed values: end ------------------------------------------------------

BY_ID = {check.id: check for check in CHECKS}
BY_NAME = {check.name: check for check in CHECKS}
