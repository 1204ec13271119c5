"""Domain tables projected from the provided star-schema tables.

Each table is plain SQL over the whole source tables, accepted by Spark and by
the SQL oracle alike.  Modular arithmetic plants missing values, boundary and
out-of-range values, orphan keys and duplicates.  `{name}` stands for a source
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sieveline.functions.time import Clock
from sieveline.sources.landing import conform
from sieveline.sources.schemas import SCHEMAS

CHECK_CLOCK = Clock.at("2024-05-15")
REGISTRY_CLOCK = Clock.at("2001-08-15")

_NF = "(SELECT count(*) FROM {supplier})"
_NP = "(SELECT count(*) FROM {part})"
_ORDER_FACILITY = f"CASE WHEN o_orderkey%211=17 THEN -1 ELSE CAST(o_custkey%{_NF} AS INT) END"

SQL: dict[str, str] = {}

SQL["county"] = """
SELECT n_nationkey AS county_id, n_name AS county_name, r_name AS region
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

SQL["facility"] = """
SELECT CAST(s_suppkey AS INT) AS facility_id,
       'F' || lpad(CAST(s_suppkey AS STRING),6,'0') AS mfl_code,
       s_name AS facility_name,
       CASE s_suppkey%3 WHEN 0 THEN 'hospital' WHEN 1 THEN 'dispensary' ELSE 'health centre' END AS facility_type,
       CASE s_suppkey%2 WHEN 0 THEN 'public' ELSE 'private' END AS ownership,
       CAST(s_nationkey*10+s_suppkey%3 AS INT) AS sub_county_id,
       s_nationkey AS county_id,
       s_suppkey%7<>3 AS is_active
FROM {supplier}"""

SQL["commodity"] = """
SELECT CAST(p_partkey AS INT) AS commodity_id, p_name AS commodity_name, p_type AS category,
       p_size<=25 AS is_tracer
FROM {part}"""

_PATIENT_COLUMNS = f"""
       CAST(c_custkey%{_NF} AS INT) AS facility_id,
       'N' || lpad(CAST(c_custkey AS STRING),9,'0') AS nupi_number,
       CASE WHEN c_custkey%41=0 THEN NULL WHEN c_custkey%97=5 THEN DATE '2035-06-15'
            ELSE DATE '1950-01-01' + CAST((c_custkey*37)%22000 AS INT) END AS date_of_birth,
       CASE WHEN c_custkey%29=3 THEN 'unknown' WHEN c_custkey%3=0 THEN 'male' ELSE 'female' END AS sex"""
_PATIENT_TAIL = """
       CASE WHEN c_custkey%23=4 THEN DATE '1998-06-01' + CAST(c_custkey%1000 AS INT) ELSE NULL END AS date_of_death,
       CASE WHEN c_custkey%19=2 THEN TRUE WHEN c_custkey%31=5 THEN NULL ELSE FALSE END AS is_transferred_out,
       CASE c_custkey%3 WHEN 0 THEN 'paper_CIF' WHEN 1 THEN 'KenyaEMR' ELSE 'mobile_CHW' END AS data_source
FROM {customer}"""

# Every customer once, and a second registration of some of them.
SQL["patient"] = f"""
SELECT lpad(CAST(c_custkey AS STRING),9,'0') AS patient_id,{_PATIENT_COLUMNS},
       DATE '1996-01-01' + CAST((c_custkey*13)%1800 AS INT) AS date_enrolled,{_PATIENT_TAIL}
UNION ALL
SELECT 'd' || lpad(CAST(c_custkey AS STRING),9,'0') AS patient_id,{_PATIENT_COLUMNS},
       DATE '1996-01-01' + CAST((c_custkey*13)%1800 AS INT) + CAST(c_custkey%21 AS INT) AS date_enrolled,{_PATIENT_TAIL}
WHERE c_custkey%53=7"""

SQL["art_enrollment"] = f"""
SELECT lpad(CAST(o_orderkey AS STRING),9,'0') AS enrollment_id,
       lpad(CAST(o_custkey AS STRING),9,'0') AS patient_id,
       {_ORDER_FACILITY} AS facility_id,
       CAST(o_orderdate AS DATE) AS art_start_date,
       CAST(CASE WHEN o_orderkey%101=3 THEN -50 WHEN o_orderkey%103=7 THEN 3450 WHEN o_orderkey%11=0 THEN NULL
                 ELSE 100+o_orderkey%800 END AS DECIMAL(6,1)) AS cd4_at_start,
       CAST(CASE WHEN o_orderkey%37=1 THEN NULL ELSE 40+o_orderkey%60 END AS DECIMAL(5,1)) AS weight_at_start
FROM {{orders}}"""

SQL["viral_load"] = f"""
SELECT lpad(CAST(o_orderkey AS STRING),9,'0') AS vl_id,
       lpad(CAST(o_custkey AS STRING),9,'0') AS patient_id,
       {_ORDER_FACILITY} AS facility_id,
       CAST(o_orderdate AS DATE) AS sample_date,
       CASE WHEN o_orderkey%67=2 THEN CAST(o_orderdate AS DATE) - 5 WHEN o_orderkey%13=5 THEN NULL
            ELSE CAST(o_orderdate AS DATE) + 14 END AS result_date,
       CAST(CASE WHEN o_orderkey%43=1 THEN NULL WHEN o_orderkey%211=9 THEN 15000000
                 ELSE (o_orderkey*17)%3000 END AS DECIMAL(10,2)) AS vl_result,
       CASE WHEN o_orderkey%9=0 THEN TRUE WHEN o_orderkey%17=4 THEN NULL ELSE FALSE END AS is_ldl,
       CASE WHEN o_orderkey%5=0 THEN NULL WHEN (o_orderkey*17)%3000<1200 THEN 'suppressed'
            ELSE 'unsuppressed' END AS vl_category,
       o_orderpriority AS lab_name,
       'lab_LIMS' AS data_source
FROM {{orders}}"""

SQL["art_visit"] = f"""
SELECT lpad(CAST(event_id AS STRING),9,'0') AS visit_id,
       lpad(CAST(user_id AS STRING),9,'0') AS patient_id,
       CAST((user_id+event_id%2)%{_NF} AS INT) AS facility_id,
       CAST(ts AS DATE) AS visit_date,
       CASE WHEN event_id%4=0 THEN NULL ELSE CAST(ts AS DATE) + CAST(1+user_id%40 AS INT) END AS next_appointment,
       CAST(CASE WHEN event_id%83=4 THEN 4 WHEN event_id%10=0 THEN NULL ELSE 45+event_id%50 END AS DECIMAL(5,1)) AS weight_kg,
       CAST(CASE WHEN event_id%71=6 THEN -10 WHEN event_id%73=8 THEN 130 WHEN event_id%6=0 THEN NULL
                 ELSE 70+event_id%31 END AS INT) AS adherence_score,
       'KenyaEMR' AS data_source
FROM {{events}}"""

SQL["tb_case"] = f"""
SELECT lpad(CAST(o_orderkey AS STRING),9,'0') AS tb_case_id,
       lpad(CAST(o_custkey AS STRING),9,'0') AS patient_id,
       {_ORDER_FACILITY} AS facility_id,
       CASE WHEN o_orderkey%47=0 THEN NULL ELSE 'TB-' || CAST((o_orderkey*7)%400 AS STRING) END AS case_number,
       CAST(o_orderdate AS DATE) AS notification_date,
       CASE WHEN o_orderkey%15=0 THEN NULL ELSE CAST(o_orderdate AS DATE) - CAST(o_orderkey%70 AS INT) END AS diagnosis_date,
       CASE WHEN o_orderkey%12=5 THEN NULL ELSE CAST(o_orderdate AS DATE) + 7 END AS treatment_start,
       CASE WHEN o_orderkey%59=0 THEN NULL WHEN o_orderkey%5=0 THEN 'cured' WHEN o_orderkey%5=1 THEN 'not_evaluated'
            WHEN o_orderkey%5=2 THEN 'died' ELSE 'on_treatment' END AS treatment_outcome,
       'DHIS2' AS data_source
FROM {{orders}}"""

SQL["anc_visit"] = f"""
SELECT lpad(CAST(event_id AS STRING),9,'0') AS anc_visit_id,
       lpad(CAST(user_id AS STRING),9,'0') AS patient_id,
       CAST((user_id+event_id%2)%{_NF} AS INT) AS facility_id,
       CAST(ts AS DATE) AS visit_date,
       CAST(1+event_id%4 AS INT) AS anc_visit_number,
       CAST(CASE WHEN event_id%91=1 THEN 50 WHEN event_id%8=0 THEN NULL ELSE 8+event_id%32 END AS INT) AS gestational_age_wks,
       CAST(CASE WHEN event_id%9=0 THEN NULL ELSE 50+event_id%35 END AS DECIMAL(5,1)) AS weight_kg,
       CAST(CASE WHEN event_id%87=2 THEN 280 WHEN event_id%7=0 THEN NULL ELSE 100+event_id%101 END AS INT) AS systolic_bp,
       CAST(CASE WHEN event_id%16=0 THEN NULL ELSE 60+event_id%40 END AS INT) AS diastolic_bp,
       event_id%3<>0 AS hiv_test_done,
       'KenyaEMR' AS data_source
FROM {{events}}"""

SQL["delivery"] = f"""
SELECT lpad(CAST(o_orderkey AS STRING),9,'0') AS delivery_id,
       lpad(CAST(o_custkey AS STRING),9,'0') AS patient_id,
       {_ORDER_FACILITY} AS facility_id,
       CAST(o_orderdate AS DATE) AS delivery_date,
       CAST(CASE WHEN o_orderkey%61=1 THEN 120 WHEN o_orderkey%14=0 THEN NULL ELSE 200+o_orderkey%2500 END AS DECIMAL(6,1)) AS birth_weight_g,
       CASE WHEN o_orderkey%9=1 THEN 'positive' ELSE 'negative' END AS baby_hiv_status,
       CASE o_orderkey%4 WHEN 0 THEN 'negative' WHEN 1 THEN 'unknown' ELSE 'positive' END AS mother_hiv_status,
       'KenyaEMR' AS data_source
FROM {{orders}}"""

# Workers of odd facilities use another number series, so records that quote
# the plain series are orphans.
SQL["chw"] = """
SELECT CASE WHEN s_suppkey%2=0 THEN lpad(CAST(s_suppkey AS STRING),9,'0')
            ELSE 'H' || lpad(CAST(s_suppkey AS STRING),9,'0') END AS chw_id,
       CASE WHEN s_suppkey%13=2 THEN NULL
            ELSE 'C' || CAST(s_suppkey - CASE WHEN s_suppkey%19=1 THEN 1 ELSE 0 END AS STRING) END AS chw_code,
       CAST(CASE WHEN s_suppkey%10=4 THEN NULL ELSE s_suppkey END AS INT) AS facility_id
FROM {supplier}"""

SQL["chw_service_record"] = f"""
SELECT lpad(CAST(event_id AS STRING),9,'0') AS service_id,
       lpad(CAST(event_id%{_NF} AS STRING),9,'0') AS chw_id,
       CAST(ts AS DATE) - CAST((event_id*7)%45 AS INT) AS service_date,
       CAST(ts AS TIMESTAMP) AS created_at,
       'mobile_CHW' AS data_source
FROM {{events}}"""

SQL["stock_record"] = f"""
SELECT lpad(CAST(o_orderkey AS STRING),9,'0') AS stock_id,
       {_ORDER_FACILITY} AS facility_id,
       CAST(o_orderkey%{_NP} AS INT) AS commodity_id,
       CAST(o_orderdate AS DATE) AS record_date,
       CAST(CASE WHEN o_orderkey%79=3 THEN NULL ELSE o_orderkey%3000 END AS DECIMAL(10,2)) AS opening_balance,
       CAST((o_orderkey*3)%1000 AS DECIMAL(10,2)) AS received_qty,
       CAST(CASE WHEN o_orderkey%113=4 THEN NULL ELSE (o_orderkey*7)%800 END AS DECIMAL(10,2)) AS dispensed_qty,
       CAST(CASE WHEN o_orderkey%13=0 THEN NULL ELSE o_orderkey%50 END AS DECIMAL(10,2)) AS losses_adjustments,
       CAST(CASE WHEN o_orderkey%57=0 THEN NULL
                 ELSE o_orderkey%3000 + (o_orderkey*3)%1000 - (o_orderkey*7)%800
                      - coalesce(CASE WHEN o_orderkey%13=0 THEN NULL ELSE o_orderkey%50 END,0)
                      + CASE WHEN o_orderkey%53=0 THEN 100 WHEN o_orderkey%53=1 THEN 1 ELSE 0 END
            END AS DECIMAL(10,2)) AS closing_balance,
       CAST(CASE WHEN o_orderkey%89=0 THEN 45 WHEN o_orderkey%114=0 THEN 3 ELSE 0 END AS INT) AS days_out_of_stock,
       'DHIS2' AS data_source
FROM {{orders}}"""

# Monthly totals per supplier, the base of the periodic reports.
SQL["monthly_totals"] = """
SELECT l_suppkey AS f, year(l_shipdate) AS y, month(l_shipdate) AS m,
       CAST(sum(l_quantity) AS BIGINT) AS q, count(*) AS n,
       sum(CASE WHEN l_returnflag='R' THEN 5 ELSE 0 END) AS r
FROM {lineitem} GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)"""

# Six report series come out of one pass over the totals: an array of the
# month's reports is unfolded instead of one scan per indicator.
_SERIES = [
    ("TX_CURR-", "TX_CURR", "monthly", "q", None),
    ("HTS_TST-", "HTS_TST", "monthly", "n*2", None),
    ("HTS_TST_POS-", "HTS_TST_POS", "monthly", "r", None),
    ("TX_NEW-", "TX_NEW", "monthly", "CASE WHEN (f+y+m)%61=0 THEN -n ELSE n END", None),
    ("TX_NEW-dup-", "TX_NEW", "monthly", "n", "(f+y+m)%37=0"),
    ("TB_NOTIF-", "TB_NOTIF", "quarterly", "n", "m%3=0"),
]
_SUBMITTED = """CASE WHEN (f+m)%10=0 THEN NULL
     ELSE CAST(last_day(make_date(CAST(y AS INT),CAST(m AS INT),1)) + CAST((f*m)%75 AS INT) AS TIMESTAMP) + INTERVAL '9' HOUR END"""


def _reports_spark_sql() -> str:
    cases = []
    for prefix, code, period, value, keep in _SERIES:
        item = (
            f"named_struct('prefix','{prefix}','indicator_code','{code}','period_type','{period}',"
            f"'value',CAST({value} AS DECIMAL(10,2)))"
        )
        cases.append(item if keep is None else f"CASE WHEN {keep} THEN {item} END")
    return f"""
SELECT prefix || CAST(f AS STRING) || '-' || CAST(y AS STRING) || '-' || lpad(CAST(m AS STRING),2,'0') AS report_id,
       CAST(f AS INT) AS facility_id, period_type, CAST(y AS INT) AS period_year,
       CASE WHEN period_type='monthly' THEN CAST(m AS INT) END AS period_month,
       indicator_code, value, {_SUBMITTED} AS submission_date, 'DHIS2' AS data_source
FROM (SELECT f, y, m, inline(filter(array({", ".join(cases)}), x -> x IS NOT NULL)) FROM {{monthly_totals}})"""


def _reports_oracle_sql() -> str:
    parts = []
    for prefix, code, period, value, keep in _SERIES:
        month = "CAST(m AS INT)" if period == "monthly" else "NULL"
        where = f" WHERE {keep}" if keep else ""
        parts.append(
            f"""SELECT '{prefix}' || CAST(f AS STRING) || '-' || CAST(y AS STRING) || '-' || lpad(CAST(m AS STRING),2,'0') AS report_id,
       CAST(f AS INT) AS facility_id, '{period}' AS period_type, CAST(y AS INT) AS period_year,
       {month} AS period_month, '{code}' AS indicator_code, CAST({value} AS DECIMAL(10,2)) AS value,
       {_SUBMITTED} AS submission_date, 'DHIS2' AS data_source
FROM monthly_totals{where}"""
        )
    return "\nUNION ALL\n".join(parts)


SQL["aggregate_report"] = _reports_spark_sql()
SQL["sub_county"] = """
SELECT n_nationkey*10+i AS sub_county_id, n_name || '-' || CAST(i AS STRING) AS sub_county_name, n_nationkey AS county_id
FROM (SELECT n_nationkey, n_name, explode(array(0,1,2)) AS i FROM {nation})"""

# ---- registry-side tables ----------------------------------------------------
_CHECK_NAME = """CASE o_orderkey%6 WHEN 0 THEN 'C01_patient_missing_dob' WHEN 1 THEN 'V02_art_start_before_enrollment'
            WHEN 2 THEN 'K02_vl_suppressed_mislabeled' WHEN 3 THEN 'T04_art_patient_overdue'
            WHEN 4 THEN 'U02_duplicate_tb_case_number' ELSE 'P05_days_stockout_exceeds_month' END"""
_CATEGORY = """CASE o_orderkey%6 WHEN 0 THEN 'completeness' WHEN 1 THEN 'validity' WHEN 2 THEN 'consistency'
            WHEN 3 THEN 'timeliness' WHEN 4 THEN 'uniqueness' ELSE 'plausibility' END"""
_SEVERITY = """CASE o_orderkey%6 WHEN 0 THEN 'high' WHEN 1 THEN 'critical' WHEN 2 THEN 'critical'
            WHEN 3 THEN 'medium' WHEN 4 THEN 'medium' ELSE 'high' END"""
_CLOSED_AT = "CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey%400 AS INT) AS TIMESTAMP) + INTERVAL '1' HOUR"
_SEEN_AT = "CAST(o_orderdate AS TIMESTAMP) + INTERVAL '2' HOUR"

SQL["data_quality_issue"] = f"""
SELECT lpad(CAST(o_orderkey AS STRING),9,'0') AS issue_id,
       {_CHECK_NAME} AS check_name,
       {_CATEGORY} AS check_category,
       {_SEVERITY} AS severity,
       CASE o_orderkey%6 WHEN 0 THEN 'patient' WHEN 1 THEN 'art_enrollment' WHEN 2 THEN 'viral_load'
            WHEN 3 THEN 'art_visit' WHEN 4 THEN 'tb_case' ELSE 'stock_record' END AS source_table,
       CASE o_orderkey%6 WHEN 0 THEN 'date_of_birth' WHEN 1 THEN 'art_start_date' WHEN 2 THEN 'vl_category'
            WHEN 3 THEN 'next_appointment' WHEN 4 THEN 'case_number' ELSE 'days_out_of_stock' END AS source_column,
       CASE WHEN o_orderkey%131=0 THEN NULL ELSE lpad(CAST(o_custkey AS STRING),9,'0') END AS record_id,
       CASE WHEN o_orderkey%6=4 THEN NULL WHEN (o_custkey%{_NF})%10=6 THEN NULL
            ELSE CAST(o_custkey%{_NF} AS INT) END AS facility_id,
       s_nationkey AS county_id,
       'Finding ' || CAST(o_orderkey AS STRING) AS issue_description,
       CASE WHEN o_orderkey%4=0 THEN NULL ELSE CAST(o_orderkey%900 AS STRING) END AS raw_value,
       'rule ' || CAST(o_orderkey%6 AS STRING) AS expected_value,
       CASE WHEN o_orderkey%7 IN (0,1,2) THEN 'open' WHEN o_orderkey%7=3 THEN 'confirmed'
            WHEN o_orderkey%7=4 THEN 'resolved' WHEN o_orderkey%7=5 THEN 'waived' ELSE 'false_positive' END AS status,
       CASE WHEN o_orderkey%7>3 THEN 'clerk-' || CAST(o_orderkey%5 AS STRING) ELSE NULL END AS resolved_by,
       CASE WHEN o_orderkey%7>3 THEN {_CLOSED_AT} ELSE NULL END AS resolved_at,
       CASE WHEN o_orderkey%7>3 THEN 'note ' || CAST(o_orderkey%5 AS STRING) ELSE NULL END AS resolution_notes,
       'run-' || CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING),2,'0') AS check_run_id,
       CASE o_orderkey%4 WHEN 0 THEN NULL WHEN 1 THEN 'DHIS2' WHEN 2 THEN 'KenyaEMR' ELSE 'paper_CIF' END AS data_source,
       CAST(year(o_orderdate) AS INT) AS period_year,
       CAST(month(o_orderdate) AS INT) AS period_month,
       {_SEEN_AT} AS detected_at,
       CASE WHEN o_orderkey%7>3 THEN {_CLOSED_AT} ELSE {_SEEN_AT} END AS updated_at
FROM {{orders}} LEFT JOIN {{supplier}} ON s_suppkey = o_custkey%{_NF}"""

SQL["dq_engine_run"] = """
SELECT run_id, run_started_at,
       CASE WHEN k%9=4 THEN NULL ELSE run_started_at + CAST(k%7 AS INT) * INTERVAL '45' SECOND END AS run_completed_at,
       CASE k%3 WHEN 0 THEN 'manual' WHEN 1 THEN 'scheduled' ELSE 'pipeline' END AS triggered_by,
       CASE WHEN k%11=3 THEN 0 ELSE 36 END AS checks_executed, n AS issues_found
FROM (SELECT 'run-' || CAST(y AS STRING) || '-' || lpad(CAST(m AS STRING),2,'0') AS run_id,
             CAST(make_date(CAST(y AS INT),CAST(m AS INT),1) AS TIMESTAMP) + INTERVAL '2' HOUR AS run_started_at,
             y*12+m AS k, n
      FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n
            FROM {orders} GROUP BY year(o_orderdate), month(o_orderdate)) AS months) AS runs"""

SQL["dq_check_log"] = f"""
SELECT 'run-' || CAST(y AS STRING) || '-' || lpad(CAST(m AS STRING),2,'0') AS run_id,
       'run-' || CAST(y AS STRING) || '-' || CAST(m AS STRING) || '-' || check_name AS log_id,
       check_name, check_category, severity,
       CAST(make_date(CAST(y AS INT),CAST(m AS INT),1) AS TIMESTAMP) AS started_at,
       CAST(make_date(CAST(y AS INT),CAST(m AS INT),1) AS TIMESTAMP) + CAST(n%50 AS INT) * INTERVAL '1' SECOND AS completed_at,
       CASE WHEN check_category='validity' THEN 0 ELSE n*3 END AS records_scanned, n AS issues_raised
FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, {_CHECK_NAME} AS check_name,
             {_CATEGORY} AS check_category, {_SEVERITY} AS severity, count(*) AS n
      FROM {{orders}} GROUP BY 1, 2, 3, 4, 5) AS logs"""

# One request per facility: odd ones ask for their county, even ones for themselves.
SQL["dq_check_suppression"] = """
SELECT 'sup-' || lpad(CAST(s_suppkey AS STRING),9,'0') AS suppression_id,
       CASE s_suppkey%3 WHEN 0 THEN 'C01_patient_missing_dob' WHEN 1 THEN 'K02_vl_suppressed_mislabeled'
            ELSE 'T04_art_patient_overdue' END AS check_name,
       CASE WHEN s_suppkey%2=0 THEN CAST(s_suppkey AS INT) ELSE NULL END AS facility_id,
       CASE WHEN s_suppkey%2=1 AND s_suppkey%5=1 THEN s_nationkey
            WHEN s_suppkey%2=1 THEN s_nationkey+100 ELSE NULL END AS county_id,
       'planner' AS suppressed_by, 'migration' AS suppression_reason,
       DATE '2001-07-01' + CAST(s_suppkey%60 AS INT) AS valid_from,
       DATE '2001-07-20' + CAST(s_suppkey%60 AS INT) + CAST((s_suppkey*7)%40 AS INT) AS valid_until,
       s_suppkey%4<>3 AS is_active
FROM {supplier}"""

# One lifecycle action per issue, a second one for some, and some unknown ids.
SQL["issue_action"] = """
SELECT o_orderkey*4 AS action_seq,
       CASE WHEN o_orderkey%10=9 THEN 'x' ELSE '' END || lpad(CAST(o_orderkey AS STRING),9,'0') AS issue_id,
       CASE (o_orderkey%11)%5 WHEN 0 THEN 'resolve' WHEN 1 THEN 'waive' WHEN 2 THEN 'false_positive'
            WHEN 3 THEN 'reopen' ELSE 'resolve' END AS action,
       'user-' || CAST(o_orderkey%4 AS STRING) AS actor,
       CASE WHEN o_orderkey%13=1 THEN NULL WHEN o_orderkey%13=2 THEN '  ' ELSE 'why ' || CAST(o_orderkey%8 AS STRING) END AS note
FROM {orders}
UNION ALL
SELECT o_orderkey*4+1 AS action_seq, lpad(CAST(o_orderkey AS STRING),9,'0') AS issue_id,
       CASE o_orderkey%3 WHEN 0 THEN 'reopen' WHEN 1 THEN 'waive' ELSE 'resolve' END AS action,
       'second' AS actor, 'step two' AS note
FROM {orders} WHERE o_orderkey%3<2"""

# One bulk resolution per facility, over its own findings or its whole county.
SQL["bulk_action"] = """
SELECT -1000000000 + s_suppkey AS action_seq,
       CASE s_suppkey%3 WHEN 0 THEN 'C01_patient_missing_dob' WHEN 1 THEN 'K02_vl_suppressed_mislabeled'
            ELSE 'P05_days_stockout_exceeds_month' END AS check_name,
       CASE WHEN s_suppkey%4<3 THEN CAST(s_suppkey AS INT) ELSE NULL END AS facility_id,
       CASE WHEN s_suppkey%4>1 THEN s_nationkey ELSE NULL END AS county_id,
       'bulk-' || CAST(s_suppkey%3 AS STRING) AS actor,
       CASE WHEN s_suppkey%9=5 THEN '   ' ELSE 'system fix' END AS note
FROM {supplier}"""

# One suppression request per facility, some of them invalid.
SQL["suppression_request"] = """
SELECT s_suppkey AS request_seq,
       CASE s_suppkey%2 WHEN 0 THEN 'C01_patient_missing_dob' ELSE 'T02_aggregate_late_submission' END AS check_name,
       CASE WHEN s_suppkey%5<3 THEN CAST(s_suppkey AS INT) ELSE NULL END AS facility_id,
       CASE WHEN s_suppkey%5=3 OR s_suppkey%5=0 THEN s_nationkey ELSE NULL END AS county_id,
       'planner-' || CAST(s_suppkey%3 AS STRING) AS actor,
       CASE WHEN s_suppkey%7=1 THEN ' ' ELSE 'backfill' END AS reason,
       DATE '2001-08-15' + CAST(s_suppkey%30-3 AS INT) AS valid_until
FROM {supplier}"""

#: Source schemas, stated so that no job is spent on reading them.
_SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
_INPUTS = [*_SOURCES, "monthly_totals"]


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One derived table, lazily, with its defaults applied."""
    sql = SQL[table]
    frames = {}
    for name in _INPUTS:
        if "{" + name + "}" in sql:
            derived_input = name in SQL
            frames[name] = derive(spark, sf_dir, name) if derived_input else source(spark, sf_dir, name)
    df = spark.sql(sql, **frames)
    if table not in SCHEMAS:
        return df
    clock = REGISTRY_CLOCK if table.startswith("d") and table != "delivery" else CHECK_CLOCK
    return conform(df, table, clock)


def derive_all(spark: SparkSession, sf_dir: str, *tables: str) -> dict[str, DataFrame]:
    return {table: derive(spark, sf_dir, table) for table in tables}


def oracle_ctes(*tables: str) -> str:
    """The same derivations as a WITH clause body for a SQL engine holding the source views."""
    wanted: list[str] = []

    def add(table: str) -> None:
        if table == "aggregate_report":
            add("monthly_totals")
        if table not in wanted:
            wanted.append(table)

    for table in tables:
        add(table)
    parts = []
    for table in wanted:
        if table == "aggregate_report":
            body = _reports_oracle_sql()
        else:
            body = SQL[table].format(**{name: name for name in _INPUTS})
        if table == "sub_county":
            body = body.replace("explode(array(0,1,2))", "unnest([0,1,2])")
        parts.append(f"{table} AS ({body})")
    return "WITH " + ",\n".join(parts)
