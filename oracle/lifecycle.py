"""SQL for lifecycle batches: actions folded one after the other."""

from __future__ import annotations

from oracle.reports import ISSUE, NOW, TODAY, over, stamp
from sieveline.operators.lifecycle import MESSAGES
from oracle.checks import text

STAMP = "'2001-08-15 00:00:00+00'"
_BLANK = "(note IS NULL OR trim(note) = '')"
_ACTIVE = "state IN ('open','confirmed')"

_BULK_TARGETS = f"""SELECT b.action_seq, q.issue_id, 'bulk_resolve' AS action, b.actor, b.note
  FROM bulk_action b JOIN data_quality_issue q ON q.check_name = b.check_name
   AND (b.facility_id IS NULL OR q.facility_id = b.facility_id) AND (b.county_id IS NULL OR q.county_id = b.county_id)
  WHERE NOT {_BLANK.replace("note", "b.note")}"""

# What one action does to the state it meets; NULL: nothing.
_EFFECT = f"""CASE
  WHEN {_BLANK} THEN NULL
  WHEN action IN ('resolve','bulk_resolve') AND {_ACTIVE} THEN 'resolved'
  WHEN action = 'waive' AND state NOT IN ('resolved','waived') THEN 'waived'
  WHEN action = 'false_positive' THEN 'false_positive'
  WHEN action = 'reopen' AND state <> 'open' THEN 'open' END"""


def fold(actions: str, bulk: bool) -> str:
    """CTEs up to `judged`: every action with the state it met and its effect."""
    tables = [ISSUE, "issue_action"] + (["bulk_action"] if bulk else [])
    union = f" UNION ALL {_BULK_TARGETS}" if bulk else ""
    base = over(*tables).replace("WITH ", "WITH RECURSIVE ", 1)
    return f"""{base}, chosen AS ({actions}),
acts AS (SELECT a.*, q.status, q.check_name, row_number() OVER (PARTITION BY a.issue_id ORDER BY a.action_seq) AS n
  FROM (SELECT action_seq, issue_id, action, actor, note FROM chosen{union}) a
  JOIN data_quality_issue q ON q.issue_id = a.issue_id),
judged AS (
  SELECT *, {_EFFECT} AS effect FROM (SELECT *, status AS state FROM acts WHERE n = 1) AS firsts
  UNION ALL
  SELECT *, {_EFFECT} AS effect FROM (
    SELECT a.*, coalesce(j.effect, j.state) AS state FROM judged j JOIN acts a ON a.issue_id = j.issue_id AND a.n = j.n + 1) AS nexts)"""


def _message() -> str:
    slots = {"stamp": STAMP}
    m = {name: text(template, slots) for name, template in MESSAGES.items() if not name.startswith(("bulk", "suppress", "fp_alert"))}
    return f"""CASE action
  WHEN 'resolve' THEN CASE WHEN NOT {_ACTIVE} THEN {m['resolve_status']} WHEN {_BLANK} THEN {m['resolve_blank']} ELSE {m['resolve_ok']} END
  WHEN 'waive' THEN CASE WHEN state = 'resolved' THEN {m['waive_resolved']} WHEN state = 'waived' THEN {m['waive_waived']}
       WHEN {_BLANK} THEN {m['waive_blank']} ELSE {m['waive_ok']} END
  WHEN 'false_positive' THEN CASE WHEN {_BLANK} THEN {m['fp_blank']} ELSE {m['fp_ok']} END
  WHEN 'reopen' THEN CASE WHEN state = 'open' THEN {m['reopen_open']} WHEN {_BLANK} THEN {m['reopen_blank']} ELSE {m['reopen_ok']} END END"""


def messages(actions: str, bulk: bool = False) -> str:
    sql = f"""{fold(actions, bulk)}
SELECT action_seq, {_message()} AS message FROM judged WHERE action <> 'bulk_resolve'
UNION ALL SELECT action_seq, {text(MESSAGES['not_found'], {})} FROM chosen
 WHERE NOT EXISTS (SELECT 1 FROM data_quality_issue q WHERE q.issue_id = chosen.issue_id)"""
    if bulk:
        sql += " UNION ALL " + _bulk_messages()
    return sql


def _bulk_messages() -> str:
    slots = {
        "applied": "(SELECT count(*) FROM judged j WHERE j.action_seq = b.action_seq AND j.effect = 'resolved')",
        "facility": "coalesce(CAST(facility_id AS VARCHAR), 'all')",
        "county": "coalesce(CAST(county_id AS VARCHAR), 'all')",
    }
    return f"""SELECT b.action_seq, CASE WHEN {_BLANK} THEN '{MESSAGES["bulk_blank"]}'
  ELSE {text(MESSAGES["bulk_ok"], slots)} END AS message FROM bulk_action b"""


def registry(actions: str, bulk: bool = False) -> str:
    return f"""{fold(actions, bulk)},
lasts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY n DESC) AS back FROM judged
  WHERE effect IS NOT NULL) AS effects WHERE back = 1)
SELECT q.issue_id, coalesce(l.effect, q.status) AS status,
 CASE WHEN l.effect IS NULL THEN q.resolved_by WHEN l.effect = 'open' THEN NULL ELSE l.actor END AS resolved_by,
 {stamp(f"CASE WHEN l.effect IS NULL THEN q.resolved_at WHEN l.effect = 'open' THEN NULL ELSE {NOW} END")} AS resolved_at,
 CASE WHEN l.effect IS NULL THEN q.resolution_notes WHEN l.effect = 'waived' THEN 'WAIVED: ' || l.note
      WHEN l.effect = 'false_positive' THEN 'FALSE POSITIVE: ' || l.note
      WHEN l.effect = 'open' THEN 'REOPENED by ' || l.actor || ' at ' || {STAMP} || ': ' || l.note
      ELSE l.note END AS resolution_notes,
 {stamp(f"CASE WHEN l.effect IS NULL THEN q.updated_at ELSE {NOW} END")} AS updated_at
FROM data_quality_issue q LEFT JOIN lasts l ON l.issue_id = q.issue_id"""


def _only(action: str) -> str:
    return f"SELECT * FROM issue_action WHERE action = '{action}'"


EVERY = "SELECT * FROM issue_action"
NONE = "SELECT * FROM issue_action WHERE FALSE"
SQL: dict[str, str] = {
    "life_batch": registry(EVERY, bulk=True),
    "life_batch_messages": messages(EVERY, bulk=True),
    "life_bulk_resolve": registry(NONE, bulk=True),
    "life_bulk_messages": messages(NONE, bulk=True),
}
for _name, _action in [
    ("life_resolve", "resolve"),
    ("life_waive", "waive"),
    ("life_false_positive", "false_positive"),
    ("life_reopen", "reopen"),
]:
    SQL[_name] = registry(_only(_action))
    SQL[_name + "_messages"] = messages(_only(_action))

_RATE10 = "((2000 * f + n) // (2 * n))"  # tenths of a percent, halves up
SQL["life_fp_alert"] = f"""WITH after AS ({registry(_only("false_positive"))}),
named AS ({over(ISSUE)} SELECT issue_id, check_name FROM data_quality_issue),
issue_action AS ({over("issue_action")} SELECT * FROM issue_action),
marked AS (SELECT DISTINCT check_name FROM named JOIN issue_action USING (issue_id) WHERE action = 'false_positive' AND NOT {_BLANK}),
rates AS (SELECT check_name, count(*) AS n, count(*) FILTER (WHERE status = 'false_positive') AS f
  FROM after JOIN named USING (issue_id) WHERE check_name IN (SELECT check_name FROM marked) GROUP BY check_name)
SELECT check_name, CAST({_RATE10} AS DOUBLE) / 10 AS false_positive_rate_pct,
 concat('ALERT: Check ', check_name, ' now has a false positive rate of ', {_RATE10} // 10, '.', {_RATE10} % 10,
  ' percent. Consider reviewing check logic.') AS message
FROM rates WHERE {_RATE10} > 200"""

# Each marking sees the statuses that all actions up to it have left.
SQL["life_fp_alert_each"] = f"""{fold(EVERY, True)},
stay AS (SELECT issue_id, check_name, action_seq AS since, effect AS status,
  lead(action_seq, 1, 9000000000) OVER (PARTITION BY issue_id ORDER BY n) AS until FROM judged WHERE effect IS NOT NULL
  UNION ALL SELECT q.issue_id, q.check_name, -1, q.status, coalesce(f.first, 9000000000) FROM data_quality_issue q
  LEFT JOIN (SELECT issue_id, min(action_seq) AS first FROM judged WHERE effect IS NOT NULL GROUP BY issue_id) f ON f.issue_id = q.issue_id),
turn AS (SELECT check_name, since AS at, 1 AS d FROM stay WHERE status = 'false_positive'
  UNION ALL SELECT check_name, until, -1 FROM stay WHERE status = 'false_positive'),
marks AS (SELECT action_seq, check_name FROM judged WHERE action = 'false_positive' AND effect IS NOT NULL),
rates AS (SELECT action_seq, m.check_name, (SELECT count(*) FROM data_quality_issue q WHERE q.check_name = m.check_name) AS n, sum(d) AS f
  FROM marks m JOIN turn t ON t.check_name = m.check_name AND t.at <= m.action_seq GROUP BY action_seq, m.check_name)
SELECT action_seq, check_name, CAST({_RATE10} AS DOUBLE) / 10 AS false_positive_rate_pct,
 concat('ALERT: Check ', check_name, ' now has a false positive rate of ', CAST({_RATE10} // 10 AS BIGINT), '.', CAST({_RATE10} % 10 AS BIGINT),
  ' percent. Consider reviewing check logic.') AS message
FROM rates WHERE {_RATE10} > 200"""

_SUP = {
    "facility": "coalesce(CAST(facility_id AS VARCHAR), 'n/a')",
    "county": "coalesce(CAST(county_id AS VARCHAR), 'n/a')",
}
SQL["life_suppress_messages"] = over("suppression_request") + f"""SELECT request_seq, CASE
 WHEN facility_id IS NULL AND county_id IS NULL THEN '{MESSAGES["suppress_scope"]}'
 WHEN valid_until <= {TODAY} THEN '{MESSAGES["suppress_date"]}'
 WHEN reason IS NULL OR trim(reason) = '' THEN '{MESSAGES["suppress_blank"]}'
 ELSE {text(MESSAGES["suppress_ok"], _SUP)} END AS message FROM suppression_request"""
SQL["life_suppress"] = over("suppression_request") + f"""SELECT check_name, facility_id, county_id, actor AS suppressed_by,
 {stamp(NOW)} AS suppressed_at, reason AS suppression_reason, '2001-08-15' AS valid_from,
 strftime(valid_until, '%Y-%m-%d') AS valid_until, TRUE AS is_active FROM suppression_request
WHERE (facility_id IS NOT NULL OR county_id IS NOT NULL) AND valid_until > {TODAY} AND trim(reason) <> ''"""

SQL["life_stored"] = SQL["life_batch"]
SQL["life_stored_messages"] = f"""SELECT 'action' AS kind, action_seq AS seq, message FROM ({SQL["life_batch_messages"]}) AS told
UNION ALL SELECT 'alert', action_seq, message FROM ({SQL["life_fp_alert_each"]}) AS alerts
UNION ALL SELECT 'suppression', request_seq, message FROM ({SQL["life_suppress_messages"]}) AS asked"""
