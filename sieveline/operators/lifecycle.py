"""Changing the status of issues, set by set.

A batch is a DataFrame of actions

    action_seq bigint, issue_id string, action string, actor string, note string

with `action` one of resolve, waive, false_positive, reopen, and optionally a
DataFrame of bulk resolutions

    action_seq bigint, check_name string, facility_id int, county_id int, actor string, note string

`action_seq` is unique over both and gives the order.  The result is the next
version of the registry and one message per action.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.scoring import ACTIVE_STATUSES, percent
from sieveline.functions.text import fill, is_blank, uuid_text
from sieveline.functions.time import Clock
from sieveline.sources.schemas import SCHEMAS

# ---- fixed values: messages and note prefixes --------------------------------
MESSAGES = {
    "not_found": "ERROR: issue_id {issue_id} not found.",
    "resolve_status": (
        "ERROR: Issue {issue_id} has status '{state}' and cannot be resolved. "
        "Only open/confirmed issues can be resolved."
    ),
    "resolve_blank": "ERROR: resolution_notes is required. Document what fix was applied.",
    "resolve_ok": "OK: Issue {issue_id} ({check_name}) resolved by {actor} at {stamp}.",
    "bulk_blank": "ERROR: resolution_notes is required for bulk resolution.",
    "bulk_ok": (
        "OK: {applied} issues for check '{check_name}' resolved by {actor}. "
        "Scope: facility={facility}, county={county}."
    ),
    "waive_resolved": "ERROR: Issue {issue_id} is already resolved. Cannot waive a resolved issue.",
    "waive_waived": "WARNING: Issue {issue_id} is already waived.",
    "waive_blank": "ERROR: waiver_reason is required.",
    "waive_ok": "OK: Issue {issue_id} waived by {actor}.",
    "fp_blank": "ERROR: explanation is required. Why is this a false positive?",
    "fp_ok": "OK: Issue {issue_id} marked as false positive by {actor}. Check: {check_name}.",
    "reopen_open": "WARNING: Issue {issue_id} is already open.",
    "reopen_blank": "ERROR: reason is required to reopen an issue.",
    "reopen_ok": "OK: Issue {issue_id} reopened by {actor}.",
    "suppress_scope": "ERROR: Either facility_id or county_id must be specified for a suppression.",
    "suppress_date": "ERROR: valid_until must be a future date.",
    "suppress_blank": "ERROR: suppression_reason is required.",
    "suppress_ok": (
        "OK: Suppression request for check '{check_name}' recorded for facility={facility} / "
        "county={county} until {valid_until} by {actor}."
    ),
    "fp_alert": (
        "ALERT: Check {check_name} now has a false positive rate of {rate} percent. "
        "Consider reviewing check logic."
    ),
}
NOTE_WAIVED = "WAIVED: {note}"
NOTE_FALSE_POSITIVE = "FALSE POSITIVE: {note}"
NOTE_REOPENED = "REOPENED by {actor} at {stamp}: {note}"
FALSE_POSITIVE_ALERT_PCT = 20
# ---- fixed values: end -------------------------------------------------------

_BLOCK = 10_000  # sequence numbers an issue's actions are cut at


@dataclass
class Outcome:
    registry: DataFrame
    messages: DataFrame  # action_seq, message


_PLACE = ["check_name", "facility_id", "county_id"]


def _bulk_targets(
    bulk: DataFrame, registry: DataFrame, found: DataFrame | None = None, extra: list[str] | None = None
) -> DataFrame:
    """Resolutions of the issues in the scope of each bulk action, those without effect left out.

    A bulk action closes every active issue of its scope, and a closed issue stays closed until a single
    action opens it again.  So for an issue that no single action of the batch names only the first bulk action
    of all its scopes can count, and for one that is named (`found` has its actions) only the first after each
    of them: at most one row per active issue, and one per single action.
    """
    extra = extra or []
    usable = _scoped_bulk(bulk.filter(~is_blank(F.col("note"))))
    told = usable.select(F.col("told.action_seq").alias("action_seq"), "told.actor", "told.note")
    first = usable.groupBy(*_SCOPE).agg(F.min("told.action_seq").alias("action_seq"))
    # Issues of checks without bulk actions fall away before any scope is looked at, and so do kinds a check has none of.
    by_check = usable.groupBy(F.col("in_check").alias("check_name")).agg(
        F.max("told.action_seq").alias("last"), F.collect_set("kind").alias("kinds")
    )
    about = ["issue_id", "check_name", "status", *extra]
    still = registry.filter(F.col("status").isin(ACTIVE_STATUSES)).select(*about, "facility_id", "county_id")
    still = still.join(by_check.select("check_name", "kinds"), "check_name")
    if found is not None:
        found = found.select(*about, "facility_id", "county_id", "action_seq").join(by_check, "check_name")
        named = found.select(*about, "facility_id", "county_id", "kinds").distinct()
        still = still.join(named.select("issue_id"), "issue_id", "left_anti")
    reached = _with_scopes(still, "kinds").join(first, _SCOPE).groupBy(*about).agg(F.min("action_seq").alias("action_seq"))
    if found is not None:
        start = _with_scopes(named, "kinds").join(first, _SCOPE).groupBy("issue_id").agg(F.min("action_seq").alias("action_seq"))
        # Nothing follows an action that comes after all bulk actions of its check.
        asked = found.filter(F.col("action_seq") < F.col("last")).select("issue_id", "action_seq", *_PLACE)
        later = _next_in_scope(asked, usable)
        pairs = start.unionByName(later).distinct()
        reached = reached.unionByName(pairs.join(named.select(*about), "issue_id"))
    return reached.join(told, "action_seq").select(
        "action_seq", "issue_id", F.lit("bulk_resolve").alias("action"), "actor", "note", "check_name", "status", *extra
    )


#: What a scope is: its kind, and the check, facility and county (0 where the kind has none).
_SCOPE = ["kind", "in_check", "in_facility", "in_county"]


def _scoped_bulk(bulk: DataFrame) -> DataFrame:
    """Scope and `told` (action_seq, actor, note) of each bulk action."""
    scoped, countied = F.col("facility_id").isNotNull(), F.col("county_id").isNotNull()
    return bulk.select(
        (scoped.cast("int") + 2 * countied.cast("int")).alias("kind"),
        F.col("check_name").alias("in_check"),
        F.coalesce("facility_id", F.lit(0)).alias("in_facility"),
        F.coalesce("county_id", F.lit(0)).alias("in_county"),
        F.struct("action_seq", "actor", "note").alias("told"),
    )


def _with_scopes(issues: DataFrame, kept: str | None = None) -> DataFrame:
    """Each row once per kind of scope (of those in the array column `kept`), with the scope's keys; a missing place is
    in no scope of its kind."""
    none = F.lit(0)
    kinds = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                F.col("check_name").alias("in_check"),
                (F.col("facility_id") if kind & 1 else none).alias("in_facility"),
                (F.col("county_id") if kind & 2 else none).alias("in_county"),
            )
            for kind in range(4)
        ]
    )
    if kept is None:
        return issues.select("*", F.inline(kinds))
    asked = F.filter(kinds, lambda one: F.array_contains(kept, one["kind"]) & one["in_facility"].isNotNull() & one["in_county"].isNotNull())
    return issues.select(*[name for name in issues.columns if name != kept], F.inline(asked))


def _next_in_scope(found: DataFrame, bulk: DataFrame) -> DataFrame:
    """(issue_id, action_seq): for every single action, the first bulk action after it in the scopes of its issue.

    Scopes without bulk actions fall away first.  Windows run in blocks of sequence numbers per scope; a block
    without a later bulk action takes the first one of the next block that has any.
    """
    asked = _with_scopes(found).join(bulk.select(*_SCOPE).distinct(), _SCOPE, "left_semi").select(*_SCOPE, "action_seq", "issue_id")
    given = bulk.select(*_SCOPE, F.col("told.action_seq").alias("action_seq")).withColumn("bulk", F.col("action_seq"))
    rows = asked.unionByName(given, allowMissingColumns=True).withColumn("block", F.floor(F.col("action_seq") / _BLOCK))
    later = Window.partitionBy(*_SCOPE, "block").orderBy("action_seq").rowsBetween(1, Window.unboundedFollowing)
    here = rows.withColumn("next", F.min("bulk").over(later)).filter("issue_id IS NOT NULL")
    starts = rows.groupBy(*_SCOPE, "block").agg(F.min("bulk").alias("first"))
    beyond = Window.partitionBy(*_SCOPE).orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    carried = starts.withColumn("carried", F.min("first").over(beyond)).filter("carried IS NOT NULL").select(*_SCOPE, "block", "carried")
    inside = here.filter("next IS NOT NULL").select("issue_id", "action_seq", "next")
    outside = here.filter("next IS NULL").join(carried, [*_SCOPE, "block"]).select("issue_id", "action_seq", F.col("carried").alias("next"))
    first = inside.unionByName(outside).groupBy("issue_id", "action_seq").agg(F.min("next").alias("next"))
    return first.select("issue_id", F.col("next").alias("action_seq"))


def _after(start: Column, first_closing: Column, waived: Column) -> Column:
    """The status a stretch without resets leads to.

    From an active status the first allowed closing action counts, from a false
    positive only a waiver does, and a closed status stays.
    """
    return (
        F.when(start.isin(ACTIVE_STATUSES), F.coalesce(first_closing, start))
        .when((start == "false_positive") & waived, "waived")
        .otherwise(start)
    )


def _with_state(found: DataFrame) -> DataFrame:
    """Add the status each action meets.

    A marking as false positive and a reopening ("reset") set the status
    whatever it was; between resets only the first allowed closing action has an
    effect.  So a status follows from the last reset, the first closing action
    after it and whether a waiver came after it.  These three carry over from
    block to block: an issue's actions are cut into blocks of `_BLOCK` sequence
    numbers, windows run inside the blocks, and a series with one row per block
    hands each block its starting status.  No window holds all actions of an
    issue.
    """
    written = ~is_blank(F.col("note"))
    resets = F.when(written & (F.col("action") == "false_positive"), "false_positive").when(
        written & (F.col("action") == "reopen"), "open"
    )
    closes = F.when(written & F.col("action").isin("resolve", "bulk_resolve"), "resolved").when(
        written & (F.col("action") == "waive"), "waived"
    )
    block = ["issue_id", "block"]
    before = Window.partitionBy(*block).orderBy("action_seq").rowsBetween(Window.unboundedPreceding, -1)
    since_reset = Window.partitionBy(*block, "stretch").orderBy("action_seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        found.withColumn("block", F.floor(F.col("action_seq") / _BLOCK))
        .withColumns({"resets": resets, "closes": closes})
        .withColumns(
            {"stretch": F.count("resets").over(before), "reset": F.last("resets", ignorenulls=True).over(before)}
        )
        .withColumns(
            {
                "closed": F.first("closes", ignorenulls=True).over(since_reset),
                "waived": F.coalesce(F.bool_or(F.col("closes") == "waived").over(since_reset), F.lit(False)),
            }
        )
    )
    # What a block leaves behind: its last row's view with that row's own effect.
    is_reset = F.col("resets").isNotNull()
    left_behind = F.struct(
        F.coalesce("resets", "reset").alias("reset"),
        F.when(~is_reset, F.coalesce("closed", "closes")).alias("closed"),
        (~is_reset & (F.col("waived") | F.coalesce(F.col("closes") == "waived", F.lit(False)))).alias("waived"),
    )
    ends = rows.groupBy(*block).agg(F.max_by(left_behind, "action_seq").alias("end"), F.first("status").alias("status"))
    along = Window.partitionBy("issue_id").orderBy("block")
    so_far = Window.partitionBy("issue_id", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        ends.withColumn("run", F.count("end.reset").over(along))
        .withColumns(
            {
                "reset": F.last("end.reset", ignorenulls=True).over(along),
                "closed": F.first("end.closed", ignorenulls=True).over(so_far),
                "waived": F.bool_or("end.waived").over(so_far),
            }
        )
        .withColumn("after", _after(F.coalesce("reset", "status"), F.col("closed"), F.col("waived")))
        .select(*block, F.coalesce(F.lag("after").over(along), F.col("status")).alias("block_start"))
    )
    state = _after(F.coalesce("reset", "block_start"), F.col("closed"), F.col("waived"))
    return rows.join(carried, block).select(*[c for c in found.columns if c != "status"], state.alias("state"))


def _verdict(clock: Clock) -> Column:
    """Which message an action earns; keys ending in `_ok` changed the issue."""
    action, state = F.col("action"), F.col("state")
    blank = is_blank(F.col("note"))
    active = state.isin(ACTIVE_STATUSES)
    return (
        F.when((action == "bulk_resolve") & active, "bulk_ok")
        .when((action == "resolve") & ~active, "resolve_status")
        .when((action == "resolve") & blank, "resolve_blank")
        .when(action == "resolve", "resolve_ok")
        .when((action == "waive") & (state == "resolved"), "waive_resolved")
        .when((action == "waive") & (state == "waived"), "waive_waived")
        .when((action == "waive") & blank, "waive_blank")
        .when(action == "waive", "waive_ok")
        .when((action == "false_positive") & blank, "fp_blank")
        .when(action == "false_positive", "fp_ok")
        .when((action == "reopen") & (state == "open"), "reopen_open")
        .when((action == "reopen") & blank, "reopen_blank")
        .when(action == "reopen", "reopen_ok")
    )


def _message(verdicts: list[str], clock: Clock) -> Column:
    text = F.lit(None).cast("string")
    for name in verdicts:
        text = F.when(F.col("verdict") == name, fill(MESSAGES[name], {"stamp": clock.stamp_sql})).otherwise(text)
    return text


def _new_values(clock: Clock) -> Column:
    verdict = F.col("verdict")
    status = (
        F.when(verdict == "waive_ok", "waived")
        .when(verdict == "fp_ok", "false_positive")
        .when(verdict == "reopen_ok", "open")
        .otherwise("resolved")
    )
    note = (
        F.when(verdict == "waive_ok", fill(NOTE_WAIVED))
        .when(verdict == "fp_ok", fill(NOTE_FALSE_POSITIVE))
        .when(verdict == "reopen_ok", fill(NOTE_REOPENED, {"stamp": clock.stamp_sql}))
        .otherwise(F.col("note"))
    )
    closing = verdict != "reopen_ok"
    return F.struct(
        status.alias("status"),
        F.when(closing, F.col("actor")).alias("resolved_by"),
        F.when(closing, clock.now).alias("resolved_at"),
        note.alias("resolution_notes"),
    )


def judge(
    registry: DataFrame,
    clock: Clock,
    actions: DataFrame | None = None,
    bulk: DataFrame | None = None,
    extra: list[str] | None = None,
) -> DataFrame:
    """Every action on an issue that exists, with the status it meets (`state`) and its `verdict`.

    Bulk actions have a row per issue they may close.  `extra` names further columns of the registry to keep.
    """
    extra = extra or []
    heads = registry.select("issue_id", *_PLACE, "status", *extra)
    parts, found = [], None
    if actions is not None:
        found = actions.select("action_seq", "issue_id", "action", "actor", "note").join(heads, "issue_id")
        parts.append(found.drop("facility_id", "county_id"))
    if bulk is not None:
        parts.append(_bulk_targets(bulk, registry, found, extra))
    return _with_state(reduce(DataFrame.unionByName, parts)).withColumn("verdict", _verdict(clock))


def batch_messages(
    judged: DataFrame, clock: Clock, actions: DataFrame | None = None, bulk: DataFrame | None = None
) -> DataFrame:
    """action_seq, message: one row per action of the batch."""
    messages = []
    if actions is not None:
        names = [name for name in MESSAGES if name.split("_")[0] in ("resolve", "waive", "fp", "reopen")]
        names.remove("fp_alert")
        single = judged.filter(F.col("action") != "bulk_resolve")
        messages.append(single.select("action_seq", _message(names, clock).alias("message")))
        # Compared with the few found ids, not with the registry, which a small
        # batch therefore never shuffles.
        lost = actions.select("action_seq", "issue_id").join(single.select("issue_id"), "issue_id", "left_anti")
        messages.append(lost.select("action_seq", fill(MESSAGES["not_found"]).alias("message")))
    if bulk is not None:
        applied = judged.filter(F.col("verdict") == "bulk_ok").groupBy("action_seq").agg(
            F.count(F.lit(1)).alias("applied")
        )
        scope = {
            "applied": "coalesce(applied, 0)",
            "facility": "coalesce(cast(facility_id AS string), 'all')",
            "county": "coalesce(cast(county_id AS string), 'all')",
        }
        told = F.when(is_blank(F.col("note")), MESSAGES["bulk_blank"]).otherwise(fill(MESSAGES["bulk_ok"], scope))
        messages.append(bulk.join(applied, "action_seq", "left").select("action_seq", told.alias("message")))
    return reduce(DataFrame.unionByName, messages)


def changed_issues(judged: DataFrame, clock: Clock, extra: list[str] | None = None) -> DataFrame:
    """changed_id and its `new` values: what the last effective action of each issue leaves."""
    return (
        judged.filter(F.col("verdict").endswith("_ok"))
        .withColumn("new", _new_values(clock))
        .groupBy(F.col("issue_id").alias("changed_id"), *(extra or []))
        .agg(F.max_by("new", "action_seq").alias("new"))
    )


def with_changes(registry: DataFrame, changes: DataFrame, clock: Clock) -> DataFrame:
    replaced = ["status", "resolved_by", "resolved_at", "resolution_notes"]
    changed = F.col("changed_id").isNotNull()
    return registry.join(changes, F.col("issue_id") == F.col("changed_id"), "left").select(
        *[
            F.when(changed, F.col(f"new.{name}")).otherwise(F.col(name)).alias(name)
            if name in replaced
            else F.when(changed, clock.now).otherwise(F.col(name)).alias(name)
            if name == "updated_at"
            else F.col(name)
            for name in registry.columns
        ]
    )


def apply_actions(
    registry: DataFrame,
    clock: Clock,
    actions: DataFrame | None = None,
    bulk: DataFrame | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> Outcome:
    """Apply a batch in `action_seq` order, without storing anything.

    Actions are few next to issues: the registry is joined twice on its id (or
    on check and scope) and only its changed columns are replaced.  Registry and messages read the
    verdicts several times; with `stage` they are computed once.
    """
    judged = judge(registry, clock, actions, bulk)
    if stage is not None:
        judged = stage(judged)
    updated = with_changes(registry, changed_issues(judged, clock), clock)
    return Outcome(updated, batch_messages(judged, clock, actions, bulk))


def _one(spark, registry: DataFrame, clock: Clock, issue_id: str, action: str, actor: str, note: str | None) -> Outcome:
    row = spark.createDataFrame(
        [(1, issue_id, action, actor, note)],
        "action_seq bigint, issue_id string, action string, actor string, note string",
    )
    return apply_actions(registry, clock, row)


def resolve_issue(spark, registry, clock, issue_id: str, resolved_by: str, notes: str | None) -> Outcome:
    return _one(spark, registry, clock, issue_id, "resolve", resolved_by, notes)


def waive_issue(spark, registry, clock, issue_id: str, waived_by: str, reason: str | None) -> Outcome:
    return _one(spark, registry, clock, issue_id, "waive", waived_by, reason)


def mark_false_positive(spark, registry, clock, issue_id: str, marked_by: str, explanation: str | None) -> Outcome:
    return _one(spark, registry, clock, issue_id, "false_positive", marked_by, explanation)


def reopen_issue(spark, registry, clock, issue_id: str, reopened_by: str, reason: str | None) -> Outcome:
    return _one(spark, registry, clock, issue_id, "reopen", reopened_by, reason)


def bulk_resolve_by_check(
    spark,
    registry,
    clock,
    check_name: str,
    resolved_by: str,
    notes: str | None,
    facility_id: int | None = None,
    county_id: int | None = None,
) -> Outcome:
    row = spark.createDataFrame(
        [(1, check_name, facility_id, county_id, resolved_by, notes)],
        "action_seq bigint, check_name string, facility_id int, county_id int, actor string, note string",
    )
    return apply_actions(registry, clock, bulk=row)


def false_positive_alerts(registry: DataFrame, marked: DataFrame | None = None) -> DataFrame:
    """Checks whose false-positive rate is above the alert level.

    `marked` limits the alerts to checks of these issue ids (those just marked).
    """
    rates = registry.groupBy("check_name").agg(
        percent(F.count_if(F.col("status") == "false_positive"), F.count(F.lit(1))).alias("false_positive_rate_pct")
    )
    if marked is not None:
        touched = registry.join(marked.select("issue_id").distinct(), "issue_id", "left_semi").select("check_name")
        rates = rates.join(touched.distinct(), "check_name", "left_semi")
    return rates.filter(F.col("false_positive_rate_pct") > FALSE_POSITIVE_ALERT_PCT).withColumn(
        "message", fill(MESSAGES["fp_alert"], {"rate": "false_positive_rate_pct"})
    )


def alerts_per_marking(judged: DataFrame, registry: DataFrame) -> DataFrame:
    """action_seq, check_name, false_positive_rate_pct, message of every marking as false positive that leaves
    its check above the alert level; registry is as it was before the batch.

    A check's rate after an action is its rate before the batch and all changes up to the action.  They
    are added up in blocks of sequence numbers, and a series of one row per block carries the sums on, so that no
    window holds all changes of a check.
    """
    is_false = lambda status: (status == "false_positive").cast("bigint")
    after = F.when(F.col("verdict") == "fp_ok", "false_positive").otherwise("other")
    effective = judged.filter(F.col("verdict").isin("fp_ok", "waive_ok", "reopen_ok"))
    steps = effective.select(
        "check_name",
        "action_seq",
        (F.col("verdict") == "fp_ok").alias("marks"),
        (is_false(after) - is_false(F.col("state"))).alias("step"),
        F.floor(F.col("action_seq") / _BLOCK).alias("block"),
    )
    before = Window.partitionBy("check_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = steps.groupBy("check_name", "block").agg(F.sum("step").alias("total"), F.bool_or("marks").alias("marks"))
    carried = sums.withColumn("carried", F.coalesce(F.sum("total").over(before), F.lit(0))).filter("marks")
    within = Window.partitionBy("check_name", "block").orderBy("action_seq").rowsBetween(Window.unboundedPreceding, 0)
    so_far = steps.withColumn("so_far", F.sum("step").over(within)).filter("marks")
    marked = so_far.join(carried.select("check_name", "block", "carried"), ["check_name", "block"])
    rates = registry.groupBy("check_name").agg(
        F.count_if(F.col("status") == "false_positive").alias("at_first"), F.count(F.lit(1)).alias("issues")
    )
    rate = percent(F.col("at_first") + F.col("carried") + F.col("so_far"), F.col("issues"))
    found = marked.join(rates, "check_name").select("action_seq", "check_name", rate.alias("false_positive_rate_pct"))
    return found.filter(F.col("false_positive_rate_pct") > FALSE_POSITIVE_ALERT_PCT).withColumn(
        "message", fill(MESSAGES["fp_alert"], {"rate": "false_positive_rate_pct"})
    )


def suppress_checks(requests: DataFrame, clock: Clock) -> tuple[DataFrame, DataFrame]:
    """Validate suppression requests (request_seq, check_name, facility_id, county_id,
    actor, reason, valid_until); returns the rows to append and one message each."""
    verdict = (
        F.when(F.col("facility_id").isNull() & F.col("county_id").isNull(), "suppress_scope")
        .when(F.col("valid_until") <= clock.today, "suppress_date")
        .when(is_blank(F.col("reason")), "suppress_blank")
        .otherwise("suppress_ok")
    )
    judged = requests.withColumn("verdict", verdict)
    names = {
        "facility": "coalesce(cast(facility_id AS string), 'n/a')",
        "county": "coalesce(cast(county_id AS string), 'n/a')",
    }
    text = F.lit(None).cast("string")
    for name in ("suppress_scope", "suppress_date", "suppress_blank", "suppress_ok"):
        text = F.when(F.col("verdict") == name, fill(MESSAGES[name], names)).otherwise(text)
    values = {
        "suppression_id": uuid_text(
            F.lit(clock.instant), F.col("request_seq"), F.col("check_name"), F.col("facility_id"), F.col("county_id")
        ),
        "suppressed_by": F.col("actor"),
        "suppressed_at": clock.now,
        "suppression_reason": F.col("reason"),
        "valid_from": clock.today,
        "is_active": F.lit(True),
    }
    rows = judged.filter(F.col("verdict") == "suppress_ok").select(
        *[
            values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS["dq_check_suppression"].fields
        ]
    )
    return rows, judged.select("request_seq", text.alias("message"))


def suppress_check(
    spark,
    clock: Clock,
    check_name: str,
    suppressed_by: str,
    reason: str | None,
    valid_until: str,
    facility_id: int | None = None,
    county_id: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    row = spark.createDataFrame(
        [(1, check_name, facility_id, county_id, suppressed_by, reason, valid_until)],
        "request_seq bigint, check_name string, facility_id int, county_id int, actor string, reason string, "
        "valid_until string",
    ).withColumn("valid_until", F.col("valid_until").cast("date"))
    return suppress_checks(row, clock)
