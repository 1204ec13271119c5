"""From the landing tables to the canonical layer: accepted rows are merged by key, the others set aside."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.time import Clock
from sieveline.operators.constraints import CONSTRAINTS, gate
from sieveline.sources.landing import one_per_key
from sieveline.sources.schemas import FACT_TABLES, REFERENCE_TABLES, SCHEMAS
from sieveline.sources.store import Commit, Store

#: Buckets of a canonical table that has none yet.
BUCKETS = 64
#: Parents come before their children.
ORDER = [t for t in ["county", "sub_county", "facility", "commodity", "chw", "patient"] if t in CONSTRAINTS]
ORDER += [t for t in [*REFERENCE_TABLES, *FACT_TABLES] if t in CONSTRAINTS and t not in ORDER]
REJECTED = "rejected_row"


def _buckets(parts: list[str], wanted: int) -> int:
    """How many buckets a table has; a table keeps the number it began with."""
    return int(parts[0].split("bucket=")[1].split("/")[0].split("of")[1]) if parts else wanted


def _label(key: str, buckets: int):
    """A key's bucket, as the name of its folder."""
    return F.format_string("%05dof%05d", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"), F.lit(buckets))


def _taken(accepted: DataFrame, known: DataFrame, key: str, column: str) -> DataFrame:
    """Accepted rows whose unique value belongs to another key of the canonical table."""
    own = accepted.filter(F.col(column).isNotNull()).select(F.col(key).alias("own_key"), F.col(column).alias("value"))
    theirs = known.select(F.col(key).alias("their_key"), F.col(column).alias("value"))
    return own.join(theirs, "value").filter("own_key <> their_key").select(F.col("own_key").alias(key)).distinct()


def _promote_table(commit: Commit, store: Store, table: str, landed: DataFrame, batch_id: str, clock: Clock, strict: bool, wanted: int) -> None:
    rules, columns = CONSTRAINTS[table], SCHEMAS[table].fieldNames()
    parents = {parent: store.read_parts(parent, commit.tables.get(parent, [])) for parent, _ in rules.parents.values()}
    parts = commit.tables.get(table, [])
    known = store.read_parts(table, parts)
    # A row that arrives again as it was, copies included, is no second row of its key.
    accepted, rejected = gate(table, landed.distinct(), parents, strict, commit.stage)
    for column in rules.unique if parts else []:
        taken = commit.stage(_taken(accepted, known, rules.key, column))
        if not taken.isEmpty():
            rejected = rejected.unionByName(accepted.join(taken, rules.key, "left_semi").withColumn("reasons", F.lit(f"duplicate:{column}")))
            accepted = accepted.join(taken, rules.key, "left_anti")
    commit.append(
        REJECTED,
        rejected.select(
            F.lit(batch_id).alias("batch_id"),
            F.lit(table).alias("table_name"),
            F.col(rules.key).cast("string").alias("record_id"),
            "reasons",
            F.to_json(F.struct(*columns)).alias("content"),
            clock.now.alias("rejected_at"),
        ),
    )
    stamped = [c for c in ("created_at", "updated_at") if c in columns]
    content = [c for c in columns if c not in stamped]
    own = F.struct(*[F.col(c) for c in content])
    if parts:
        old = known.select(F.col(rules.key), own.alias("old_content"), *[F.col(c).alias(f"old_{c}") for c in stamped])
        met = accepted.join(old, rules.key, "left")
        met = met.filter(F.col("old_content").isNull() | ~own.eqNullSafe(F.col("old_content")))
        times = {"created_at": F.coalesce(F.col("old_created_at"), F.col("created_at")) if "created_at" in stamped else None}
        times["updated_at"] = F.when(F.col("old_content").isNotNull(), clock.now).otherwise(F.col("updated_at")) if "updated_at" in stamped else None
        accepted = met.select(*[times[c].alias(c) if c in stamped else F.col(c) for c in columns])
    buckets = _buckets(parts, wanted)
    changed = commit.stage(one_per_key(accepted, [rules.key]).withColumn("bucket", _label(rules.key, buckets)))
    touched = sorted(row.bucket for row in changed.select("bucket").distinct().collect())  # at most `buckets` names
    if not touched:
        return
    same = [part for part in parts if part.split("bucket=")[1].split("/")[0] in set(touched)]
    kept = store.read_parts(table, same).join(changed.select(rules.key), rules.key, "left_anti")
    rows = kept.select(*columns).withColumn("bucket", _label(rules.key, buckets)).unionByName(changed)
    commit.replace(table, rows, only=touched)


def promote(
    store: Store,
    landed: dict[str, DataFrame],
    clock: Clock,
    batch_id: str | None = None,
    strict: bool = False,
    buckets: int = BUCKETS,
) -> str:
    """Merge a batch of landed tables into the canonical tables of `store`; returns the batch id.

    Rows that break a constraint go to `rejected_row` with their reasons; parents must be canonical already or
    come in the same batch.  Accepted rows replace the row of their key.  A row equal to the canonical one
    changes nothing, and `updated_at` moves only where something did.  Tables are cut into buckets by key, and only
    buckets with a changed row are written anew.  A batch shows as a whole, and one that is stored is not repeated.
    """
    batch_id = batch_id or str(uuid.uuid4())
    commit = store.begin()
    if f"promote:{batch_id}" in commit.runs:
        return batch_id
    for table in ORDER:
        if table in landed:
            _promote_table(commit, store, table, landed[table], batch_id, clock, strict, buckets)
    commit.runs.append(f"promote:{batch_id}")
    commit.publish()
    return batch_id
