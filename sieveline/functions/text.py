"""Text built from rows: missing values render as empty text."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fill_sql(template: str, slots: dict[str, str] | None = None) -> str:
    """SQL that fills the `{name}` slots of a text; NULL becomes empty text.

    `slots` gives the SQL of a slot; other names are columns.  A template that
    is one bare slot is a plain cast, so NULL stays NULL there.  One SQL text
    per message keeps plan building off the Python-JVM bridge.
    """
    slots = slots or {}
    pieces = [(text, name) for text, name, _, _ in Formatter().parse(template)]
    if len(pieces) == 1 and pieces[0][0] == "" and pieces[0][1]:
        return f"cast({slots.get(pieces[0][1], pieces[0][1])} AS string)"
    parts = []
    for text, name in pieces:
        if text:
            parts.append(literal(text))
        if name:
            parts.append(f"coalesce(cast({slots.get(name, name)} AS string), '')")
    return f"concat({', '.join(parts)})"


def fill(template: str, slots: dict[str, str] | None = None) -> Column:
    return F.expr(fill_sql(template, slots))


def is_blank(col: Column) -> Column:
    """NULL, empty or spaces only (tabs and line ends count as content)."""
    return col.isNull() | (F.trim(col) == "")


def uuid_text(*keys: Column) -> Column:
    """A reproducible id in 8-4-4-4-12 form from the key columns."""
    digest = F.sha2(F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("~")) for k in keys]), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])
