"""Severity weights and ranks, and exact rounded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Burden weight of each severity, and the declared orders.
SEVERITY_WEIGHT = {"critical": 10, "high": 5, "medium": 2, "low": 1}
SEVERITY_ORDER = ["critical", "high", "medium", "low", "info"]
CATEGORY_ORDER = [
    "completeness",
    "validity",
    "consistency",
    "timeliness",
    "uniqueness",
    "referential",
    "plausibility",
]
ACTIVE_STATUSES = ["open", "confirmed"]


def _position(col: Column, order: list[str]) -> Column:
    expr = F.when(col == order[0], 1)
    for place, value in enumerate(order[1:], start=2):
        expr = expr.when(col == value, place)
    return expr


def severity_weight(col: Column) -> Column:
    expr = F.lit(0)
    for name, weight in reversed(SEVERITY_WEIGHT.items()):
        expr = F.when(col == name, F.lit(weight)).otherwise(expr)
    return expr


def severity_rank(col: Column) -> Column:
    return F.coalesce(_position(col, SEVERITY_ORDER), F.lit(len(SEVERITY_ORDER)))


def category_rank(col: Column) -> Column:
    return _position(col, CATEGORY_ORDER)


def ratio(numerator: Column, denominator: Column, scale: int, factor: int = 1) -> Column:
    """Whole numbers: numerator / denominator * factor, rounded half up; NULL for x / 0."""
    top = numerator.cast("decimal(19,0)") * F.lit(factor).cast("decimal(3,0)")
    bottom = F.nullif(denominator.cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    return F.round(top / bottom, scale)


def percent(part: Column, whole: Column, scale: int = 1) -> Column:
    return ratio(part, whole, scale, factor=100)
