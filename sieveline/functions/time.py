"""The injected clock and date arithmetic."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Clock:
    """One instant per job; every "now" and "today" comes from here."""

    instant: str  # 'YYYY-MM-DD HH:MM:SS' in the session time zone

    @classmethod
    def at(cls, instant: str) -> "Clock":
        return cls(instant if " " in instant else instant + " 00:00:00")

    @classmethod
    def system(cls, zone: str = "UTC") -> "Clock":
        """The current time in the session's time zone."""
        return cls(datetime.now(ZoneInfo(zone)).strftime("%Y-%m-%d %H:%M:%S"))

    @property
    def now(self) -> Column:
        return F.lit(self.instant).cast("timestamp")

    @property
    def today(self) -> Column:
        return F.lit(self.instant[:10]).cast("date")

    def days_ago(self, days: int) -> Column:
        """The instant exactly `days` calendar days before now."""
        return F.timestamp_add("DAY", F.lit(-days), self.now)

    @property
    def today_sql(self) -> str:
        return f"DATE '{self.instant[:10]}'"

    @property
    def stamp_sql(self) -> str:
        """Now to the second with its zone offset, as text."""
        return f"date_format(TIMESTAMP '{self.instant}', 'yyyy-MM-dd HH:mm:ssx')"


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete 24-hour periods between two timestamps, cut toward zero."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.call_function("div", micros, F.lit(86_400_000_000))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with microseconds, as a decimal."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return (micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(20,6)")


def month_end(year: Column, month: Column) -> Column:
    """Last day of a reporting month; NULL for a month outside 1-12."""
    return F.last_day(month_start(year, month))


def month_start(year: Column, month: Column) -> Column:
    return F.when(
        month.between(1, 12) & year.between(1, 9999),
        F.make_date(year.cast("int"), month.cast("int"), F.lit(1)),
    )
