"""Business days, run windows and calendar columns."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.contracts import LOCAL_OFFSET_HOURS

DAY = timedelta(days=1)


@dataclass(frozen=True)
class RunWindow:
    """One local business day as a half-open UTC window, plus a wider window for late arrivals."""

    report_date: date
    utc_lo: datetime
    utc_hi: datetime
    cover_lo: datetime
    cover_hi: datetime

    @classmethod
    def for_day(cls, day: str | date, offset_hours: int = LOCAL_OFFSET_HOURS, cover_days: int = 1) -> RunWindow:
        return cls.for_days(day, 1, offset_hours, cover_days)

    @classmethod
    def for_days(cls, first: str | date, days: int, offset_hours: int = LOCAL_OFFSET_HOURS,
                 cover_days: int = 1) -> RunWindow:
        """A run of consecutive business days: what a set-based backfill reads in one go."""
        start = date.fromisoformat(first) if isinstance(first, str) else first
        lo = datetime(start.year, start.month, start.day) - timedelta(hours=offset_hours)
        hi = lo + days * DAY
        return cls(start, lo, hi, lo - cover_days * DAY, hi + cover_days * DAY)


def yesterday(now_utc: datetime, offset_hours: int = LOCAL_OFFSET_HOURS) -> date:
    """Default run day: the last complete local day."""
    return (now_utc + timedelta(hours=offset_hours)).date() - DAY


def local_time(instant: Column, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    return F.timestamp_add("HOUR", F.lit(offset_hours), instant)


def from_epoch_ms(millis: Column) -> Column:
    """Epoch milliseconds to zone-less UTC, independent of the session zone."""
    return F.timestamp_add("MILLISECOND", millis, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.trunc(day, "week")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def weekday_no(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(day) + 1


def calendar_columns(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day),
        "month_key": month_key(day),
        "month": F.date_format(day, "MMM yyyy"),
        "week_start": week_start(day),
        "day_name": F.date_format(day, "EEE"),
        "weekday_no": weekday_no(day),
        "is_weekend": is_weekend(day),
        "day_type": F.when(is_weekend(day), "Weekend").otherwise("Weekday"),
    }


def calendar(df: DataFrame, day: str) -> DataFrame:
    """One row per day between the first and last day in the frame, days without rows included."""
    bounds = df.agg(F.min(day).cast("date").alias("lo"), F.max(day).cast("date").alias("hi"))
    days = (bounds.where(F.col("lo").isNotNull())
            .select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date")))
    return days.withColumns(calendar_columns(F.col("date")))
