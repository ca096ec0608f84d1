"""Calendar expressions.

Timestamps are zone-less UTC (``timestamp_ntz``) everywhere.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days in the event window by weekday of its first day.
WINDOW_DAYS_BY_WEEKDAY = {
    "Sunday": 3,
    "Monday": 3,
    "Tuesday": 2,
    "Wednesday": 5,
    "Thursday": 4,
    "Friday": 3,
    "Saturday": 3,
}
# Fixed value: days whose timeslots a mail lists.
SHOWCASE_DAYS = 4

# Fixed widths and patterns of the formatted texts.
NAME_WIDTH = 9
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def window_days(first_day: dt.date) -> int:
    return WINDOW_DAYS_BY_WEEKDAY[first_day.strftime("%A")]


def sunday_zero_weekday(day: Column) -> Column:
    """Day of the week with Sunday = 0."""
    return F.dayofweek(day) - 1


def event_day(ds: Column, lead_days: int) -> Column:
    return F.date_add(ds, lead_days)


def window_length(weekday: Column) -> Column:
    """Event window length for a Sunday = 0 weekday; null for a null weekday."""
    lengths = F.array(*[F.lit(n) for n in WINDOW_DAYS_BY_WEEKDAY.values()])
    return F.get(lengths, weekday)


def window_end(ds: Column, lead_days: int) -> Column:
    first = event_day(ds, lead_days)
    return F.date_add(first, window_length(sunday_zero_weekday(first)))


def quiet_start(ds: Column, quiet_days: int) -> Column:
    return F.date_add(ds, 1 - quiet_days)


def approval_start(ds: Column, lookback_days: int) -> Column:
    return F.date_add(ds, -lookback_days)


def in_zone(ts: Column, zone: Column | str) -> Column:
    """UTC wall clock to the wall clock of ``zone`` (a name or a column)."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), zone, ts)


def day_in_zone(ts: Column, zone: Column | str) -> Column:
    return F.to_date(in_zone(ts, zone))


def utc_at_midnight(day: dt.date, zone: str) -> dt.datetime:
    """UTC wall clock at which ``day`` begins in ``zone``."""
    local = dt.datetime.combine(day, dt.time(), ZoneInfo(zone))
    return local.astimezone(dt.timezone.utc).replace(tzinfo=None)


def utc_literal(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def starts_within(ts: Column, first: dt.date, end: dt.date | None, zone: str) -> Column:
    """Local day of ``ts`` is in [first, end).

    Midnight is never skipped or repeated in the zones used, so comparing local
    days equals comparing ``ts`` with two UTC constants.  That form is a plain
    range on the stored column, which the scan can prune on.
    """
    inside = ts >= utc_literal(utc_at_midnight(first, zone))
    if end is not None:
        inside = inside & (ts < utc_literal(utc_at_midnight(end, zone)))
    return inside


def today(zone: str = "America/New_York") -> dt.date:
    return dt.datetime.now(ZoneInfo(zone)).date()


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_PATTERN)


def weekday_text(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def padded_weekday_text(ts: Column) -> Column:
    return F.rpad(weekday_text(ts), NAME_WIDTH, " ")


def padded_date_text(ts: Column) -> Column:
    """``Saturday , February  15, 2020``: names blank-padded to nine."""
    month = F.rpad(F.date_format(ts, "MMMM"), NAME_WIDTH, " ")
    return F.concat(
        padded_weekday_text(ts), F.lit(", "), month, F.date_format(ts, " dd, yyyy")
    )


def clock_text(ts: Column) -> Column:
    """``03:00 pm``"""
    return F.lower(F.date_format(ts, "hh:mm a"))


def short_clock_text(ts: Column) -> Column:
    """``3:00pm``"""
    return F.ltrim(F.lower(F.date_format(ts, "hh:mma")), F.lit("0"))


def day_text(ts: Column) -> Column:
    """``Saturday, February 15``"""
    return F.date_format(ts, "EEEE, MMMM dd")


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", day))
