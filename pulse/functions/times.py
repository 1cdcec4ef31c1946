"""Time columns: elapsed time, variable-width buckets, calendar weeks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK_SECONDS = 7 * 86400
# Weeks run Sunday to Saturday at UTC-5, without daylight saving.
WEEK_ZONE_HOURS = 5
# Hourly buckets up to and including hour 168, daily ones after.
HOURLY_UNTIL = 168
DAY_HOURS = 24


def utc(column: Column | str) -> Column:
    """ISO text, a zone-less timestamp or a timestamp, as a UTC instant."""
    return F.col(column).cast("timestamp") if isinstance(column, str) else column.cast("timestamp")


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Whole seconds between two instants, truncated."""
    micros = F.unix_micros(utc(later)) - F.unix_micros(utc(earlier))
    return F.call_function("div", micros, F.lit(1_000_000))


def hours_since(later: Column, earlier: Column) -> Column:
    return elapsed_seconds(later, earlier) / F.lit(3600.0)


def time_bucket(hours: Column) -> Column:
    """Start hour of the bucket an age falls in."""
    daily = HOURLY_UNTIL + F.floor((hours - HOURLY_UNTIL) / DAY_HOURS) * DAY_HOURS
    return F.when(hours <= HOURLY_UNTIL, F.floor(hours)).otherwise(daily).cast("bigint")


def week_start_date(instant: Column) -> Column:
    day = F.to_date(utc(instant) - F.expr(f"INTERVAL {WEEK_ZONE_HOURS} HOURS"))
    return F.date_sub(day, F.dayofweek(day) - 1)


def week_label(instant: Column) -> Column:
    """The Sunday that starts the instant's week, as ``yyyy-MM-dd``."""
    return F.date_format(week_start_date(instant), "yyyy-MM-dd")


def weeks_since(later: Column, earlier: Column) -> Column:
    return F.floor(elapsed_seconds(later, earlier) / WEEK_SECONDS).cast("bigint")


def iso_week_monday(label: Column) -> Column:
    """``2025-W40`` to a Monday: day 1 + 7(w-1) of the year, back to its Monday."""
    year = F.split_part(label, F.lit("-W"), F.lit(1)).cast("int")
    week = F.split_part(label, F.lit("-W"), F.lit(2)).cast("int")
    day = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (week - 1) * 7)
    return F.date_sub(day, F.pmod(F.dayofweek(day) + 5, F.lit(7)).cast("int"))


def date_range_label(start: Column) -> Column:
    """``Jan 11 – Jan 17, 2026``; the end carries its year too when years differ."""
    end = F.date_add(start, 6)
    tail = F.when(F.year(start) == F.year(end), F.date_format(end, "MMM d")).otherwise(
        F.date_format(end, "MMM d, yyyy")
    )
    return F.concat(
        F.date_format(start, "MMM d"), F.lit(" – "), tail, F.lit(", "), F.date_format(end, "yyyy")
    )


def stacked_date_labels(start: Column) -> Column:
    end = F.date_add(start, 6)
    return F.array(
        F.date_format(start, "MMM d"),
        F.concat(F.lit("–"), F.date_format(end, "MMM d")),
        F.date_format(end, "yyyy"),
    )


def rfc822(text: Column, fallback: Column) -> Column:
    """Mail-style date to an instant; ``fallback`` when absent or unreadable."""
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9},\s*", "")
    zoned = F.regexp_replace(bare, r"\s(GMT|UTC|UT|Z)$", " +0000")
    return F.coalesce(F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss Z")), fallback)


def fuzzy_date(year: Column, month: Column, day: Column) -> Column:
    """Partial dates as one comparable integer; unknown parts count as 0."""
    return (
        F.coalesce(year, F.lit(0)) * 10000
        + F.coalesce(month, F.lit(0)) * 100
        + F.coalesce(day, F.lit(0))
    )
