"""Time expressions. All timestamps are zone-less, so no result depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_to_timestamp(ms: Column, precision: str = "s") -> Column:
    """Epoch milliseconds to a timestamp, cut to seconds or kept to the millisecond."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    if precision == "s":
        # integer division cuts towards zero, like the warehouse's ts/1000
        return F.timestamp_add("SECOND", F.call_function("div", ms, F.lit(1000)), start)
    if precision == "ms":
        return F.timestamp_add("MILLISECOND", ms, start)
    raise ValueError("precision is 's' or 'ms'")


def weekday_number(when: Column, base: str = "sunday0") -> Column:
    """Day of the week from 0, with Sunday or Monday first."""
    if base == "sunday0":
        return F.dayofweek(when) - F.lit(1)
    if base == "monday0":
        return F.weekday(when)
    raise ValueError("base is 'sunday0' or 'monday0'")


def calendar_parts(when: Column, base: str = "sunday0") -> list[Column]:
    """hour, day, ISO week, month, year and weekday columns."""
    parts = {
        "hour": F.hour(when),
        "day": F.dayofmonth(when),
        "week": F.weekofyear(when),
        "month": F.month(when),
        "year": F.year(when),
        "weekday": weekday_number(when, base),
    }
    return [value.cast("smallint").alias(name) for name, value in parts.items()]


def calendar_days(first: Column, last: Column) -> Column:
    """Number of midnights between two times."""
    return F.datediff(last, first).cast("bigint")


def elapsed_days(first: Column, last: Column) -> Column:
    """Number of whole 24-hour spans between two times."""
    return F.extract(F.lit("DAY"), last - first).cast("bigint")


def day_text(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM-dd")
