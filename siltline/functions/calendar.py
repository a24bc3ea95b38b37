"""Calendar expressions.

Grouping keys are small integers or dates; names and labels are formatted after
the aggregation, on a handful of rows instead of on every fact row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# English weekday names, Monday first.
WEEKDAY_NAMES = [
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
]
# Fixed value: the position given to a name that is no weekday.
UNKNOWN_WEEKDAY_ORDER = 99


def day(ts: Column) -> Column:
    """Calendar day; a plain date, so the session time zone cannot shift it."""
    return ts.cast("date")


def weekday_number(ts: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(day(ts))


def weekday_name(number: Column) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.get(names, number)


def weekday_order(name: Column) -> Column:
    """Monday..Sunday position of a weekday name; anything else sorts last."""
    position = F.array_position(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), name)
    return (
        F.when(position > 0, position - 1)
        .otherwise(F.lit(UNKNOWN_WEEKDAY_ORDER))
        .cast("int")
    )


def month_start(ts: Column) -> Column:
    return F.trunc(day(ts), "MM")


def month_label(month: Column) -> Column:
    """``2025-03`` for a date."""
    return F.date_format(month, "yyyy-MM")


def iso_utc_text(ts: Column) -> Column:
    """ISO-8601 text with a ``+0000`` offset for a zone-less UTC timestamp."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0000"))


def iso_to_utc(text: Column) -> Column:
    """Zone-less UTC timestamp of an ISO-8601 text with an offset, to the second."""
    seconds = F.unix_seconds(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssZ")))
    return F.timestamp_add("SECOND", seconds, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
