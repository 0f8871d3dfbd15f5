"""Number, time and array column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom.functions.text import WHITESPACE, WHITESPACE_CLASS

# Fixed value: a finite decimal number, with whitespace around it.
NUMBER_PATTERN = (
    f"^{WHITESPACE_CLASS}*([+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?){WHITESPACE_CLASS}*$"
)
# Fixed value: full ISO-8601 dates, with or without time and zone.
ISO_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"
)


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a decimal number becomes NULL."""
    return F.regexp_extract(c, NUMBER_PATTERN, 1).try_cast("double")


def truncate_to_int(number: Column) -> Column:
    """Double to int, cutting toward zero (5.7 -> 5, -0.9 -> 0); NULL when it does not fit."""
    return number.try_cast("int")


def parse_iso_timestamp(c: Column) -> Column:
    """ISO-8601 text to a timestamp; ``Z`` is UTC; empty, partial or malformed text becomes NULL."""
    return F.when(c.rlike(ISO_PATTERN), c.try_cast("timestamp"))


def as_utc_wall_clock(ts: Column) -> Column:
    """The UTC wall-clock reading of an instant, whatever the session zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def month_of(ts: Column) -> Column:
    """First instant of the month, in the type of the input column family (no zone)."""
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def keep_nonblank(items: Column) -> Column:
    """Trim each array item and drop the empty ones; order and duplicates stay."""
    trimmed = F.transform(items, lambda x: F.btrim(F.coalesce(x, F.lit("")), F.lit(WHITESPACE)))
    return F.filter(trimmed, lambda x: x != "")
