"""Cleaning and typing of single values.

Every conversion is a ``try_`` form: a value that does not fit becomes NULL
with or without ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What a date looks like, and how it is parsed.
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
DATE_FORMAT = "yyyy-MM-dd"

# Column names that mean a date, besides the suffix.
DATE_SUFFIX = "date"
DATE_NAMES = ("dob", "dateofbirth")

# A matching text has ten characters and at most one line end after them, so
# longer texts are ruled out by their byte length before the pattern runs.
_DATE_BYTES = (10, 13)


def blank_to_null(value: Column) -> Column:
    """H3: the empty string is NULL; blanks are kept."""
    return F.nullif(value, F.lit(""))


def looks_like_date(value: Column, pattern: str = DATE_PATTERN) -> Column:
    if pattern != DATE_PATTERN:
        return value.rlike(pattern)
    return F.octet_length(value).between(*_DATE_BYTES) & value.rlike(pattern)


def to_date(value: Column, fmt: str = DATE_FORMAT) -> Column:
    """The date, NULL where the text is no date.

    In the default format the pattern is checked first and the plain cast does
    the rest, which is several times faster than a formatter. There is no year 0.
    """
    if fmt != DATE_FORMAT:
        return F.try_to_date(value, fmt)
    exact = (F.octet_length(value) == _DATE_BYTES[0]) & value.rlike(DATE_PATTERN) & ~value.startswith("0000")
    return F.when(exact, value.try_cast("date"))


def is_date_name(name: Column) -> Column:
    """T4: does a column name mean a date?"""
    lowered = F.lower(name)
    return lowered.endswith(DATE_SUFFIX) | lowered.isin(*DATE_NAMES)


def is_date_column(name: str) -> bool:
    """T4 for a name that is already known when the plan is built."""
    lowered = name.lower()
    return lowered.endswith(DATE_SUFFIX) or lowered in DATE_NAMES


def guarded_date(value: Column) -> Column:
    """T5: text that looks like a date must be one; other text stays."""
    return F.when(looks_like_date(value), value.try_cast("date").cast("string")).otherwise(value)


# The end of a text that says which offset its time has.
_HAS_OFFSET = r"(?i)(Z|UTC|[+-]\d{2}(:?\d{2})?)\s*$"


def normalize_timestamp(value: Column, zone: str | None = None) -> Column:
    """The instant, cut to whole seconds.

    A time without an offset is local time in ``zone``, by default in the
    zone of the session.
    """
    instant = F.try_to_timestamp(value)
    if zone:
        local = F.convert_timezone(F.lit(zone), F.current_timezone(), value.try_cast("timestamp_ntz"))
        has_time = F.regexp_like(value, F.lit(r":\d{2}"))
        has_offset = has_time & F.regexp_like(value, F.lit(_HAS_OFFSET))
        instant = F.when(has_offset, instant).otherwise(local.try_cast("timestamp"))
    return F.date_trunc("second", instant)
