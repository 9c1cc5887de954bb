"""Date and time expressions. All are built-in functions, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text formats of dates, times and landed timestamps.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "HH:mm:ss.SSS"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"

# What a date and a time of day look like. A failing cast is some fifty times dearer than a
# failing match, so casts see only what looks right.
DATE_PATTERN = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$"
TIME_PATTERN = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,6})?$"

# The two quarter rules. "thirds" (month // 3 + 1, so March is 2 and December 5) is the
# established warehouse content; "calendar" is the usual quarter.
QUARTERS = ("thirds", "calendar")


def day_of(df: DataFrame, column: str) -> Column:
    """The day a column falls on: DATE for temporal columns, the first ten characters for text."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.substring(column, 1, 10)
    return F.col(column).cast("date")


def iso_weekday(day: Column) -> Column:
    """Monday is 1, Sunday 7."""
    return (F.weekday(day) + 1).cast("int")


def day_name(day: Column) -> Column:
    return F.lower(F.date_format(day, "EEEE"))


def month_name(day: Column) -> Column:
    return F.lower(F.date_format(day, "MMMM"))


def quarter(day: Column, rule: str = "thirds") -> Column:
    if rule not in QUARTERS:
        raise ValueError(f"quarter rule must be one of {QUARTERS}, not {rule!r}")
    if rule == "calendar":
        return F.quarter(day)
    return (F.floor(F.month(day) / 3) + 1).cast("int")


def moment(column: str | Column) -> Column:
    """An ISO text or timestamp as TIMESTAMP_NTZ; malformed text raises under ANSI."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def date_text(at: Column) -> Column:
    return at.cast("date").cast("string")


def time_text(at: Column) -> Column:
    """Milliseconds, truncated."""
    return F.date_format(at, TIME_FORMAT)


def stamp_text(at: Column) -> Column:
    return F.date_format(at, STAMP_FORMAT)


def try_date(column: str) -> Column:
    """DATE from a DATE, or from text that starts with YYYY-MM-DD; NULL if malformed."""
    day = F.substring(F.col(column).cast("string"), 1, 10)
    return F.when(day.rlike(DATE_PATTERN), day.try_cast("date"))


def try_time(column: str) -> Column:
    """The time text itself where it is a time of day, else NULL."""
    return F.when(F.col(column).rlike(TIME_PATTERN), F.col(column))
