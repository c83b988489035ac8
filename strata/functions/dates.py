"""Date helpers (2.8): week arithmetic with a configurable first weekday,
null-safe greatest dates, month labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names (ISO order, Monday = 1), month names, quarter names.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December")
QUARTER_NAMES = ("First", "Second", "Third", "Fourth")


def pick(names, one_based_index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), one_based_index.cast("int"))


def iso_dow(d: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return ((F.dayofweek(d) + 5) % 7 + 1).cast("int")


def week_dow(d: Column, week_start: str = "sunday") -> Column:
    """1-based position in a week starting on ``week_start``."""
    if week_start == "sunday":
        return F.dayofweek(d).cast("int")
    return iso_dow(d)


def week_start(d: Column, week_start: str = "sunday") -> Column:
    return F.date_sub(d, week_dow(d, week_start) - 1)


def week_of_year(d: Column, week_start_day: str = "sunday") -> Column:
    """Week 1 holds 1 January; later weeks start on ``week_start_day``."""
    jan1 = F.trunc(d, "year")
    return (F.floor((F.dayofyear(d) - 1 + week_dow(jan1, week_start_day) - 1) / 7) + 1).cast("int")


def greatest_date(*cols, floor: str = "1900-01-01") -> Column:
    """``greatest_date(field_list)``: nulls count as ``floor``."""
    return F.greatest(*[F.coalesce(F.to_date(c), F.to_date(F.lit(floor))) for c in cols])


def greatest_timestamp(*cols, floor: str = "1900-01-01 00:00:00") -> Column:
    return F.greatest(*[F.coalesce(F.col(c) if isinstance(c, str) else c,
                                   F.to_timestamp(F.lit(floor))) for c in cols])
