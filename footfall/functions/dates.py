"""Date functions. Days are cut in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions._cols import col


def parse_date_ms(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to epoch milliseconds; null where it does not parse."""
    return F.unix_millis(F.try_to_timestamp(col(c), F.lit(fmt)))


def format_ms(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Epoch milliseconds to text."""
    return F.date_format(F.timestamp_millis(col(c)), fmt)


def next_day_ms(c: Column | str) -> Column:
    """The same time of the next calendar day, also across a clock change."""
    return F.unix_millis(F.timestamp_millis(col(c)) + F.expr("INTERVAL '1' DAY"))


def day_of(c: Column | str) -> Column:
    """The day of an epoch millisecond."""
    return F.to_date(F.timestamp_millis(col(c)))


def valid_date(c: Column | str) -> Column:
    """A real calendar day written as yyyy-MM-dd, from the year 0001 on."""
    text = col(c)
    return F.coalesce(
        text.rlike(r"^\d{4}-\d{2}-\d{2}\z")
        & (F.substring(text, 1, 4) != "0000")
        & F.try_to_date(text, "yyyy-MM-dd").isNotNull(),
        F.lit(False),
    )


def date_parts(c: Column | str) -> dict[str, Column]:
    """year, season (the quarter), month, week and day of a date.

    Weeks begin on Sunday and week 1 is the one that holds 1 January, so the last days of
    December may be in week 1.
    """
    d = col(c).cast("date")
    year_start = F.trunc(d, "YEAR")
    next_year = F.add_months(year_start, 12)
    first_week = F.date_sub(next_year, F.dayofweek(next_year) - 1)
    week = F.floor((F.dayofyear(d) - 1 + F.dayofweek(year_start) - 1) / 7) + 1
    return {
        "year": F.year(d),
        "season": F.quarter(d),
        "month": F.month(d),
        "week": F.when(d >= first_week, 1).otherwise(week).cast("int"),
        "day": F.dayofmonth(d),
    }
