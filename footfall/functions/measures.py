"""Functions over counts and groups."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions._cols import col
from footfall.schemas import ALL, STEP_BUCKETS, TIME_BUCKETS

# Odd numbers k whose share k/200 lies exactly between two hundredths, while the double
# nearest to it lies below: rounding the double half up then goes down.
TIES_BELOW = tuple(k for k in range(1, 200, 2) if Fraction(k / 200) < Fraction(k, 200))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def round_share(count: Column | str, total: Column | str) -> Column:
    """``count/total`` to two decimals, half up on the exact value of the double.

    Integers carry the whole computation, so no intermediate rounding can change a digit.
    A total of 0 gives null.
    """
    c = col(count).cast("bigint")
    n = F.nullif(col(total).cast("bigint"), F.lit(0).cast("bigint"))
    twice = c * 200
    hundredths = _div(twice + n, n * 2)
    below = (twice % n == 0) & _div(twice, n).isin(*TIES_BELOW)
    return (hundredths - F.when(below, 1).otherwise(0)) / 100.0


def mask_all(c: Column | str, grouped_away: Column | str) -> Column:
    """``all`` where a grouping set leaves this dimension out."""
    return F.when(col(grouped_away) == 1, F.lit(ALL)).otherwise(col(c))


def city_concat(c: Column | str) -> Column:
    """Aggregate: the distinct cities of a group, sorted and joined by commas.

    A missing city shows as ``null``.
    """
    return F.array_join(
        F.array_sort(F.collect_set(F.coalesce(col(c), F.lit("null")))), ","
    )


def bucket_summary(session_count: Column | str, counts: dict[str, Column | str]) -> Column:
    """``session_count=..|1s_3s=..|…|60=..`` from one row of bucket counts."""
    names = [name for name, _, _ in (*TIME_BUCKETS, *STEP_BUCKETS)]
    fields = [("session_count", session_count), *[(n, counts[n]) for n in names]]
    return F.concat_ws(
        "|", *[F.concat(F.lit(n + "="), col(c).cast("string")) for n, c in fields]
    )
