"""Users and sessions of weeks, months and seasons from stored days.

Distinct counts of days do not add up. What is stored per day and level is therefore the set of
ids, as bitmaps over their dense numbers: 32,768 ids in a bitmap of 4 KB. Bitmaps of days are
or-ed into those of a longer period and counted exactly; no event is read again, and a new day
costs that day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import mask_all
from footfall.operators.dims import add_dim_id, get_or_create_dim
from footfall.operators.visits import flag, rollup_ids

IDS = ("uid", "sid")
USER, SESSION = 0, 1
NUMBERS = "id bigint, {0} string"


def number_ids(visits: DataFrame, known: DataFrame | None, name: str) -> DataFrame:
    """``id <name>``: a number for every id, 1, 2, 3 …; new ids follow the known ones.

    Whoever stores days must store the numbers too, as they are what the bitmaps mean.
    """
    if known is None:
        known = visits.sparkSession.createDataFrame([], NUMBERS.format(name))
    return get_or_create_dim(visits, known, [name])


def daily_bitmaps(
    visits: DataFrame,
    users: DataFrame,
    sessions: DataFrame,
    dims: Sequence[str],
    levels: Sequence[Sequence[str]],
) -> DataFrame:
    """Per (day, level, kind of id, bucket): the bitmap of the ids, their launches and views.

    ``visits`` is a :func:`footfall.operators.visits.visit_grain` with both ids; ``users`` and
    ``sessions`` number them (:func:`number_ids`). The rows of a day are complete and can be
    replaced as a day.
    """
    rolled = rollup_ids(visits, dims, levels, IDS)
    numbered = add_dim_id(rolled.where(F.col("_id") == USER), users, ["uid"], "number").unionByName(
        add_dim_id(rolled.where(F.col("_id") == SESSION), sessions, ["sid"], "number")
    )
    keys = ["dt", *dims, *[flag(d) for d in dims], "_id"]
    return numbered.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"),
        F.sum("n_launch").alias("launches"),
        F.sum("n_view").alias("views"),
    )


def period_of(day: Column | str, unit: str) -> Column:
    """The first day of the week (from Sunday), month, season or year of a day."""
    day = F.col(day) if isinstance(day, str) else day
    if unit == "week":
        return F.date_sub(day, F.dayofweek(day) - 1)
    names = {"month": "MONTH", "season": "QUARTER", "year": "YEAR"}
    return F.trunc(day, names[unit])


def period_stats(days: DataFrame, unit: str, dims: Sequence[str]) -> DataFrame:
    """Per (period, level): users, sessions, launches and views of rows of :func:`daily_bitmaps`.

    An id that comes on several days of a period counts once. A session with one event is not
    told here: whether it has more on another day is not in the days' bitmaps.
    """
    level = ["first_day", *dims, *[flag(d) for d in dims]]
    merged = (
        days.withColumn("first_day", period_of("dt", unit))
        .groupBy(*level, "_id", "bucket")
        .agg(
            F.bitmap_or_agg("bits").alias("bits"),
            F.sum("launches").alias("launches"),
            F.sum("views").alias("views"),
        )
        .withColumn("ids", F.bitmap_count("bits"))
    )
    user, session = F.col("_id") == USER, F.col("_id") == SESSION
    stats = merged.groupBy(*level).agg(
        F.sum(F.when(user, F.col("ids"))).alias("users"),
        F.sum(F.when(session, F.col("ids"))).alias("sessions"),
        F.sum(F.when(session, F.col("launches"))).alias("launches"),
        F.sum(F.when(session, F.col("views"))).alias("views"),
    )
    masked = [mask_all(d, flag(d)).alias(d) for d in dims]
    return stats.select("first_day", *masked, "users", "sessions", "launches", "views")


def user_stats_of(days: DataFrame, unit: str) -> DataFrame:
    """The user report of longer periods, from bitmaps per platform."""
    return period_stats(days, unit, ("pl",)).select(
        "first_day",
        F.col("pl").alias("platform"),
        F.col("users").alias("active_users"),
        F.col("launches").alias("new_install_users"),
        F.col("sessions").alias("session_count"),
        F.call_function("div", F.col("views"), F.col("sessions")).alias("session_length"),
    )


def location_flow_of(days: DataFrame, unit: str, dims: Sequence[str]) -> DataFrame:
    """The flow report of longer periods, without the sessions of one event."""
    return period_stats(days, unit, dims).select(
        "first_day",
        *dims,
        F.col("launches").alias("nu"),
        F.col("users").alias("uv"),
        F.col("views").alias("pv"),
        F.col("sessions").alias("sn"),
    )
