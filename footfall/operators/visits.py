"""The grain the visitor reports share, and its rollup over dimension levels.

Every measure of the reports is a sum, a minimum, a maximum or a distinct count over
(day, dimensions, uid, sid). One aggregation of the raw events to that grain therefore
serves all of them; it combines before the shuffle, so a hot user or session costs no more
than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import is_launch, is_view, mask_all

ALL_DIMS = ("pl", "country", "province", "city")


def visit_grain(
    events: DataFrame,
    dims: Sequence[str] = ALL_DIMS,
    ids: Sequence[str] = ("uid", "sid"),
) -> DataFrame:
    """Events per (day, dimensions, ids) with the counts and times the reports need."""
    return events.groupBy("dt", *dims, *ids).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_launch("en")).alias("n_launch"),
        F.count_if(is_view("en")).alias("n_view"),
        F.min("access_time_ms").alias("first_ms"),
        F.max("access_time_ms").alias("last_ms"),
    )


def flag(dim: str) -> str:
    return f"_all_{dim}"


def rollup_ids(
    visits: DataFrame,
    dims: Sequence[str],
    levels: Sequence[Sequence[str]],
    ids: Sequence[str] = ("uid", "sid"),
) -> DataFrame:
    """Totals per (day, level, id), for every level and kind of id at once.

    Each level is a subset of ``dims``. A row belongs to one kind of id, told by the column
    ``_id`` (the position in ``ids``); a missing id is a value like any other. The flags
    ``_all_<dim>`` keep a level's ``all`` apart from a dimension value that is null or reads
    ``all``.
    """
    columns = [F.col(c) for c in ("dt", *dims, *ids)]
    sets = [
        [F.col(c) for c in ("dt", *level, one)] for level in levels for one in ids
    ]
    kind = F.lit(0)
    for place, one in enumerate(ids):
        kind = F.when(F.grouping(one) == 0, place).otherwise(kind)
    return visits.groupingSets(sets, *columns).agg(
        kind.alias("_id"),
        *[F.grouping(d).cast("int").alias(flag(d)) for d in dims],
        F.sum("n").alias("n"),
        F.sum("n_launch").alias("n_launch"),
        F.sum("n_view").alias("n_view"),
        F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"),
    )


def level_stats(
    visits: DataFrame, dims: Sequence[str], levels: Sequence[Sequence[str]]
) -> DataFrame:
    """Per (day, level): users, sessions, bounces, launches and views.

    Users, sessions and bounces do not add up over levels: each level counts its own ids.
    A bounce is a session with exactly one event inside the group.
    """
    rolled = rollup_ids(visits, dims, levels)
    user, session = F.col("_id") == 0, F.col("_id") == 1
    stats = rolled.groupBy("dt", *dims, *[flag(d) for d in dims]).agg(
        F.count_if(user).alias("users"),
        F.count_if(session).alias("sessions"),
        F.count_if(session & (F.col("n") == 1)).alias("bounces"),
        F.sum(F.when(session, F.col("n_launch"))).alias("launches"),
        F.sum(F.when(session, F.col("n_view"))).alias("views"),
    )
    masked = [mask_all(d, flag(d)).alias(d) for d in dims]
    return stats.select("dt", *masked, "users", "sessions", "bounces", "launches", "views")
