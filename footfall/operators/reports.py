"""The daily reports, on natural keys.

Those on visits take a frame from :func:`footfall.operators.visits.visit_grain` that holds
at least the dimensions and ids they name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import bucket_summary, mask_all, round_share
from footfall.operators.visits import flag, level_stats, rollup_ids
from footfall.schemas import REGION_COLUMNS, STEP_BUCKETS, TIME_BUCKETS

PLATFORM_LEVELS = (("pl",), ())
LOCATION_LEVELS = (
    ("country",),
    ("country", "province"),
    ("country", "province", "city"),
)
DEVICE_LEVELS = tuple(
    (*platform, *location) for platform in PLATFORM_LEVELS for location in LOCATION_LEVELS
)


def _sessions(visits: DataFrame) -> DataFrame:
    """Length in whole seconds and depth of each session, per platform and over all."""
    rolled = rollup_ids(visits, ("pl",), PLATFORM_LEVELS, ids=("sid",))
    length = F.call_function("div", F.col("last_ms") - F.col("first_ms"), F.lit(1000))
    return rolled.select(
        "dt",
        "pl",
        flag("pl"),
        "sid",
        length.alias("visit_seconds"),
        F.col("n_view").alias("visit_steps"),
    )


def session_metrics(visits: DataFrame) -> DataFrame:
    """Per (day, platform or all, session): length in seconds and number of steps.

    A session on two platforms is one session under ``all``.
    """
    return _sessions(visits).select(
        "dt", mask_all("pl", flag("pl")).alias("platform"), "sid", "visit_seconds", "visit_steps"
    )


def _within(value: str, low: int, high: int | None) -> Column:
    lower = F.col(value) >= low
    return lower if high is None else lower & (F.col(value) <= high)


def session_bucket_counts(visits: DataFrame) -> DataFrame:
    """Per (day, platform or all): number of sessions, in all and in each bucket."""
    counts = [F.count(F.lit(1)).alias("session_count")]
    for buckets, prefix, value in (
        (TIME_BUCKETS, "time_", "visit_seconds"),
        (STEP_BUCKETS, "step_", "visit_steps"),
    ):
        counts += [
            F.count_if(_within(value, low, high)).alias(prefix + name)
            for name, low, high in buckets
        ]
    grouped = _sessions(visits).groupBy("dt", "pl", flag("pl")).agg(*counts)
    return grouped.select(
        "dt",
        mask_all("pl", flag("pl")).alias("platform"),
        *[c for c in grouped.columns if c not in ("dt", "pl", flag("pl"))],
    )


def _bucket_columns() -> list[str]:
    return [
        *["time_" + name for name, _, _ in TIME_BUCKETS],
        *["step_" + name for name, _, _ in STEP_BUCKETS],
    ]


def session_aggr_stat(visits: DataFrame) -> DataFrame:
    """Per (day, platform or all): sessions, and the share of them in each bucket."""
    return session_bucket_counts(visits).select(
        "dt",
        "platform",
        "session_count",
        *[round_share(c, "session_count").alias(c) for c in _bucket_columns()],
    )


def session_summary(visits: DataFrame) -> DataFrame:
    """The bucket counts as one text per (day, platform or all)."""
    counts = {c.split("_", 1)[1]: F.col(c) for c in _bucket_columns()}
    return session_bucket_counts(visits).select(
        "dt", "platform", bucket_summary("session_count", counts).alias("summary")
    )


def user_stats(visits: DataFrame) -> DataFrame:
    """Per (day, platform or all): users, launch events, sessions and whole steps per session."""
    return level_stats(visits, ("pl",), PLATFORM_LEVELS).select(
        "dt",
        F.col("pl").alias("platform"),
        F.col("users").alias("active_users"),
        F.col("launches").alias("new_install_users"),
        F.col("sessions").alias("session_count"),
        F.call_function("div", F.col("views"), F.col("sessions")).alias("session_length"),
    )


def device_location_stats(visits: DataFrame) -> DataFrame:
    """Per day, {platform, all} and {country; with province; with city}: users, sessions and
    bounced sessions."""
    return level_stats(visits, ("pl", *REGION_COLUMNS), DEVICE_LEVELS).select(
        "dt",
        F.col("pl").alias("platform"),
        *REGION_COLUMNS,
        F.col("users").alias("active_users"),
        "sessions",
        F.col("bounces").alias("bounce_sessions"),
    )


def location_flow(visits: DataFrame) -> DataFrame:
    """Per day and {country; with province; with city}: launches (nu), users (uv), views (pv),
    sessions (sn) and sessions with one event (on)."""
    return level_stats(visits, REGION_COLUMNS, LOCATION_LEVELS).select(
        "dt",
        *REGION_COLUMNS,
        F.col("launches").alias("nu"),
        F.col("users").alias("uv"),
        F.col("views").alias("pv"),
        F.col("sessions").alias("sn"),
        F.col("bounces").alias("on"),
    )


def event_stats(events: DataFrame) -> DataFrame:
    """Per day, {platform, all} and {event, all}: number of events.

    The cube runs on the counts per (day, platform, event), not on the events.
    """
    fine = events.groupBy("dt", "pl", "en").agg(F.count(F.lit(1)).alias("n"))
    day, pl, en = F.col("dt"), F.col("pl"), F.col("en")
    cube = fine.groupingSets([[day, pl, en], [day, pl], [day, en], [day]], day, pl, en).agg(
        F.grouping("pl").alias("_pl"), F.grouping("en").alias("_en"), F.sum("n").alias("times")
    )
    return cube.select(
        "dt",
        mask_all("pl", "_pl").alias("platform"),
        mask_all("en", "_en").alias("event_name"),
        "times",
    )


def explode_levels(events: DataFrame, levels=DEVICE_LEVELS) -> DataFrame:
    """Events per day and level of platform and location: the row expansion behind the
    rollups, made visible by counting."""
    dims = ("pl", *REGION_COLUMNS)
    fine = events.groupBy("dt", *dims).agg(F.count(F.lit(1)).alias("n"))
    columns = [F.col(c) for c in ("dt", *dims)]
    sets = [[F.col(c) for c in ("dt", *level)] for level in levels]
    rolled = fine.groupingSets(sets, *columns).agg(
        *[F.grouping(d).alias(flag(d)) for d in dims], F.sum("n").alias("n")
    )
    return rolled.select("dt", *[mask_all(d, flag(d)).alias(d) for d in dims], "n")
