"""Sessions cut by inactivity, and first visits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a session ends after two minutes without an event.
SESSION_GAP_MS = 2 * 60 * 1000
CHUNK_MS = 15 * 60 * 1000


def sessionize(
    events: DataFrame,
    user: str = "uid",
    ts: str = "access_time_ms",
    gap_ms: int = SESSION_GAP_MS,
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """Add ``session_no``: 1 for a user's first session, one more after each longer pause.

    A pause of exactly the gap does not end a session, and an event without a user has none.
    The window runs per user and chunk of time, so that the events of one hot user spread
    over many tasks. What crosses a chunk border is settled on one row per user and chunk,
    and joined back on both.
    """
    chunked = events.withColumn(
        "_chunk", F.call_function("div", F.col(ts), F.lit(chunk_ms))
    ).withColumn(
        # Events without a user are set apart from each other: they belong to no session.
        "_apart",
        F.when(F.col(user).isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0)),
    )
    inside = Window.partitionBy(user, "_chunk", "_apart").orderBy(ts)
    pause = F.col(ts) - F.lag(ts).over(inside)
    marked = chunked.withColumn("_starts", F.coalesce((pause > gap_ms).cast("int"), F.lit(0)))
    along = Window.partitionBy(user).orderBy("_chunk")
    border = (
        marked.where(F.col(user).isNotNull())
        .groupBy(user, "_chunk")
        .agg(
            F.min(ts).alias("_first"),
            F.max(ts).alias("_last"),
            F.sum("_starts").alias("_inner"),
        )
        .withColumn("_gap", F.col("_first") - F.lag("_last").over(along))
        .withColumn("_new", F.coalesce((F.col("_gap") > gap_ms).cast("int"), F.lit(1)))
        .withColumn("_carried", F.coalesce(F.lag("_inner").over(along), F.lit(0)))
        .select(
            F.col(user).alias("_user"),
            F.col("_chunk").alias("_border_chunk"),
            F.sum(F.col("_new") + F.col("_carried"))
            .over(along.rowsBetween(Window.unboundedPreceding, 0))
            .alias("_base"),
        )
    )
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.withColumn("_step", F.sum("_starts").over(upto))
    on = (F.col(user) == F.col("_user")) & (F.col("_chunk") == F.col("_border_chunk"))
    return numbered.join(border, on, "left").select(
        *events.columns, (F.col("_base") + F.col("_step")).alias("session_no")
    )


def session_spans(
    events: DataFrame,
    user: str = "uid",
    ts: str = "access_time_ms",
    gap_ms: int = SESSION_GAP_MS,
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """First and last event and number of events of each session.

    Built on :func:`sessionize` and not on a session window, which would bring all events of
    a user together in one task.
    """
    numbered = sessionize(events.select(user, ts), user, ts, gap_ms, chunk_ms)
    return numbered.where(F.col(user).isNotNull()).groupBy(user, "session_no").agg(
        F.min(ts).alias("start_ms"), F.max(ts).alias("end_ms"), F.count(F.lit(1)).alias("n_events")
    )


def stream_session_spans(
    events: DataFrame, user: str = "uid", ts: str = "event_ts", gap: str = "2 minutes"
) -> DataFrame:
    """The same over a stream with a watermark on ``ts``, once each session has ended.

    :func:`footfall.configure` has Spark merge sessions before the shuffle, so that a hot
    user sends one row per session and task.
    """
    return (
        events.groupBy(user, F.session_window(ts, gap))
        .agg(
            F.min(ts).alias("session_start"),
            F.max(ts).alias("session_end"),
            F.count(F.lit(1)).alias("n_events"),
        )
        .drop("session_window")
    )


def first_visits(
    events: DataFrame, user: str = "uid", ts: str = "access_time_ms", tie: str = "event_id"
) -> DataFrame:
    """Time and id of each user's first event."""
    first = F.min(F.struct(ts, tie))
    return (
        events.groupBy(user)
        .agg(first.alias("_first"))
        .select(user, F.col("_first")[ts].alias(ts), F.col("_first")[tie].alias(tie))
    )


def first_visit_flag(
    events: DataFrame, user: str = "uid", ts: str = "access_time_ms", tie: str = "event_id"
) -> DataFrame:
    """Add ``is_first``, true for the first event of each user.

    ``tie`` must tell the events of one moment apart. The first events come from an
    aggregation and are matched on user, time and id together, so that the events of a hot
    user spread over all tasks.
    """
    names = [user, ts, tie]
    firsts = first_visits(events, user, ts, tie).select(
        *[F.col(c).alias(f"_{c}") for c in names], F.lit(True).alias("_hit")
    )
    on = reduce(Column.__and__, [F.col(c) == F.col(f"_{c}") for c in names])
    return events.join(firsts, on, "left").select(
        *events.columns, F.coalesce("_hit", F.lit(False)).alias("is_first")
    )
