"""Running traffic per day and location.

The reported numbers are distinct counts, which do not add up over batches. The stream
keeps one native aggregate keyed by (day, location level, id), in update mode, so that each
batch hands over only the ids it touched. Whether an id is new, and whether a session had
one event before this batch, follows from the batch times an id was seen in: their smallest,
their largest and their sum. Each batch therefore yields exact changes per location, and the
report is brought up to date by adding them: its cost follows the batch, not the history.
Nothing is held in Python and no group is collected.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall import storage
from footfall.functions import is_launch, is_view, mask_all
from footfall.operators.parse import enrich
from footfall.operators.reports import LOCATION_LEVELS
from footfall.operators.visits import flag
from footfall.schemas import REGION_COLUMNS
from footfall.sinks.streams import trigger
from footfall.sinks.tables import is_ready, merge_partitions
from footfall.streaming.control import state_settings

FLOW_KEYS = ("dt", *REGION_COLUMNS)
# The level tells a location's ``all`` from a province or city of that name.
TABLE_KEYS = ("dt", "level", *REGION_COLUMNS)
MEASURES = ("nu", "uv", "pv", "sn", "on")
TOTALS = ("nu", "pv")
FLAGS = tuple(flag(c) for c in REGION_COLUMNS)

# Kinds of state rows.
USER, SESSION, TOTAL = 0, 1, 2


def location_state(records: DataFrame, delay: str | None = None) -> DataFrame:
    """The streaming aggregate: per day, location level and user, session or nothing.

    ``_now``, the time of the batch being handled, is added behind the aggregate, where it is the
    same for all rows and no part of the state. By default state is kept for good, as any day may still get events; ``delay`` puts a
    watermark on the event time, drops later events and lets the state of closed days go.
    """
    batch_time = F.unix_millis(F.current_timestamp())
    events = records.select(
        *FLOW_KEYS,
        "uid",
        "sid",
        F.coalesce(is_launch("en").cast("int"), F.lit(0)).alias("_launch"),
        F.coalesce(is_view("en").cast("int"), F.lit(0)).alias("_view"),
        batch_time.alias("_batch"),
        F.timestamp_millis("access_time_ms").alias("_time"),
    )
    always = ["dt"]
    if delay:
        events = events.withWatermark("_time", delay).withColumn("_day", F.window("_time", "1 day"))
        always.append("_day")
    choices = [
        (*level, *one) for level in LOCATION_LEVELS for one in (("uid",), ("sid",), ())
    ]
    sets = [[F.col(c) for c in (*always, *choice)] for choice in choices]
    columns = [F.col(c) for c in (*always, *REGION_COLUMNS, "uid", "sid")]
    kind = (
        F.when(F.grouping("uid") == 0, USER)
        .when(F.grouping("sid") == 0, SESSION)
        .otherwise(TOTAL)
    )
    state = events.groupingSets(sets, *columns).agg(
        kind.alias("_kind"),
        *[F.grouping(c).cast("int").alias(flag(c)) for c in REGION_COLUMNS],
        F.count(F.lit(1)).alias("_n"),
        F.sum("_launch").alias("_launches"),
        F.sum("_view").alias("_views"),
        F.min("_batch").alias("_oldest"),
        F.max("_batch").alias("_newest"),
        F.sum(F.col("_batch").cast("decimal(20,0)")).alias("_sum"),
    )
    return state.withColumn("_now", batch_time)


def location_changes(updated: DataFrame, now: int | Column) -> DataFrame:
    """Changes per location out of the state rows one batch updated.

    ``is_new`` tells a location the stream had not seen before; nu and pv are its totals,
    uv, sn and on are differences. Batch times need only differ from each other: a clock
    that is set back does no harm.
    """
    fresh = F.col("_oldest") == F.col("_newest")
    other = F.when(F.col("_oldest") == now, F.col("_newest")).otherwise(F.col("_oldest"))
    # The sum fits only if a single event came earlier and all others in this batch.
    one_before = ~fresh & (F.col("_sum") == other + (F.col("_n") - 1) * F.lit(now))
    user, session = F.col("_kind") == USER, F.col("_kind") == SESSION
    total = F.col("_kind") == TOTAL
    changes = updated.groupBy(*FLOW_KEYS, *FLAGS).agg(
        F.max(F.when(total, F.col("_launches"))).alias("nu"),
        F.count_if(user & fresh).alias("uv"),
        F.max(F.when(total, F.col("_views"))).alias("pv"),
        F.count_if(session & fresh).alias("sn"),
        (
            F.count_if(session & fresh & (F.col("_n") == 1)) - F.count_if(session & one_before)
        ).alias("on"),
        F.bool_or(total & fresh).alias("is_new"),
    )
    masked = [mask_all(c, flag(c)).alias(c) for c in REGION_COLUMNS]
    level = F.lit(len(FLAGS)) - sum((F.col(f) for f in FLAGS), F.lit(0))
    return changes.select("dt", level.alias("level"), *masked, *MEASURES, "is_new")


def add_changes(old: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The report rows of the touched days after the changes."""
    columns = [*TABLE_KEYS, *MEASURES]
    if old is None:
        return changes.select(*columns)
    a = old.select(*columns).alias("a")
    b = changes.withColumn("_hit", F.lit(True)).alias("b")
    on = F.lit(True)
    for key in TABLE_KEYS:
        on = on & F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    hit = F.col("b._hit").isNotNull()
    values = []
    for name in MEASURES:
        before, change = F.col(f"a.{name}"), F.col(f"b.{name}")
        if name not in TOTALS:
            change = change + F.when(F.col("b.is_new"), 0).otherwise(F.coalesce(before, F.lit(0)))
        values.append(F.when(hit, change).otherwise(before).alias(name))
    keys = [
        F.when(hit, F.col(f"b.{k}")).otherwise(F.col(f"a.{k}")).alias(k) for k in TABLE_KEYS
    ]
    return a.join(b, on, "full_outer").select(*keys, *values)


def start_location_flow(
    state: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    state_partitions: int | None = None,
    after: Callable[[SparkSession, list[date]], None] | None = None,
) -> StreamingQuery:
    """Keep ``table`` up to date with the aggregate of :func:`location_state`.

    A batch that is run again finds its complete staging folder next to the checkpoint and
    only finishes moving it, so nothing is added twice. With a new checkpoint the numbers of
    every location start again when it is first seen. ``after`` is called with the days a
    batch touched, once they are up to date; after a restart perhaps once more.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # The batch is run once and kept nowhere: its changes are the only thing made of it.
        spark, staging = batch.sparkSession, f"{checkpoint}/report_staging/{batch_id}"
        if is_ready(spark, staging):
            # The report has it already, but the state has to take it in, in every partition.
            batch.write.format("noop").mode("overwrite").save()
        days = merge_partitions(
            location_changes(batch, F.col("_now")),
            table,
            add_changes,
            staging,
            once=True,
            fresh_as_is=False,
        )
        if after and days:
            after(spark, days)
        storage.remove(spark, f"{checkpoint}/report_staging/{batch_id - 2}")

    with state_settings(state.sparkSession, state_partitions):
        writer = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(apply)
        )
        return trigger(writer, every).start()


def stream_location_flow(
    lines: DataFrame,
    rules: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    delay: str | None = None,
    state_partitions: int | None = None,
    after: Callable[[SparkSession, list[date]], None] | None = None,
) -> StreamingQuery:
    """From a stream of log lines to the running report.

    The progress of each batch counts the lines left out, under ``lines``.
    """
    state = location_state(enrich(lines, rules, "lines"), delay)
    return start_location_flow(state, table, checkpoint, every, state_partitions, after)


# What the state's rows hold, in the order of the aggregates of location_state.
STATE_VALUE = (
    "struct<n:bigint,launches:bigint,views:bigint,oldest:bigint,newest:bigint,"
    "sum:decimal(30,0),empty:boolean>"
)


def state_report(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The report as the state of a flow query has it, after a batch or the last one.

    Every id of every level has its row in the state, so the numbers are counted from it alone.
    The query should stand still. With a delay the state has let go of the oldest days.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load(checkpoint).select(
        "key.*", F.col("value").cast(STATE_VALUE).alias("value")
    )
    # The grouping id has a bit per column, the last one lowest; set where it is rolled up.
    columns = (*REGION_COLUMNS, "uid", "sid")
    rolled = {
        c: F.shiftright("spark_grouping_id", place).bitwiseAND(F.lit(1)).cast("int")
        for place, c in enumerate(reversed(columns))
    }
    rows = rows.select(
        *FLOW_KEYS,
        "value",
        (rolled["uid"] == 0).alias("user"),
        (rolled["sid"] == 0).alias("session"),
        *[rolled[c].alias(flag(c)) for c in REGION_COLUMNS],
    )
    user, session = F.col("user"), F.col("session")
    report = rows.groupBy(*FLOW_KEYS, *FLAGS).agg(
        F.max(F.when(~user & ~session, F.col("value.launches"))).alias("nu"),
        F.count_if(user).alias("uv"),
        F.max(F.when(~user & ~session, F.col("value.views"))).alias("pv"),
        F.count_if(session).alias("sn"),
        F.count_if(session & (F.col("value.n") == 1)).alias("on"),
    )
    masked = [mask_all(c, flag(c)).alias(c) for c in REGION_COLUMNS]
    level = F.lit(len(FLAGS)) - sum((F.col(f) for f in FLAGS), F.lit(0))
    return report.select("dt", level.alias("level"), *masked, *MEASURES)


def restate_flow(spark: SparkSession, checkpoint: str, table: str) -> None:
    """Write the days the state knows anew, where a report is lost or wrong.

    The query goes on from its checkpoint afterwards, as if nothing had happened. Days the state
    does not know are left as they are.
    """
    staging = f"{checkpoint}/report_staging/restated-{uuid.uuid4().hex}"
    merge_partitions(state_report(spark, checkpoint), table, lambda old, new: new, staging)
    storage.remove(spark, staging)


def read_flow(
    spark: SparkSession, table: str, days: Sequence[date] | None = None
) -> DataFrame:
    """The report, of all days or the given ones; then only their folders are listed."""
    table = table.rstrip("/")
    folders = [table] if days is None else [f"{table}/dt={day:%Y-%m-%d}" for day in days]
    read = spark.read.option("basePath", table).parquet(*folders)
    return read.select(*FLOW_KEYS, *MEASURES)
