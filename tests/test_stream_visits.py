"""Sessions and first visits of a stream whose events come out of order."""

import random

import pytest
from pyspark.sql import functions as F

from footfall.operators.sessions import session_spans, sessionize
from footfall.streaming.control import state_settings
from footfall.streaming.visits import stream_first_visits, stream_sessionize

MINUTE = 60_000
START = 1_704_067_200_000


def _batches(seed):
    """Four slices of time; an event may come one slice late, if it is no older than 10 minutes."""
    draw, slices = random.Random(seed), [[], [], [], [], []]
    for i in range(300):
        ts = START + draw.randrange(120) * MINUTE + draw.choice([0, 0, 500])
        at = (ts - START) // (30 * MINUTE)
        late = (ts - START) % (30 * MINUTE) > 20 * MINUTE and draw.random() < 0.5
        slices[at + late].append((draw.choice("abc"), i, ts))
    slices.append([("end", 10**6, START + 10**10)])
    return slices


def _run(spark, folder, make, slices):
    source, out, checkpoint = (folder(n) for n in ("source", "out", "checkpoint"))
    for rows in slices:
        frame = spark.createDataFrame(rows, "uid string, event_id long, access_time_ms long")
        frame.repartition(2).write.mode("append").json(source)
        stream = spark.readStream.schema(frame.schema).json(source)
        stream = stream.withColumn("event_ts", F.timestamp_millis("access_time_ms"))
        with state_settings(spark, 2):
            writer = make(stream.withWatermark("event_ts", "12 minutes")).writeStream
            writer = writer.format("parquet").option("path", out)
            writer.option("checkpointLocation", checkpoint).trigger(
                availableNow=True
            ).start().awaitTermination()
    return spark.read.parquet(out).where("uid <> 'end'")


@pytest.fixture(scope="module")
def slices():
    return _batches(3)


@pytest.fixture(scope="module")
def events(spark, slices):
    rows = [row for part in slices[:-1] for row in part]
    return spark.createDataFrame(rows, "uid string, event_id long, access_time_ms long")


def test_numbers_are_those_of_the_batch(spark, folder, slices, events):
    found = _run(spark, folder, stream_sessionize, slices)
    numbered = found.where("event_id IS NOT NULL").select("uid", "event_id", "session_no")
    wanted = sessionize(events).select("uid", "event_id", "session_no")
    assert sorted(numbered.collect()) == sorted(wanted.collect())
    spans = found.where("event_id IS NULL").select("uid", "session_no", "start_ms", "end_ms", "n_events")
    wanted = session_spans(events).select(*spans.columns)
    assert sorted(spans.collect()) == sorted(wanted.collect())


def test_first_visits_are_those_of_the_batch(spark, folder, slices, events):
    found = _run(spark, folder, stream_first_visits, slices)
    first = events.groupBy("uid").agg(F.min(F.struct("access_time_ms", "event_id")).alias("m"))
    wanted = first.select("uid", "m.event_id", "m.access_time_ms").collect()
    assert sorted(found.select("uid", "event_id", "access_time_ms").collect()) == sorted(wanted)


def test_users_of_a_group_share_its_frames(spark, folder, slices, events):
    """All users in one group, and hardly any two in one, get the same."""
    found = [
        _run(spark, lambda n, g=g: folder(f"{n}{g}"), lambda s, g=g: stream_sessionize(s, groups=g), slices)
        for g in (1, 1000)
    ]
    one, many = (sorted(f.na.fill(-1).collect()) for f in found)
    assert one == many and len(one) > events.count()


def test_a_timer_without_waiting_events_gives_nothing():
    import pandas as pd

    from footfall.streaming.visits import FirstVisit

    first = FirstVisit()
    first.seen = None
    assert list(first.take(pd.DataFrame({"uid": [], "ts": [], "id": []}), 0)) == []
