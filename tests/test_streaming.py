import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from footfall import storage
from footfall.operators import reports
from footfall.operators.parse import enrich
from footfall.operators.sessions import stream_session_spans
from footfall.operators.visits import visit_grain
from footfall.plans.flow import publish_flow
from footfall.schemas import IP_RULES, REGION_COLUMNS
from footfall.sinks import land_stream
from footfall.sources import read_landed, stream_text_dir
from footfall.streaming.flow import (
    location_changes,
    location_state,
    read_flow,
    restate_flow,
    start_location_flow,
    state_report,
    stream_location_flow,
)
from footfall.streaming.words import (
    read_batch_counts,
    read_running_counts,
    start_batch_word_count,
    start_running_word_count,
)

DAY = 1704067200000


@pytest.fixture
def rules(spark):
    rows = [(i * 256, i * 256 + 255, "AB"[i % 2], f"p{i % 3}", f"c{i}") for i in range(6)]
    return spark.createDataFrame(rows, IP_RULES)


def _lines(seed, count):
    pick = random.Random(seed)
    out = []
    for _ in range(count):
        sid = pick.choice(["", *[f"&sid=s{i}" for i in range(80)]])
        out.append(
            f"0.0.{pick.randrange(8)}.1|{DAY + pick.randrange(2) * 86400000}|h|/l?"
            f"uid=u{pick.randrange(25)}&en={pick.choice(['e_l', 'e_pv', 'e_bp', 'e_s'])}{sid}"
        )
    return out


def _write(spark, path, lines):
    rows = spark.createDataFrame([(x,) for x in lines], "value string")
    rows.coalesce(1).write.mode("append").text(path)


def _expected(spark, path, rules):
    events = enrich(spark.read.text(path), rules)
    flow = reports.location_flow(visit_grain(events, REGION_COLUMNS))
    return Counter(tuple(r) for r in flow.collect())


def _found(spark, table):
    return Counter(tuple(r) for r in read_flow(spark, table).collect())


def test_flow_over_batches_and_restarts(spark, folder, rules):
    source, table, checkpoint = folder("in"), folder("flow"), folder("cp")
    for seed in range(4):
        # The same ids come again, alone and several times, in every batch.
        for part in range(2):
            _write(spark, source, _lines(10 * seed + part, 60))
        stream = stream_text_dir(spark, source, 1)
        stream_location_flow(
            stream, rules, table, checkpoint, state_partitions=2
        ).awaitTermination()
        assert _found(spark, table) == _expected(spark, source, rules)


def test_a_batch_that_runs_again_changes_nothing(spark, folder, rules, monkeypatch):
    """The query dies after the report was written and before the batch was committed."""
    from footfall import storage
    from footfall.streaming import flow

    source, table, checkpoint = folder("in"), folder("flow"), folder("cp")
    _write(spark, source, _lines(1, 80))
    stream = stream_text_dir(spark, source, 1)
    run = lambda: stream_location_flow(stream, rules, table, checkpoint, state_partitions=2)
    run().awaitTermination()
    _write(spark, source, _lines(2, 80))
    real = storage.remove

    def die(session, path):
        if path.endswith("/report_staging/-1"):
            raise RuntimeError("lost")
        real(session, path)

    monkeypatch.setattr(flow.storage, "remove", die)
    with pytest.raises(Exception, match="lost"):
        run().awaitTermination()
    assert _found(spark, table) == _expected(spark, source, rules)
    monkeypatch.setattr(flow.storage, "remove", real)
    run().awaitTermination()
    assert _found(spark, table) == _expected(spark, source, rules)
    _write(spark, source, _lines(3, 40))
    run().awaitTermination()
    assert _found(spark, table) == _expected(spark, source, rules)


def test_a_new_checkpoint_starts_again(spark, folder, rules):
    source, other, table = folder("in"), folder("other"), folder("flow")
    _write(spark, source, _lines(1, 50))
    _write(spark, other, _lines(1, 50) + _lines(2, 50))
    for path, checkpoint in ((source, folder("c1")), (other, folder("c2"))):
        stream = stream_text_dir(spark, path)
        query = stream_location_flow(stream, rules, table, checkpoint, state_partitions=2)
        query.awaitTermination()
    assert _found(spark, table) == _expected(spark, other, rules)
    publish_flow(spark, table, folder("out"))
    report = spark.read.parquet(folder("out") + "/stats_location_flow")
    assert report.count() == read_flow(spark, table).count()
    assert report.where("location_dimension_id is null or date_dimension_id is null").isEmpty()


def test_changes_do_not_need_an_increasing_clock(spark):
    """State rows of one session as they look after batches at 50, 90 and then 70."""
    schema = (
        "dt string, country string, province string, city string, uid string, sid string, "
        "_kind int, _all_country int, _all_province int, _all_city int, _n bigint, "
        "_launches bigint, _views bigint, _oldest bigint, _newest bigint, _sum decimal(30,0)"
    )

    def on(times, now):
        place = ("d", "A", None, None, None)
        n = len(times)
        rows = [
            (*place, "s", 1, 0, 1, 1, n, 0, 0, min(times), max(times), sum(times)),
            (*place, None, 2, 0, 1, 1, n, 0, 0, min(times), max(times), sum(times)),
        ]
        from decimal import Decimal

        rows = [(*r[:-1], Decimal(r[-1])) for r in rows]
        out = location_changes(spark.createDataFrame(rows, schema), now).collect()
        return [(r.sn, r.on) for r in out]

    assert on([70], 70) == [(1, 1)]
    assert on([70, 70], 70) == [(1, 0)]
    assert on([90, 70], 70) == [(0, -1)]
    assert on([50, 70, 70], 70) == [(0, -1)]
    assert on([90, 70, 70], 70) == [(0, -1)]
    assert on([50, 90, 70], 70) == [(0, 0)]
    assert on([90, 90, 70], 70) == [(0, 0)]
    # Two earlier events whose times add up like one earlier and two present ones.
    assert on([60, 80, 70], 70) == [(0, 0)]


def test_watermark_lets_state_go(spark, folder, rules):
    source, table, checkpoint = folder("in"), folder("flow"), folder("cp")
    day = 86400000
    line = "0.0.0.1|{}|h|/l?uid=u{}&en=e_pv&sid=s"
    sizes = []
    for step in range(4):
        _write(spark, source, [line.format(DAY + step * 3 * day + 5, step)])
        lines = stream_text_dir(spark, source, 1)
        state = location_state(enrich(lines, rules), delay="1 day")
        query = start_location_flow(state, table, checkpoint, state_partitions=1)
        query.awaitTermination()
        sizes.append(query.recentProgress[-1].stateOperators[0].numRowsTotal)
    assert max(sizes) <= 2 * sizes[0], sizes
    days = read_flow(spark, table).where("province = 'all'").orderBy("dt").collect()
    assert [(r.uv, r.pv, r.sn, r.on) for r in days] == [(1, 1, 1, 1)] * 4


TEXTS = [["a b", "a"], ["b  c", "a"], ["c"]]


def test_word_counts(spark, folder):
    total = Counter()
    for texts in TEXTS:
        _write(spark, folder("in"), texts)
        total.update(w for t in texts for w in t.split(" "))
        stream = stream_text_dir(spark, folder("in"), 1)
        start_batch_word_count(stream, folder("batch"), folder("c1")).awaitTermination()
        start_running_word_count(
            stream, folder("run"), folder("c2"), state_partitions=2, compact_every=2
        ).awaitTermination()
        running = read_running_counts(spark, folder("run")).collect()
        assert {r.word: r.n for r in running} == total
    # Batches 0 and 1 were made one folder; batch 1 may run again, so its own stays.
    assert sorted(storage.children(spark, folder("run"))) == [
        "batch_id=-2", "batch_id=1", "batch_id=2"
    ]
    per_batch = read_batch_counts(spark, folder("batch")).collect()
    assert Counter((r.batch_id, r.word, r.n) for r in per_batch) == Counter(
        (i, word, n)
        for i, texts in enumerate(TEXTS)
        for word, n in Counter(w for t in texts for w in t.split(" ")).items()
    )


def test_landing(spark, folder):
    _write(spark, folder("in"), ["x", "y"])
    stream = stream_text_dir(spark, folder("in"))
    land_stream(stream, folder("out"), folder("cp"), every=None).awaitTermination()
    assert sorted(r.value for r in read_landed(spark, folder("out")).collect()) == ["x", "y"]
    today = spark.range(1).select(F.current_date()).first()[0]
    assert read_landed(spark, folder("out"), today).count() == 2


def test_session_spans_as_a_stream(spark, folder):
    times = [0, 120, 241, 1000]
    _write(spark, folder("in"), [str(t) for t in times])
    _write(spark, folder("in"), ["90000"])
    events = stream_text_dir(spark, folder("in"), 1).select(
        F.lit("u").alias("uid"), F.timestamp_seconds(F.col("value").cast("int")).alias("event_ts")
    )
    spans = stream_session_spans(events.withWatermark("event_ts", "10 seconds"))
    writer = spans.writeStream.format("parquet").option("path", folder("out"))
    writer.option("checkpointLocation", folder("cp")).trigger(
        availableNow=True
    ).start().awaitTermination()
    found = spark.read.parquet(folder("out")).collect()
    seconds = sorted(
        (r.session_start.timestamp(), r.session_end.timestamp(), r.n_events) for r in found
    )
    assert [(b - a, n) for a, b, n in seconds] == [(120, 2), (0, 1), (0, 1)]


def _states(spark, folder, rules, lines, batches, name):
    source, table, checkpoint = folder(f"in{name}"), folder(f"flow{name}"), folder(f"cp{name}")
    for i in range(batches):
        _write(spark, source, lines[i::batches])
        stream = stream_text_dir(spark, source)
        stream_location_flow(stream, rules, table, checkpoint, state_partitions=2).awaitTermination()
    return spark.read.format("statestore").load(checkpoint).count(), table, checkpoint


def test_state_does_not_grow_with_batches_and_restates_the_report(spark, folder, rules):
    lines = _lines(5, 120)
    once, _, _ = _states(spark, folder, rules, lines, 1, "a")
    often, table, checkpoint = _states(spark, folder, rules, lines, 3, "b")
    assert once == often
    wanted = Counter(tuple(r) for r in read_flow(spark, table).collect())
    assert wanted == _expected(spark, folder("ina"), rules)
    # An earlier batch's state is the report as it was then.
    assert 0 < state_report(spark, checkpoint, 0).count() <= sum(wanted.values())
    storage.remove(spark, table)
    restate_flow(spark, checkpoint, table)
    assert Counter(tuple(r) for r in read_flow(spark, table).collect()) == wanted


def test_a_batch_is_run_once_and_kept_nowhere(spark, folder, rules, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def never(*_):
        raise AssertionError("a batch is looked at before its changes are written")

    for name in ("persist", "cache", "first"):
        monkeypatch.setattr(DataFrame, name, never)
    source, table, checkpoint = folder("in"), folder("flow"), folder("cp")
    _write(spark, source, _lines(1, 60))
    touched = []
    stream_location_flow(
        stream_text_dir(spark, source), rules, table, checkpoint, state_partitions=2,
        after=lambda _, days: touched.append(days),
    ).awaitTermination()
    monkeypatch.undo()
    assert _found(spark, table) == _expected(spark, source, rules)
    days = {row.dt for row in read_flow(spark, table).select("dt").distinct().collect()}
    assert [set(found) for found in touched] == [days]
