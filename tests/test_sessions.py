import random
from collections import defaultdict

import pytest

from conftest import plan_of
from footfall.operators import sessions, words

GAP = 120_000


def _brute(events):
    by_user = defaultdict(list)
    for e in events:
        by_user[e[1]].append(e)
    out = {}
    for user, own in by_user.items():
        own.sort(key=lambda e: e[2])
        number, last = 0, None
        for i, _, ts in own:
            if last is None or ts - last > GAP:
                number += 1
            out[i] = (user, ts, number)
            last = ts
    return out


@pytest.fixture(scope="module")
def events():
    pick = random.Random(3)
    out, at = [], defaultdict(int)
    for i in range(3000):
        # One user has a third of all events.
        user = "hot" if i % 3 == 0 else f"u{pick.randrange(40)}"
        at[user] += pick.choice([0, 1, 5000, GAP, GAP + 1, GAP, 10**6, 3 * 10**6])
        out.append((i, user, at[user]))
    pick.shuffle(out)
    return out


@pytest.mark.parametrize("chunk_ms", [1000, 15 * 60 * 1000, 10**12])
def test_sessionize(spark, events, chunk_ms):
    df = spark.createDataFrame(events, "event_id bigint, uid string, access_time_ms bigint")
    out = sessions.sessionize(df, chunk_ms=chunk_ms)
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == _brute(events)


def test_spans(spark, events):
    df = spark.createDataFrame(events, "event_id bigint, uid string, access_time_ms bigint")
    wanted = defaultdict(list)
    for user, ts, number in _brute(events).values():
        wanted[(user, number)].append(ts)
    found = {tuple(r)[:2]: tuple(r)[2:] for r in sessions.session_spans(df).collect()}
    assert found == {k: (min(v), max(v), len(v)) for k, v in wanted.items()}


def test_events_are_not_shuffled_by_user_alone(spark, events):
    df = spark.createDataFrame(events, "event_id bigint, uid string, access_time_ms bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan_of(sessions.sessionize(df)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = [n for n, line in enumerate(lines) if "SortMergeJoin" in line][0]
    left = [x for x in lines[above:] if x.lstrip().startswith((":", "+")) and "Exchange" in x]
    assert "_chunk" in left[0]


def test_without_user(spark):
    df = spark.createDataFrame([(1, None, 5)], "event_id bigint, uid string, access_time_ms bigint")
    assert [r.session_no for r in sessions.sessionize(df).collect()] == [None]
    assert [r.is_first for r in sessions.first_visit_flag(df).collect()] == [False]


def test_first_visits(spark, events):
    df = spark.createDataFrame(events, "event_id bigint, uid string, access_time_ms bigint")
    firsts = {}
    for i, user, ts in events:
        firsts[user] = min(firsts.get(user, (ts, i)), (ts, i))
    found = sessions.first_visit_flag(df).collect()
    assert len(found) == len(events)
    for row in found:
        assert row.is_first == (firsts[row.uid] == (row.access_time_ms, row.event_id))


def test_words(spark):
    texts = ["a b", " a", "a  b ", "", "   ", "a\tb", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = {r.word: r.n for r in words.word_count(df, "text").collect()}
    # Parts as the JVM splits them: empty ones at the end are left out.
    assert counts == {"a": 3, "b": 2, "": 3, "a\tb": 1}


def test_events_without_a_user_are_apart(spark, events):
    rows = [(i, None if i % 3 else user, ts) for i, user, ts in events]
    df = spark.createDataFrame(rows, "event_id bigint, uid string, access_time_ms bigint")
    out = {r[0]: r[3] for r in sessions.sessionize(df).collect()}
    wanted = _brute([r for r in rows if r[1]])
    assert out == {i: wanted[i][2] if user else None for i, user, _ in rows}
    assert "_apart" in plan_of(sessions.sessionize(df))
