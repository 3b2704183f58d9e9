"""Session numbers and first visits of a stream, event by event.

Events come in any order within the watermark's delay. They wait in state until the watermark has
passed them; a timer then hands them on in the order of time and id, so what a user gets does not
depend on how events fell into batches. An event older than the watermark is late and left out, as
everywhere in Spark. Sessions that have ended are handed on by a timer too.

State is kept per group of users, by a hash of the user: a group's events come and go as one frame,
so that neither a call nor a frame is spent on each user's few events.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from footfall.operators.sessions import SESSION_GAP_MS
from footfall.session import importable

#: Groups of users; a checkpoint keeps their number for good.
GROUPS = 1 << 12
#: Events in one row of the waiting list.
PIECE_ROWS = 10_000
PIECE = "uid ARRAY<STRING>, ts ARRAY<BIGINT>, id ARRAY<BIGINT>"
NUMBERED = "uid STRING, event_id BIGINT, access_time_ms BIGINT, session_no BIGINT"
SPANS = "start_ms BIGINT, end_ms BIGINT, n_events BIGINT"


class InOrder(StatefulProcessor):
    """Gives a group's events to ``take`` once the watermark has passed them, in order.

    A timer per batch and group stands behind the batch's last event; when it goes off, all events
    that the watermark has passed are taken. State holds what is younger than the watermark, and what
    ``take`` keeps.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", PIECE)

    def fresh(self, events: pd.DataFrame) -> pd.DataFrame:
        """The events that need to wait."""
        return events

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        last = None
        for batch in rows:
            events = pd.DataFrame(
                {"uid": batch["uid"], "ts": batch["access_time_ms"], "id": batch["event_id"]}
            )
            events = self.fresh(events[events["ts"] >= watermark])
            if len(events):
                self.waiting.appendList(_packed(events))
                last = max(int(events["ts"].max()), last or 0)
        if last is not None:
            self.handle.registerTimer(last + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        pieces = [pd.DataFrame(dict(zip(("uid", "ts", "id"), row))) for row in self.waiting.get()]
        if pieces:
            waiting = pd.concat(pieces, ignore_index=True)
            passed = waiting["ts"] < watermark
            if not passed.all():
                self.waiting.put(_packed(waiting[~passed]))
            else:
                self.waiting.clear()
            ready = waiting[passed].sort_values(["uid", "ts", "id"], ignore_index=True)
        else:
            ready = pd.DataFrame({"uid": [], "ts": [], "id": []})
        yield from self.take(ready, watermark)

    def take(self, events: pd.DataFrame, watermark: int) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def close(self) -> None:
        pass


def _packed(events: pd.DataFrame) -> list[tuple]:
    parts = (events.iloc[i : i + PIECE_ROWS] for i in range(0, len(events), PIECE_ROWS))
    return [tuple(part[c].tolist() for c in ("uid", "ts", "id")) for part in parts]


class Sessions(InOrder):
    """Numbers users' events by session; a session that has ended comes as a row of its own.

    ``last_no`` holds the number of each user's last session, ``open`` the sessions that have not
    ended, as one row, since a timer looks at all of them.
    """

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last_no = handle.getMapState("last_no", "uid STRING", "no BIGINT")
        self.open = handle.getValueState(
            "open",
            "uid ARRAY<STRING>, no ARRAY<BIGINT>, first ARRAY<BIGINT>, last ARRAY<BIGINT>, n ARRAY<BIGINT>",
        )

    def _number(self, user: str) -> int:
        return self.last_no.getValue((user,))[0] if self.last_no.containsKey((user,)) else 0

    def take(self, events, watermark):
        held = self.open.get() if self.open.exists() else ([], [], [], [], [])
        current = {user: tuple(row) for user, *row in zip(*held)}
        users, times = events["uid"].to_numpy(object), events["ts"].to_numpy(np.int64)
        numbers, ended = np.empty(len(events), np.int64), []
        cuts = [*np.flatnonzero(users[1:] != users[:-1]) + 1, len(users)] if len(users) else []
        begin = 0
        for end in cuts:
            user = users[begin]
            known = current.get(user)
            no, first, last, n = known or (self._number(user), None, None, 0)
            before = no
            for i, ts in enumerate(times[begin:end].tolist(), begin):
                if n == 0 or ts - last > self.gap_ms:
                    if n:
                        ended.append((user, no, first, last, n))
                    no, first, n = no + 1, ts, 0
                last, n = ts, n + 1
                numbers[i] = no
            if no != before:
                self.last_no.updateValue((user,), (no,))
            current[user] = (no, first, last, n)
            begin = end
        # A session is over when nothing that may still come belongs to it.
        over = [user for user, row in current.items() if watermark > row[2] + self.gap_ms]
        ended += [(user, *current.pop(user)) for user in over]
        if current:
            self.open.update(([*current], *map(list, zip(*current.values()))))
            self.handle.registerTimer(min(row[2] for row in current.values()) + self.gap_ms + 1)
        elif held[0]:
            self.open.clear()
        if len(events):
            yield _rows(events["uid"], events["id"], events["ts"], numbers, None, None, None)
        if ended:
            uid, no, first, last, n = zip(*ended)
            yield _rows(uid, None, None, no, first, last, n)


def _rows(*columns) -> pd.DataFrame:
    names = "uid event_id access_time_ms session_no start_ms end_ms n_events".split()
    size = len(columns[0])
    values = {
        name: [None] * size if column is None else column for name, column in zip(names, columns)
    }
    return pd.DataFrame(values).astype({name: "Int64" for name in names[1:]})


class FirstVisit(InOrder):
    """Hands on users' first events, and nothing after them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.seen = handle.getMapState("seen", "uid STRING", "ts BIGINT")

    def fresh(self, events):
        seen = {user for user in events["uid"].unique() if self.seen.containsKey((user,))}
        return events[~events["uid"].isin(seen)] if seen else events

    def take(self, events, watermark):
        firsts = events.drop_duplicates("uid")
        # As booleans also where there are none: an empty list would choose no columns.
        unseen = [not self.seen.containsKey((user,)) for user in firsts["uid"]]
        firsts = firsts[np.array(unseen, dtype=bool)]
        for user, ts in zip(firsts["uid"], firsts["ts"].tolist()):
            self.seen.updateValue((user,), (ts,))
        if len(firsts):
            yield pd.DataFrame(
                {"uid": firsts["uid"], "event_id": firsts["id"], "access_time_ms": firsts["ts"]}
            )


def _by_user(events: DataFrame, processor: InOrder, schema: str, groups: int) -> DataFrame:
    importable(events.sparkSession)
    group = F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")
    return (
        events.where("uid IS NOT NULL")
        .withColumn("_group", group)
        .groupBy("_group")
        .transformWithStateInPandas(
            processor, outputStructType=schema, outputMode="Append", timeMode="EventTime"
        )
    )


def stream_sessionize(
    events: DataFrame, gap_ms: int = SESSION_GAP_MS, groups: int = GROUPS
) -> DataFrame:
    """Numbered events and ended sessions of a stream ``uid event_id access_time_ms event_ts``.

    ``event_ts`` is the time as a timestamp and carries the watermark. A row with ``event_id`` is
    an event with its ``session_no``, as :func:`footfall.operators.sessions.sessionize` numbers
    them; one without is a session: its number, ``start_ms end_ms n_events``. Events without a
    user are in no session and left out. A user costs one row of state for good, and their events
    of the watermark's delay. State is kept in ``groups`` of users; a group's waiting events fit a
    task's memory, so more users need more groups. State must be kept in RocksDB
    (:func:`footfall.streaming.control.state_settings`).
    """
    return _by_user(events, Sessions(gap_ms), f"{NUMBERED}, {SPANS}", groups)


def stream_first_visits(events: DataFrame, groups: int = GROUPS) -> DataFrame:
    """``uid event_id access_time_ms``: each user's first event by time and id, once the watermark
    has passed it. For the input see :func:`stream_sessionize`."""
    schema = "uid STRING, event_id BIGINT, access_time_ms BIGINT"
    return _by_user(events, FirstVisit(), schema, groups)
