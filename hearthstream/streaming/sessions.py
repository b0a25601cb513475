"""Event windows as keyed state with timers."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hearthstream.operators import sessions as S

OUTPUT_DDL = (
    "camera string, detection_type string, start_ms bigint, end_ms bigint, event_count bigint, "
    "copy_after bigint, status string"
)

EVENT_COLUMNS = ["event_id", "start_ms", "end_ms", "arrival"]

# Seconds for which the ids of closed sessions are remembered.
KEEP_IDS = 7 * 86400

# The ids of a key are kept in this many slots, so that a batch of many ids reads and
# writes the state by the slot and not by the id.  A checkpoint is bound to the number.
SLOTS = 1024

CLOSED = "closed"
CANCELLED = "cancelled"


class SessionProcessor(StatefulProcessor):
    """One open session per (camera, detection type).

    State: the open session; and per event id the number of the session it
    belongs to and when it was last seen.  An id of an earlier session is done and
    ignored, until it has not been seen for ``keep`` seconds: then it is forgotten,
    so the state holds the ids of that time and no more.  The ids lie in the slots of a
    state map, each a row of the state store; a batch reads and writes the slots of its
    ids once, and all are swept once in ``keep``.

    A session is due ``trail + delay`` seconds after its latest end.  If it was
    opened by an event without end, and that event is still alone in it after
    ``timeout`` seconds, the session is cancelled; then its id is forgotten.
    """

    def __init__(self, trail: int, delay: int, timeout: int, by_arrival: bool, keep: int = KEEP_IDS):
        self.trail, self.delay, self.timeout = trail, delay, timeout
        self.by_arrival, self.keep = by_arrival, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState(
            "open",
            "number bigint, start_ms bigint, end_ms bigint, due bigint, events bigint, "
            "first_id string, waiting_since bigint",
        )
        self.counter = handle.getValueState("counter", "number bigint, swept bigint")
        self.session_of = handle.getMapState(
            "session_of", "slot int",
            "ids array<string>, numbers array<bigint>, seen array<bigint>",
        )

    # -- helpers ----------------------------------------------------------

    def _row(self, key: Any, session: dict, status: str) -> dict:
        return {
            "camera": key[0],
            "detection_type": key[1],
            "start_ms": session["start_ms"],
            "end_ms": session["end_ms"],
            "event_count": session["events"],
            "copy_after": session["due"],
            "status": status,
        }

    @staticmethod
    def _slot(event_id: str) -> int:
        return zlib.crc32(event_id.encode()) % SLOTS

    def _ids(self, slots: dict[int, dict], event_id: str) -> dict[str, tuple[int, int]]:
        """The ids of a slot with number and time last seen, read once per call."""
        slot = self._slot(event_id)
        if slot not in slots:
            stored = self.session_of.getValue((slot,))
            slots[slot] = {i: (n, t) for i, n, t in zip(*stored)} if stored else {}
        return slots[slot]

    def _store(self, slot: int, ids: dict[str, tuple[int, int]]) -> None:
        if ids:
            numbers, seen = zip(*ids.values())
            self.session_of.updateValue((slot,), (list(ids), list(numbers), list(seen)))
        else:
            self.session_of.removeKey((slot,))

    def _settle(
        self, key: Any, session: dict | None, now: int, out: list[dict], slots: dict[int, dict],
        changed: set[int],
    ) -> dict | None:
        """Cancel or close the session if its time has come.

        The id of a cancelled one is forgotten.
        """
        if session is None:
            return None
        if session["waiting_since"] is not None and now > session["waiting_since"] + self.timeout:
            session["waiting_since"] = None
            if session["end_ms"] == 0 and session["events"] == 1:
                self._ids(slots, session["first_id"]).pop(session["first_id"], None)
                changed.add(self._slot(session["first_id"]))
                out.append(self._row(key, session, CANCELLED))
                return None
        if session["end_ms"] > 0 and now >= session["due"]:
            out.append(self._row(key, session, CLOSED))
            return None
        return session

    def _add(self, session: dict | None, number: int, event: Any, now: int) -> dict:
        end = 0 if pd.isna(event.end_ms) else int(event.end_ms)
        due = end // 1000 + self.trail + self.delay if end > 0 else 0
        if session is None:
            return {
                "number": number,
                "start_ms": int(event.start_ms),
                "end_ms": end,
                "due": due,
                "events": 1,
                "first_id": event.event_id,
                "waiting_since": None if end > 0 else now,
            }
        if end > 0 and event.event_id == session["first_id"]:
            session["waiting_since"] = None
        session["start_ms"] = min(session["start_ms"], int(event.start_ms))
        session["end_ms"] = max(session["end_ms"], end)
        session["due"] = max(session["due"], due)
        session["events"] += 1
        return session

    def _load(self) -> dict | None:
        if not self.open.exists():
            return None
        names = ("number", "start_ms", "end_ms", "due", "events", "first_id", "waiting_since")
        return dict(zip(names, self.open.get()))

    def _save(self, session: dict | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if session is None:
            self.open.clear()
            return
        self.open.update(tuple(session.values()))
        alarms = []
        if session["waiting_since"] is not None:
            alarms.append(session["waiting_since"] + self.timeout + 1)
        if session["end_ms"] > 0:
            alarms.append(session["due"])
        if alarms:
            self.handle.registerTimer(min(alarms) * 1000)

    def _sweep(self, now: int, open_number: int | None) -> None:
        """Forget the ids of earlier sessions that have not been seen for ``keep`` seconds."""
        kept: dict[int, dict] = {}
        for (slot,), stored in self.session_of.iterator():
            ids = {
                i: (n, t) for i, n, t in zip(*stored) if n == open_number or t >= now - self.keep
            }
            if len(ids) < len(stored[0]):
                kept[slot] = ids
        for slot, ids in kept.items():
            self._store(slot, ids)

    @staticmethod
    def _frame(rows: list[dict]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame(rows)

    # -- callbacks --------------------------------------------------------

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        session = self._load()
        now = timerValues.getCurrentProcessingTimeInMs() // 1000
        last, swept = self.counter.get() if self.counter.exists() else (0, None)
        out: list[dict] = []
        slots: dict[int, dict] = {}
        changed: set[int] = set()
        if self.by_arrival:
            # Sorting needs the key's rows of one micro-batch, whose size the source
            # bounds; only the four narrow columns in use are held.
            batch = pd.concat([frame[EVENT_COLUMNS] for frame in rows])
            frames = iter([batch.sort_values(["arrival", "event_id"], kind="stable")])
        else:
            # A micro-batch is one tick of the clock: what is due closes before it.
            session = self._settle(key, session, now, out, slots, changed)
            frames = rows
        for frame in frames:
            for event in frame.itertuples(index=False):
                if self.by_arrival:
                    now = int(event.arrival)
                    session = self._settle(key, session, now, out, slots, changed)
                ids = self._ids(slots, event.event_id)
                member = ids.get(event.event_id)
                elsewhere = member is not None and (session is None or member[0] != session["number"])
                if elsewhere and member[1] >= now - self.keep:
                    continue
                if session is None:
                    last += 1
                session = self._add(session, last, event, now)
                ids[event.event_id] = (session["number"], now)
                changed.add(self._slot(event.event_id))
        for slot in changed:
            self._store(slot, slots[slot])
        if swept is None or now >= swept + self.keep:
            self._sweep(now, session["number"] if session else None)
            swept = now
        self.counter.update((last, swept))
        self._save(session)
        yield from self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out: list[dict] = []
        now = expiredTimerInfo.getExpiryTimeInMs() // 1000
        slots: dict[int, dict] = {}
        changed: set[int] = set()
        self._save(self._settle(key, self._load(), now, out, slots, changed))
        for slot in changed:
            self._store(slot, slots[slot])
        yield from self._frame(out)

    def close(self) -> None:
        pass


def archive_sessions_stream(
    events: DataFrame,
    trail: int = S.TRAIL,
    delay: int = S.COPY_DELAY,
    timeout: int = S.END_TIMEOUT,
    clock: str = "processing",
    lateness: str = "10 seconds",
    keep: int = KEEP_IDS,
) -> DataFrame:
    """Closed and cancelled sessions of a stream of archive events.

    ``clock="processing"`` acts at the time a message is processed, as a live
    service does.  ``clock="arrival"`` acts at the arrival times of the messages,
    with their watermark as the clock, so that a replay of old messages gives
    the sessions the live run gave.

    The watermark only moves the clock.  The grouped rows do not carry its column,
    so a message that arrives late is not filtered: it joins the open session, or
    opens one that the next timer closes.
    """
    by_arrival = clock == "arrival"
    columns = ["camera", "detection_type", "event_id", "start_ms", "end_ms", "arrival"]
    rows = events.select(*columns, "arrived_at")
    rows = (rows.withWatermark("arrived_at", lateness) if by_arrival else rows).drop("arrived_at")
    return rows.groupBy(*S.GROUP).transformWithStateInPandas(
        SessionProcessor(trail, delay, timeout, by_arrival, keep),
        OUTPUT_DDL,
        "append",
        "EventTime" if by_arrival else "ProcessingTime",
    )


def with_archive_base(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn(
        "archive_base",
        S.archive_base(F.col("detection_type"), F.col("camera"), F.col("start_ms")),
    )
