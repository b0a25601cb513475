"""State changes from a stream of polled states."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hearthstream.operators.states import STATE_FIELDS

VALUES = ["state", "last_changed", "last_updated"]
VALUES_DDL = "state string, last_changed string, last_updated string, polled_at bigint"
CHANGES_DDL = f"entity_id string, {VALUES_DDL}, old_state struct<{VALUES_DDL.replace(' string', ':string').replace(' bigint', ':bigint')}>"


# Entities are dealt out to this many groups.  A call of the processor costs far more than
# a row, so it serves a group and not one entity.  A checkpoint is bound to the number.
GROUPS = 4096


class ChangeProcessor(StatefulProcessor):
    """Remembers the last state of each entity of a group and reports what differs from it.

    Batches follow each other by arrival.  Inside a batch ``order`` decides: the time of
    the poll, then what the caller adds for equal times.  A poll that comes late
    is compared with the state known when it arrives, and becomes the known one.
    """

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "entity_id string", VALUES_DDL)

    @staticmethod
    def _polls(frame: pd.DataFrame, order: list[str]) -> Iterator[tuple]:
        """Entity and values of the rows in their order, what is missing as None."""
        narrow = frame.sort_values(order, kind="stable")[["entity_id", *VALUES, "polled_at"]]
        polls = narrow.astype(object).where(narrow.notna(), None)
        for entity_id, *texts, polled_at in polls.itertuples(index=False, name=None):
            yield entity_id, (*texts, int(polled_at))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for entity_id, values in dict(self._polls(initialState, ["polled_at"])).items():
            self.last.updateValue((entity_id,), values)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # The source bounds a micro-batch, and so the polls of a group in it.
        compared = [VALUES.index(c) for c in STATE_FIELDS]
        last: dict[str | None, tuple] = {}
        found = []
        for entity_id, now in self._polls(pd.concat(list(rows)), self.order):
            if entity_id in last:
                known = last[entity_id]
            else:
                known = self.last.getValue((entity_id,))
                known = known and tuple(known)
            if known is None or any(now[c] != known[c] for c in compared):
                found.append((entity_id, *now, known and dict(zip([*VALUES, "polled_at"], known, strict=True))))
            last[entity_id] = now
        for entity_id, values in last.items():
            self.last.updateValue((entity_id,), values)
        if found:
            yield pd.DataFrame(found, columns=["entity_id", *VALUES, "polled_at", "old_state"])

    def close(self) -> None:
        pass


def _grouped(states: DataFrame, columns: list[str]):
    group = F.pmod(F.xxhash64("entity_id"), F.lit(GROUPS)).cast("int")
    return states.select(*columns, group.alias("_group")).groupBy("_group")


def state_change_stream(
    states: DataFrame, order: list[str] | None = None, known: DataFrame | None = None
) -> DataFrame:
    """The changes in a stream of polled states, each with the entity's ``old_state``.

    The last state of an entity is a row of the state store; a batch touches only the
    entities it has polls of.  ``order`` are columns that order the polls of one batch, by
    default their time.  ``known`` (entity_id, state, last_changed, last_updated,
    polled_at) are states to start from.
    """
    columns = ["entity_id", *VALUES, "polled_at"]
    extra = [c for c in order or [] if c not in columns]
    return _grouped(states, [*columns, *extra]).transformWithStateInPandas(
        ChangeProcessor(order or ["polled_at"]), CHANGES_DDL, "append", "None",
        initialState=None if known is None else _grouped(known, columns),
    )
