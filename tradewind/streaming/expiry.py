"""Keyed state that ends: the newest event of each tracked entity, kept until its timer fires.

An entity's timer is set anew by each newer event: soon after a status that ends it, late after any
other.  When the watermark passes the timer, the state is removed and a last row says so.  State is
thus bounded by the entities that are alive, however many there ever were.

Events that arrive after the watermark are dropped by Spark, whoever they belong to.  Events of an entity
that are older than its newest one but not that late change nothing.  An entity that
reports again after its end starts anew.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tradewind.operators.dedup import require_key
from tradewind.streaming.state import MOMENT, describe

_FIELDS = ["micros", "event_id", "latitude", "longitude", "temperature", "speed", "status"]
_STATE = "micros bigint, event_id string, latitude double, longitude double, temperature double, speed double, status string"
_HELD_KEYS = 100_000


@dataclass(frozen=True)
class Timers:
    """How long state outlives its newest event, in seconds, and how late events may come."""

    after_end: int = 24 * 3600
    idle: int = 30 * 24 * 3600
    lateness: int = 3600
    ending: tuple[str, ...] = ("DELIVERED",)


def _order(row: tuple) -> tuple:
    return row[0], row[1] or ""


def _plain(row: tuple) -> tuple:
    """Python values; pandas marks what is missing as NaN."""
    return tuple(None if pd.isna(x) else x.item() if hasattr(x, "item") else x for x in row)


def _newest_of_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The newest row of each key that a task meets, so that a hot entity sends a row a task, not one an event."""
    held: pd.DataFrame | None = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch])
        held = held.sort_values(["micros", "event_id"], kind="stable").drop_duplicates("shipment_id", keep="last")
        if len(held) > _HELD_KEYS:
            yield held
            held = None
    if held is not None:
        yield held


def expiring_state_updates(tracking: DataFrame, timers: Timers = Timers()) -> DataFrame:
    """A row for each entity that changed or ended, for update mode; ``ended`` tells which.

    The fields are those of ``entity_state``.  Events without an id or a readable time are left out.
    """
    timed = require_key(tracking, "shipment_id").withColumn(MOMENT, F.try_to_timestamp(F.col(MOMENT))).filter(F.col(MOMENT).isNotNull())
    events = timed.select(
        "shipment_id",
        F.unix_micros(MOMENT).alias("micros"),
        "event_id",
        *(F.col(c).cast("double").alias(c) for c in ("latitude", "longitude", "temperature", "speed")),
        "status",
    )
    newest = events.mapInPandas(_newest_of_task, events.schema)
    marked = newest.withColumn("moment", F.timestamp_micros("micros")).withWatermark("moment", f"{timers.lateness} seconds")

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            row, ended = state.get, True
            state.remove()
        else:
            known = [state.get] if state.exists else []
            for batch in batches:
                known += [_plain(r) for r in batch[_FIELDS].itertuples(index=False, name=None)]
                known = [max(known, key=_order)]
            row, ended = known[0], False
            wait = timers.after_end if row[-1] in timers.ending else timers.idle
            state.update(row)
            # A timer has to lie ahead of the watermark: what is due fires with the next batch.
            state.setTimeoutTimestamp(max(row[0] // 1000 + 1000 * wait, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], *row, ended)], columns=["shipment_id", *_FIELDS, "ended"])

    changed = marked.groupBy("shipment_id").applyInPandasWithState(
        step, f"shipment_id string, {_STATE}, ended boolean", _STATE, "update", GroupStateTimeout.EventTimeTimeout
    )
    restored = changed.withColumns({MOMENT: F.timestamp_micros("micros"), "speed": F.col("speed").cast("int")})
    return restored.select(*describe(), "ended")
