"""Keys to ask the carriers about, as a stream: state of each shipment, a timer for each block of them.

What the batch ``tracking_worklist`` finds by going through all lines and shipments, the
stream knows from the few days and the last status that it holds of a shipment. On every
poll day a timer comes due and says which shipments to ask for; a shipment that is
neither recent nor under way leaves the state. Timers follow the watermark, so late and
repeated events count up to the allowed delay.

Shipments lie in blocks by the hash of their key, and a call sees a block, since a call per
shipment costs a hundred times what it does.

At scale the state belongs in RocksDB (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from parcelworks.functions.text import blank_to_null, strip_backticks
from parcelworks.operators.carriers import ACTIVE

WINDOW_DAYS = 30
_DAY_MS = 86_400_000
_EPOCH = dt.date(1970, 1, 1)
_STATE = "keys array<string>, polls array<int>, days array<array<int>>, times array<array<bigint>>, statuses array<array<string>>"
_DUE = "awb_no string, poll_day date"


def line_events(lines: DataFrame) -> DataFrame:
    """Sales lines (``tracking_number``, ``order_date``) as events; lines without a number are none."""
    awb = blank_to_null(strip_backticks(F.col("tracking_number")))
    return lines.select(
        awb.alias("awb_no"), F.col("order_date").cast("timestamp").alias("time"), F.lit(None).cast("string").alias("mapped_status")
    ).where("awb_no is not null and time is not null")


def status_events(updates: DataFrame, time: str) -> DataFrame:
    """Shipment rows (``awb_no``, ``mapped_status``) with the time they became known as events."""
    awb = blank_to_null(F.col("awb_no").cast("string"))
    return updates.select(
        awb.alias("awb_no"), F.col(time).cast("timestamp").alias("time"), F.coalesce("mapped_status", F.lit("")).alias("mapped_status")
    ).where("awb_no is not null and time is not null")


def _days(day: dt.date) -> int:
    return (day - _EPOCH).days


class _Shipment:
    """What is known of one shipment that a poll still to come may need."""

    def __init__(self, poll: int, days: list[int], times: list[int], statuses: list[str]) -> None:
        self.poll = poll
        self.days = set(days)
        self.statuses = set(zip(times, statuses, strict=True))

    def _before(self) -> tuple[int, str] | None:
        """The last status known on the poll day; of several at one time an open one counts."""
        known = [s for s in self.statuses if s[0] < self.poll * _DAY_MS]
        return max(known, key=lambda s: (s[0], s[1] == ACTIVE, s[1]), default=None)

    def due(self) -> bool:
        recent = any(self.poll - WINDOW_DAYS <= d < self.poll for d in self.days)
        last = self._before()
        return recent or (last is not None and last[1] == ACTIVE)

    def forget(self) -> bool:
        """Drop what the next poll can't need; tells whether anything is left."""
        self.days = {d for d in self.days if d >= self.poll - WINDOW_DAYS}
        last = self._before()
        later = {s for s in self.statuses if s[0] >= self.poll * _DAY_MS}
        self.statuses = later | ({last} if last is not None else set())
        return bool(self.days or later or (last is not None and last[1] == ACTIVE))

    def stored(self) -> tuple:
        pairs = sorted(self.statuses)
        return (self.poll, sorted(self.days), [t for t, _ in pairs], [s for _, s in pairs])


def due_keys(events: DataFrame, polls: list[dt.date], delay: str = "2 days", blocks: int = 2048) -> DataFrame:
    """``awb_no`` and ``poll_day`` of every key to ask for, on each of the ``polls`` in turn.

    On a poll day that is a key with a line of the 30 days before it, or whose last status
    before it is active: what ``tracking_worklist`` gives for the data known on that day. A
    key is emitted once the watermark (latest event less ``delay``) has reached the day.
    A task holds the shipments of one of the ``blocks`` at a time; their number stays the same
    as long as the stream's checkpoint does.
    """
    days = sorted({_days(p) for p in polls})
    if not days:
        raise ValueError("no poll days")

    def after(ms: int) -> int | None:
        return next((d for d in days if d * _DAY_MS > ms), None)

    def step(key: tuple[int], rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        first = after(watermark)
        shipments: dict[str, _Shipment] = {}
        if state.exists:
            shipments = {awb: _Shipment(*held) for awb, *held in zip(*state.get, strict=True)}
        touched = set()
        for part in rows:
            for awb, ms, status in zip(part["awb_no"].tolist(), part["ms"].tolist(), part["mapped_status"].tolist(), strict=True):
                if awb not in shipments:
                    if first is None:
                        continue
                    shipments[awb] = _Shipment(first, [], [], [])
                touched.add(awb)
                if status is None:
                    shipments[awb].days.add(ms // _DAY_MS)
                else:
                    shipments[awb].statuses.add((ms, status))
        due: list[tuple[str, dt.date]] = []
        for awb, shipment in list(shipments.items()):
            if awb not in touched and shipment.poll * _DAY_MS > watermark:
                continue
            alive = shipment.forget()
            while alive and shipment.poll * _DAY_MS <= watermark:
                if shipment.due():
                    due.append((awb, _EPOCH + dt.timedelta(days=shipment.poll)))
                following = after(shipment.poll * _DAY_MS)
                if following is None:
                    alive = False
                else:
                    shipment.poll = following
                    alive = shipment.forget()
            if not alive:
                del shipments[awb]
        if shipments:
            state.update((list(shipments), *[list(c) for c in zip(*[s.stored() for s in shipments.values()], strict=True)]))
            state.setTimeoutTimestamp(min(s.poll for s in shipments.values()) * _DAY_MS)
        elif state.exists:
            state.remove()
        if due:
            yield pd.DataFrame(due, columns=["awb_no", "poll_day"])

    timed = events.withWatermark("time", delay).withColumn("ms", F.unix_millis("time"))
    dealt = timed.withColumn("block", F.pmod(F.xxhash64("awb_no"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandasWithState(step, _DUE, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
