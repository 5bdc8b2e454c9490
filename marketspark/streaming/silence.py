"""Silence alerts: a symbol that stops is reported when event time passes, not when it comes back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marketspark.functions.timecols import from_micros, micros

_HOUR_US = 3_600_000_000
_ALERT = "symbol string, kind string, gap_start long, gap_end long, hours double"


class SilenceWatch(StatefulProcessor):
    """State of a symbol: its last settled tick, and the first and last tick of the time slots the watermark has not passed.

    A slot is as long as the limit, so a silence always crosses slots and a slot needs no more than two times. Slots settle in
    order once the watermark passes their end; whatever order ticks arrive in before, the alerts are the same. One timer per
    symbol stands at the next slot end or at the end of the limit after the last tick. All of it is one value, read and written
    once a call, since every call to the state store is a trip to another process.
    """

    def __init__(self, limit_us: int):
        self.limit = limit_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.watch = handle.getValueState("watch", "us long, told boolean, timer long, times array<long>")

    def _known(self) -> tuple[int | None, bool, int | None, dict[int, tuple[int, int]]]:
        last, told, timer, times = self.watch.get() or (None, False, None, [])
        times = [int(t) for t in times]  # slot, first, last and so on
        return last, told, timer, {times[i]: (times[i + 1], times[i + 2]) for i in range(0, len(times), 3)}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, told, timer, pending = self._known()
        for chunk in rows:
            for slot, first, end in zip(chunk["slot"].tolist(), chunk["first_us"].tolist(), chunk["last_us"].tolist()):
                a, b = pending.get(slot, (first, end))
                pending[slot] = min(a, first), max(b, end)
        yield self._advance(key[0], timerValues, last, told, timer, pending)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._advance(key[0], timerValues, *self._known())

    def _advance(self, symbol: str, times, last, told, timer, pending) -> pd.DataFrame:
        mark = times.getCurrentWatermarkInMs()
        now = mark * 1000
        slots = sorted((slot, *v) for slot, v in pending.items())
        out = []
        for _, first, end in [s for s in slots if (s[0] + 1) * self.limit <= now]:
            if last is not None and first - last > self.limit:
                if not told:
                    out.append((symbol, "silent", last, None, None))
                out.append((symbol, "returned", last, first, (first - last) / _HOUR_US))
            last, told = (end if last is None else max(last, end)), False
        waiting = [s for s in slots if (s[0] + 1) * self.limit > now]
        if last is not None and not told and last + self.limit <= now and (not waiting or waiting[0][1] - last > self.limit):
            out.append((symbol, "silent", last, None, None))
            told = True
        due = [(waiting[0][0] + 1) * self.limit] if waiting else []
        due += [last + self.limit] if last is not None and not told else []
        wanted = max(-(-min(due) // 1000), mark + 1) if due else None
        if wanted != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        self.watch.update((last, told, wanted, [t for slot in waiting for t in slot]))
        return pd.DataFrame(out, columns=["symbol", "kind", "gap_start", "gap_end", "hours"]).astype(
            {"gap_start": "Int64", "gap_end": "Int64", "hours": "float64"})

    def close(self) -> None:
        pass


def silence_alerts(ticks: DataFrame, *, limit_hours: float = 1.0, watermark: str = "2 hours") -> DataFrame:
    """A stream of (symbol, kind, gap_start, gap_end, hours) from a stream of (symbol, timestamp, ...).

    Kind ``silent`` comes as soon as the watermark is ``limit_hours`` past a symbol's last tick (no gap end), kind ``returned`` once
    the tick that ends the silence has settled. Ticks without symbol or time are ignored; late ones are dropped. Ticks are
    reduced to first and last per slot where they are read, so a symbol with a third of all ticks sends its slots, not its ticks.
    """
    limit = int(limit_hours * _HOUR_US)

    def reduce(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            slots = chunk.assign(slot=chunk["us"] // limit).groupby(["symbol", "slot"])["us"]
            yield slots.agg(first_us="min", last_us="max").reset_index()

    slim = ticks.select("symbol", micros(F.col("timestamp")).alias("us")).where("symbol IS NOT NULL AND us IS NOT NULL")
    slots = slim.mapInPandas(reduce, "symbol string, slot long, first_us long, last_us long").withColumn(
        "timestamp", F.timestamp_micros("last_us"))
    alerts = slots.withWatermark("timestamp", watermark).groupBy("symbol").transformWithStateInPandas(
        SilenceWatch(limit), _ALERT, "Append", "EventTime")
    return alerts.select("symbol", "kind", from_micros(F.col("gap_start")).alias("gap_start"),
                         from_micros(F.col("gap_end")).alias("gap_end"), "hours")
