"""Keyed state for streams: digests of open minutes, the metrics registry, and heartbeats by the clock.

State is held per key in Spark's state store and cleared by event-time timers. Time is counted in whole windows: a row's
event time is the end of its window (``CLOSES``), so a row is late exactly when its window has been reported, whatever its place in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulsemill.functions.time import bin_start, epoch_ms
from pulsemill.model import ACCURACY, HEARTBEAT_NAME, MAX_CENTROIDS
from pulsemill.operators.counters import SERIES, beat_sets, report_name, signed_count, with_series
from pulsemill.operators.digest import DIGEST, PARTIAL_ACCURACY, PARTIAL_CENTROIDS, cluster, partial_digests
from pulsemill.operators.validate import not_finite

CLOSES = "closes"
MINUTE_MS, DAY_MS = 60_000, 86_400_000
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """State processors need the state store on disk. A query keeps the setting that it was started with."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def with_closing(rows: DataFrame, start_ms: str, width_ms: int, delay: str) -> DataFrame:
    """``rows`` with a watermark on the end of their window. The newest window ends up to ``width_ms`` after the newest row, which
    the delay makes good."""
    closing = F.timestamp_millis(F.col(start_ms) + width_ms)
    return rows.withColumn(CLOSES, closing).withWatermark(CLOSES, f"{delay} {width_ms} milliseconds")


# Digests of open minutes.

_ROW = np.dtype([("minute_ms", "<i8"), ("mean", "<f8"), ("weight", "<i8"), ("lo", "<f8"), ("hi", "<f8")])


def _compressed(rows: np.ndarray, max_centroids: int, accuracy: float) -> np.ndarray:
    first, *columns = cluster(*(np.ascontiguousarray(rows[c]) for c in _ROW.names), max_centroids, accuracy)
    out = np.empty(len(first), _ROW)
    for name, column in zip(_ROW.names, [rows["minute_ms"][first], *columns]):
        out[name] = column
    return out


def _hold_minutes(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The state of a series and day is the digests of its open minutes: some hundred rows each, however many values they stand for."""
    held = np.frombuffer(state.get[0], _ROW) if state.exists else np.empty(0, _ROW)
    if state.hasTimedOut:
        closed = held["minute_ms"] + MINUTE_MS <= state.getCurrentWatermarkMs()
        done, held = held[closed], held[~closed]
        if len(done):
            yield pd.DataFrame(_compressed(done, MAX_CENTROIDS, ACCURACY)).assign(series=key[0])[["series", *_ROW.names]]
    else:
        for frame in frames:
            added = np.empty(len(frame), _ROW)
            for name in _ROW.names:
                added[name] = frame[name]
            held = _compressed(np.concatenate([held, added]), PARTIAL_CENTROIDS, PARTIAL_ACCURACY)
    if len(held):
        state.update((held.tobytes(),))
        state.setTimeoutTimestamp(int(held["minute_ms"].min()) + MINUTE_MS - 1)
    else:
        state.remove()


def closed_digests(samples: DataFrame, time: str, delay: str) -> DataFrame:
    """The final digest of each closed minute. Tasks cluster their rows before the shuffle, and the state merges these digests."""
    minute = bin_start(epoch_ms(F.col(time))).alias("minute_ms")
    values = samples.filter(~not_finite(F.col("value"))).select("series", minute, F.col("value").cast("double").alias("mean"))
    parts = with_closing(partial_digests(values, ["series", "minute_ms"]).drop("_task"), "minute_ms", MINUTE_MS, delay)
    return parts.withColumn("day_ms", bin_start(F.col("minute_ms"), DAY_MS)).groupBy("series", "day_ms").applyInPandasWithState(
        _hold_minutes, "series string, minute_ms long, mean double, weight long, lo double, hi double", "rows binary", "append",
        GroupStateTimeout.EventTimeTimeout).select("series", "minute_ms", *DIGEST)


# The registry.

_OPEN = np.dtype([("ts_ms", "<i8"), ("id", "<i8"), ("cleared", "?"), ("change", "<i8"), ("value", "<f8")])


def _ends(rows: np.ndarray, width: int) -> np.ndarray:
    return rows["ts_ms"] // width * width + width


def _summed(rows: np.ndarray, kind: str, width: int) -> np.ndarray:
    """What a series has to remember of ``rows``, in order: a counter one entry for each millisecond, others one for each interval, which
    for a gauge is its last row."""
    rows = rows[np.lexsort((rows["id"], rows["ts_ms"]))]
    at = rows["ts_ms"] if kind == "counter" else _ends(rows, width)
    last = np.flatnonzero(np.append(at[1:] != at[:-1], np.ones(min(1, len(at)), bool)))
    out = rows[last]
    if kind != "gauge" and len(out):
        first = np.append(0, last[:-1] + 1)
        out["change"], out["cleared"] = np.add.reduceat(rows["change"], first), np.logical_or.reduceat(rows["cleared"], first)
    return out


def _reported(rows: np.ndarray, kind: str, total: int, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(ends, values, total at the end) of the intervals of ``rows``, all of one series and as ``_summed`` left them; intervals without a report are left out.

    A clear sets a counter to zero before the other changes of its millisecond.
    """
    ends = _ends(rows, width)
    last = np.flatnonzero(np.append(ends[1:] != ends[:-1], True))
    if kind == "gauge":
        values = rows["value"][last]
        shown = ~np.isnan(values)
    elif kind == "counter":
        upto = np.cumsum(rows["change"])
        clear = np.maximum.accumulate(np.where(rows["cleared"], np.arange(len(rows)), -1))
        totals = np.where(clear < 0, total + upto, upto - (upto - rows["change"])[clear])
        values, shown, total = totals[last].astype(float), np.ones(len(last), bool), int(totals[-1])
    else:
        values = rows["change"][last].astype(float)
        shown = values > 0
    return ends[last][shown], values[shown], total


def _hold_series(width: int, idle: int | None):
    """The state of a series: a counter's total and the last reported interval, and the entries of open intervals in one value.

    Each interval in which the series changed is reported once, when it closes; all that close at a time are reported together, so a call reads
    and writes the state once however many there are. After ``idle`` milliseconds without a change the series is forgotten, and a counter
    starts from zero again.
    """
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total, last_end, held = state.get if state.exists else (0, None, b"")
        held, kind, now = np.frombuffer(held, _OPEN), key[0], state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            for frame in frames:
                added = np.empty(len(frame), _OPEN)
                for name in _OPEN.names:
                    added[name] = frame[name]
                held = _summed(np.concatenate([held, added]), kind, width)
        closed = _ends(held, width) <= now
        due, held = held[closed], held[~closed]
        if len(due):
            ends, values, total = _reported(due, kind, total, width)
            last_end = int(_ends(due[-1:], width)[0])
            if len(ends):
                yield pd.DataFrame({"report_ms": ends}).assign(kind=kind, name=key[1], source=key[2], series_tags=key[3], value=values)
        forgotten = last_end is None or (idle is not None and last_end + idle <= now)
        if not len(held) and forgotten:
            state.remove()
            return
        state.update((total, last_end, held.tobytes()))
        if len(held):
            state.setTimeoutTimestamp(int(_ends(held, width).min()) - 1)
        elif idle is not None:
            state.setTimeoutTimestamp(last_end + idle - 1)

    return run


def registry_reports(
    observations: DataFrame, prefix: str = "", time: str = "event_time", delay: str = "10 minutes", width_ms: int = 60_000, idle_ms: int | None = None
) -> DataFrame:
    """(report_ms, kind, name, source, series_tags, value) of every series that changed in a closed interval: gauges their last value, counters
    their total since the last clear, delta counters their change if it is positive. A row without a time belongs to no interval."""
    rows = with_series(observations.withColumn("ts_ms", epoch_ms(F.col(time)))).filter("ts_ms IS NOT NULL").select(
        "kind", *SERIES, "ts_ms", "id", F.coalesce(F.col("op") == "clear", F.lit(False)).alias("cleared"), F.coalesce(signed_count(), F.lit(0)).alias("change"),
        F.col("value").cast("double").alias("value"), bin_start(F.col("ts_ms"), width_ms).alias("_start"))
    reports = with_closing(rows, "_start", width_ms, delay).drop("_start").groupBy("kind", *SERIES).applyInPandasWithState(
        _hold_series(width_ms, idle_ms), "report_ms long, kind string, name string, source string, series_tags string, value double",
        "total long, last_end long, entries binary", "append", GroupStateTimeout.EventTimeTimeout)
    return reports.select("report_ms", "kind", report_name(prefix).alias("name"), "source", "series_tags", "value")


# Heartbeats.

class HeartbeatProcessor(StatefulProcessor):
    """State of a tag set: the cycles in which it was seen and that are still open, and the last one that beat.

    A component that has been seen beats at the end of every cycle by the clock, up to ``idle_cycles`` cycles after it was seen last;
    a reported tag set beats in the cycles of its reports.
    """

    def __init__(self, width_ms: int, idle_cycles: int):
        self.width, self.idle_cycles = width_ms, idle_cycles

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "open array<long>, last_seen long, next_cycle long")

    def _get(self) -> tuple[list[int], int | None, int | None]:
        if not self.seen.exists():
            return [], None, None
        opened, last, following = self.seen.get()
        return list(opened), last, following

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        opened, last, following = self._get()
        found = set(opened)
        for frame in rows:
            found.update(int(w) for w in frame["window_ms"].unique())
        first = min(found)
        self.seen.update((sorted(found), last, first if following is None else min(first, following)))
        self.handle.registerTimer(first + self.width)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        opened, last, cycle = self._get()
        if cycle is None:
            return
        now, idle, beats = timerValues.getCurrentWatermarkInMs(), self.idle_cycles if key[1] == "component" else 0, []
        while cycle is not None and cycle + self.width <= now:
            if opened and opened[0] <= cycle:
                last, opened = cycle, opened[1:]
                beats.append(cycle)
            elif last is not None and cycle <= last + idle * self.width:
                beats.append(cycle)
            following = cycle + self.width
            if last is None or following > last + idle * self.width:
                following = opened[0] if opened else None
            cycle = following
        if cycle is None:
            self.seen.clear()
        else:
            self.seen.update((opened, last, cycle))
            self.handle.registerTimer(cycle + self.width)
        if beats:
            yield pd.DataFrame({"window_ms": beats}).assign(source=key[0], kind=key[1], canonical=key[2])[["window_ms", "source", "kind", "canonical"]]

    def close(self) -> None:
        pass


def clocked_heartbeats(beats: DataFrame, idle_cycles: int = 0, time: str = "event_time", delay: str = "10 minutes", width_ms: int = 300_000) -> DataFrame:
    """One beat of 1.0 per closed cycle, source and tag set, also of idle components. Start it inside ``rocks_state``."""
    sets = beat_sets(beats).select(bin_start(epoch_ms(F.col(time)), width_ms).alias("window_ms"), "source", "kind", "canonical")
    found = with_closing(sets, "window_ms", width_ms, delay).groupBy("source", "kind", "canonical").transformWithStateInPandas(
        HeartbeatProcessor(width_ms, idle_cycles), "window_ms long, source string, kind string, canonical string", "Append", "EventTime")
    return found.select(F.lit(HEARTBEAT_NAME).alias("name"), F.lit(1.0).alias("value"), "window_ms", "source", "kind", "canonical")
