"""Whole texts of Arrow batches as byte blocks, with words and rolling hashes computed in numpy.

Everything here works inside one task on one batch; Spark deals out the batches. A block holds about ``BLOCK``
bytes, or one text if that is longer, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

BLOCK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; row ``first + i`` is ``bytes[offsets[i]:offsets[i + 1]]``."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


#: What a worker keeps from task to task, by name: one object, as a worker that goes on with another operator has no use for the last one's.
held: dict[object, object] = {}


def keep(name: object, build: Callable[[], object]) -> object:
    if name not in held:
        held.clear()
        held[name] = build()
    return held[name]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Fewer texts at a time between Spark and Python, for passes that are written while this holds; the session's setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def words(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each row) of the maximal runs of bytes other than ``outside``: space and \\t \\n \\v \\f \\r.

    The third array has one entry more than there are rows.
    """
    inside = ~outside[data]
    before = np.empty(len(inside), bool)
    before[:1] = True
    np.logical_not(inside[:-1], out=before[1:])
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    before[edges] = True  # a text ends a word even if the next text goes on without white space
    starts = np.flatnonzero(inside & before)
    after = np.empty(len(inside), bool)
    after[-1:] = True
    np.logical_not(inside[1:], out=after[:-1])
    cut = edges[edges > 0]
    after[cut - 1] = True
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i up to n."""
    global _powers, _inverse
    if len(_powers) <= n:
        size = max(n + 1, 2 * len(_powers))
        back = np.uint64(pow(int(BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _powers = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size, BASE))])
            _inverse = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size, back))])
    return _powers, _inverse


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run ``values[start:end]``; equal runs have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(values) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes."""
    return run_hashes(data, starts, ends)


def owners(first: np.ndarray) -> np.ndarray:
    """Row of each word, from the first word of each row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def compact(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) with A-Z in lower case and the words of each text followed by one space each."""
    starts, ends, _ = words(data, offsets)
    if not len(starts):
        return data[:0], np.zeros_like(offsets)
    length = ends - starts
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(length + 1, out=places[1:])
    inside = ~_SPACE[data]
    out = np.full(places[-1], 32, np.uint8)
    kept = np.ones(places[-1], bool)
    kept[places[1:] - 1] = False
    out[kept] = _LOWER[data[inside]] if lower else data[inside]
    return out, places[np.searchsorted(starts, offsets)]
