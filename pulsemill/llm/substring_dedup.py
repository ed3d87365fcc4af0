"""Removal of word windows that occur elsewhere, by level-wise doubling.

A level has a window length: about 18 words at first, then twice as many until the wanted length is reached. Only what is
repeated at one level is extended to the next. Below the wanted length a level looks at the window of least hash within each
candidate (winnowing): equal candidates choose equal windows, so a repeated candidate always survives, and about one
place in ten is looked at. At the wanted length every surviving candidate is compared, and the words of those that
occur at any two places are removed. All comparisons are of 64-bit hashes of the word sequences.

Windows are judged on the input: all occurrences go, the first one too. A row is known by a hash of its id and text; rows
with the same id and text see each other as other places. Null, empty and short texts have no windows and keep their
words. An empty table gives no rows; other columns are not read. Very long texts are handled whole, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.llm import arrowtext

WINDOW = 35
BASE = 18


def lengths(window: int, base: int = BASE) -> list[int]:
    """Window lengths of the levels, each at most twice the one before."""
    out = [window]
    while out[0] > base:
        out.insert(0, -(-out[0] // 2))
    return out


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` neighbours, the first among equals."""
    place, span = np.arange(len(hashes)), 1
    while span < width:
        step = min(span, width - span)
        left, right = place[:-step], place[step:]
        place = np.where(hashes[right] < hashes[left], right, left)
        span += step
    return place


def _ranges(candidates: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last index) of the runs of neighbouring candidates that share a place."""
    new = np.flatnonzero((np.diff(candidates) != 1) | (np.diff(place) != 0)) + 1
    return np.concatenate([[0], new]), np.concatenate([new - 1, [len(candidates) - 1]])


def _level(length: int, window: int):
    """Per row of (row, id, text, [lo, n pairs]): hashes of one level, each with the ``n`` candidates from ``lo`` on that it stands for.

    ``known``: the hash occurs twice in this batch already. Only the first row of a hash then keeps it as its ``key``;
    the others get one of their own, as they need no further comparison.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.concatenate(c) for c in zip(*parts(batch))]
            if found:
                _, at, inverse, count = np.unique(found[0], return_index=True, return_inverse=True, return_counts=True)
                key, row, lo, n = found
                later = np.ones(len(key), bool)
                later[at] = False
                with np.errstate(over="ignore"):
                    own = arrowtext.mix(row.view(np.uint64) * np.uint64(3) + lo.astype(np.uint64)).view(np.int64)
                columns = [np.where(later, own, key), row, lo, n, count[inverse] > 1]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["key", "row", "lo", "n", "known"])

    def parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        spans = batch.column(3) if batch.num_columns > 3 else None
        for row, data, offsets in arrowtext.blocks(batch.column(2)):
            starts, ends, first = arrowtext.words(data, offsets)
            n = len(starts)
            if n < window:
                continue
            hashes = arrowtext.word_hashes(data, starts, ends)
            own = arrowtext.owners(first)
            at = np.arange(n - length + 1)
            hashes = arrowtext.run_hashes(hashes, at, at + length)
            place = _least(hashes, window - length + 1)
            wanted = np.zeros(n - window + 1, bool)
            if spans is None:
                wanted[:] = True
            else:
                part = spans.slice(row, len(offsets) - 1)
                pairs = part.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2).astype(np.int64)
                count = np.diff(part.offsets.to_numpy())
                base = np.repeat(first[:-1], count // 2)
                mark = np.zeros(n + 1, np.int32)
                np.add.at(mark, pairs[:, 0] + base, 1)
                np.add.at(mark, pairs[:, 0] + pairs[:, 1] + base, -1)
                wanted = np.cumsum(mark)[: len(wanted)] > 0
            wanted &= own[: len(wanted)] == own[window - 1 :]
            candidates = np.flatnonzero(wanted)
            if not len(candidates):
                continue
            a, b = _ranges(candidates + 2 * own[candidates], place[candidates])
            low, high, owner = candidates[a], candidates[b], own[candidates[a]]
            yield hashes[place[low]].view(np.int64), ids[row + owner], (low - first[owner]).astype(np.int32), (high - low + 1).astype(np.int32)

    return run


def _repeated(found: DataFrame, last: bool) -> DataFrame:
    """Rows of ``found`` whose hash occurs at two places or more, as (row, spans) with all (lo, n) pairs of a row's text.

    On the last level every ``n`` is one, and ``spans`` holds the ``lo`` alone.

    Of each hash a batch has dealt one row by the hash itself, so however common a hash is, it has no more rows in one task
    than there are batches.
    """
    counted = found.withColumn("places", F.count("*").over(Window.partitionBy("key"))).where("known OR places > 1")
    spans = F.collect_list("lo") if last else F.flatten(F.collect_list(F.array("lo", "n")))
    return counted.groupBy("row").agg(spans.alias("spans"))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(row, spans): the first words of the repeated windows of each text, in one row."""
    source = _source(docs, id_col, text_col)  # with the id, so that all joins share one shuffle of the texts
    state = None
    for length in lengths(window):
        texts = source if state is None else source.join(state, "row")
        state = _repeated(texts.mapInArrow(_level(length, window), "key long, row long, lo int, n int, known boolean"), length == window)
    return state


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.xxhash64(F.col(id_col), text).alias("row"), F.col(id_col).alias("id"), text.alias("text"))


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, texts: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept, kept_sha256): what is left of each text, its words joined by one space.

    ``texts=False`` leaves out the kept text itself.
    """
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    fields += [T.StructField("kept", T.StringType())] * texts + [T.StructField("kept_sha256", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in arrowtext.blocks(batch.column(2)):
                starts, ends, first = arrowtext.words(data, offsets)
                part = batch.column(3).slice(row, len(offsets) - 1)
                n_removed, kept = [], []
                for i, spans in enumerate(part):
                    a, b = first[i], first[i + 1]
                    size = int(b - a)
                    gone = np.zeros(size + 1, np.int32)
                    if spans.is_valid:
                        at = spans.values.to_numpy(zero_copy_only=False)
                        np.add.at(gone, at, 1)
                        np.add.at(gone, at + window, -1)
                    left = np.cumsum(gone)[:size] == 0
                    n_removed.append(size - int(left.sum()))
                    text = data[offsets[i] : offsets[i + 1]].tobytes()
                    if spans.is_valid:
                        text = b" ".join([text[s:e] for s, e in zip((starts[a:b][left] - offsets[i]).tolist(), (ends[a:b][left] - offsets[i]).tolist())])
                    else:
                        text = b" ".join(text.split())  # bytes split at exactly the six separators
                    kept.append(text)
                columns = [batch.column(1).slice(row, len(kept)), pa.array(np.diff(first)), pa.array(n_removed, pa.int64())]
                columns += [pa.array([k.decode() for k in kept], pa.string())] * texts + [pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    marks = repeated_windows(docs, id_col, text_col, window)
    return _source(docs, id_col, text_col).join(marks, "row", "left").mapInArrow(run, T.StructType(fields))
