"""Text quality: hashed word n-gram logistic regression, trained by follow the regularised leader (proximal).

Features are hashed single words, word pairs, word shapes (letters, capitals and digits as classes, with runs cut short), and
one for triples of words that the text has had before; each view as frequencies within the text. Training takes a bounded sample of labelled rows, deals it to a few tasks that
run FTRL over their rows, and averages their weights. A score is the sparse dot product of weights and frequencies.

The sample is the ``MAX_TRAIN`` labelled rows of least id and text hash, without the held-out fold, repeated rows once. Null and empty texts have no features
and get the score of the intercept. Null labels are not learned from; without any label every score is 0.5. Repeated documents
are scored row by row; columns other than the ids, the text and the label are not read. Several labels of an id are averaged. A text with equal chances
of both labels gets the score 0.5. Very long texts are read whole, one by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.llm import arrowtext
from pulsemill.llm.sampling import least

BUCKETS = 1 << 18
MAX_TRAIN = 12_000
TRAINERS = 4
EPOCHS = 4
THRESHOLD = 0.3
# FTRL: step size, its offset, and the penalties on absolute and squared weights.
ALPHA, BETA, L1, L2 = 0.5, 0.05, 1e-4, 1e-4

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = ord("a"), ord("A"), ord("0"), ord("a")


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's classes, with equal neighbours counted once."""
    kind = _CLASS[data]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[starts] = True
    place = np.concatenate([[0], np.cumsum(new)])
    return arrowtext.run_hashes(kind[new], place[starts], place[ends])


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, weight, row) of every feature occurrence: four views, each with weights that sum to one in a row at most."""
    starts, ends, first = arrowtext.words(data, offsets)
    own = arrowtext.owners(first)
    shift = np.uint64(64 - 18)
    word = arrowtext.word_hashes(data, starts, ends)
    share = (1.0 / np.maximum(np.diff(first), 1))[own]
    with np.errstate(over="ignore"):
        pair = arrowtext.mix(word[:-1] * np.uint64(3) + word[1:])
    both = own[:-1] == own[1:]
    shape = arrowtext.mix(_shapes(data, starts, ends) + np.uint64(7)) if len(starts) else word
    bucket = np.concatenate([word >> shift, pair[both] >> shift, shape >> shift]).astype(np.int64)
    again = _seen_before(pair, own)
    bucket = np.concatenate([bucket, np.full(len(again), BUCKETS - 1)])
    return bucket, np.concatenate([share, share[:-1][both], share, share[again]]), np.concatenate([own, own[:-1][both], own, own[again]])


def _seen_before(pair: np.ndarray, own: np.ndarray) -> np.ndarray:
    """First words of the triples that an earlier place of the same text has too."""
    if len(own) < 3:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        triple = arrowtext.mix(pair[:-1] * np.uint64(5) + pair[1:] + own[:-2].astype(np.uint64) * arrowtext.BASE)
    inside = np.flatnonzero(own[:-2] == own[2:])
    order = inside[np.argsort(triple[inside], kind="stable")]
    return order[1:][triple[order[1:]] == triple[order[:-1]]]


def _learn(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """FTRL-proximal weights; the last entry is the intercept."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for index, value, label in rows:
            w = weights(index)
            gradient = (1 / (1 + np.exp(-np.clip(w @ value, -30, 30))) - label) * value
            square = gradient * gradient
            z[index] += gradient - (np.sqrt(n[index] + square) - np.sqrt(n[index])) / ALPHA * w
            n[index] += square
    return weights(np.arange(BUCKETS + 1))


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_train: int = MAX_TRAIN) -> np.ndarray:
    """Weights learned from at most ``max_train`` labelled rows that fulfil ``usable``, a condition on the id."""
    known = labels.where(usable & F.col(label_col).isNotNull()).select(F.col(id_col).alias("k"), F.col(label_col).cast("double").alias("y"))
    sample = least(known.groupBy("k").agg(F.avg("y").alias("y")), [F.xxhash64("k"), F.col("k")], max_train)
    texts = docs.select(F.col(id_col).alias("k"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    labelled = texts.join(F.broadcast(sample), "k").withColumn("h", F.xxhash64("t"))  # max_train ids at most
    # An id may stand on many rows: max_train of them at most are taken, repeated ones once.
    chosen = least(labelled.select("k", "h"), [F.xxhash64("k"), F.col("k"), F.col("h")], max_train).distinct()
    rows = labelled.join(F.broadcast(chosen), ["k", "h"]).dropDuplicates(["k", "h"]).withColumn("part", F.pmod(F.xxhash64("k", "h"), F.lit(TRAINERS)))
    dealt = rows.repartition(TRAINERS, "part").sortWithinPartitions(F.xxhash64("k", F.lit(1)), "t").select("t", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            target = batch.column(1).to_numpy()
            for row, data, offsets in arrowtext.blocks(batch.column(0)):
                bucket, weight, own = _features(data, offsets)
                order = np.argsort(own, kind="stable")
                bucket, weight, cut = bucket[order], weight[order], np.searchsorted(own[order], np.arange(len(offsets)))
                for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                    index, at = np.unique(bucket[a:b], return_inverse=True)
                    value = np.bincount(at, weight[a:b], len(index))
                    held.append((np.append(index, BUCKETS).astype(np.int32), np.append(value, 1.0).astype(np.float32), float(target[row + i])))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([_learn(held).astype("<f4").tobytes()]), pa.array([len(held)])], names=["w", "n"])

    learned = dealt.mapInArrow(run, "w binary, n long").collect()  # one row of fixed size from each of TRAINERS tasks
    if not learned:
        return np.zeros(BUCKETS + 1, np.float32)
    total = sum(r["n"] for r in learned)
    return sum(np.frombuffer(r["w"], "<f4") * np.float32(r["n"] / total) for r in sorted(learned, key=lambda r: (r["n"], bytes(r["w"]))))


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): probability of label 1 for every whole text."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for row, data, offsets in arrowtext.blocks(batch.column(1)):
                bucket, weight, own = _features(data, offsets)
                rows = len(offsets) - 1
                out[row : row + rows] = np.bincount(own, weights[bucket] * weight, rows)[:rows]
            out = 1 / (1 + np.exp(-np.clip(out + float(weights[BUCKETS]), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=[id_col, "score"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema)
