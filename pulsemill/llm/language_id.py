"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A text is the average of the embeddings of its byte trigrams (A-Z in lower case, white space as one space) and words,
hashed into buckets. The product of embeddings and softmax weights is one small table, so a text is scored by averaging
table rows. A temperature fitted on held-back rows calibrates the probabilities, and a limit on them gives ``accepted``:
predictions below it are kept but marked as rejected.

Training takes the ``MAX_TRAIN`` rows of least hash of id and text that may be used and have a language, repeated ones once. A null text or one without a
letter gets ``und`` with score 0. Without training rows every text gets ``und``. Repeated rows are predicted row by row; columns
other than the id, the text and the language are not read, and an empty table gives no rows. Of equal probabilities the first language in order of
names is predicted. Very long texts are read whole, one by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.llm import arrowtext
from pulsemill.llm.sampling import least
from pulsemill.session import materialise

BITS = 15
SIZE = 16
MAX_TRAIN = 4000
#: Features of the training rows that the driver holds, eight bytes each.
MAX_VALUES = 8_000_000
EPOCHS = 3
STEP = 0.5
#: Accuracy on held-back rows that accepted predictions must reach.
ACCURACY = 0.995
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (languages, buckets + 1): the last bucket is empty
    bias: np.ndarray
    temperature: float
    limit: float


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(trigram bucket of every byte, offsets, word bucket, first word): both kinds in the order of the rows."""
    data, offsets = arrowtext.compact(data, offsets)
    starts, ends, first = arrowtext.words(data, offsets)
    wide = data.astype(np.uint32)
    code = np.full(len(data), 1 << BITS, np.int64)
    if len(data) > 2:
        mixed = (wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)
        code[:-2] = mixed >> np.uint32(32 - BITS)
    for back in (1, 2):  # trigrams that would reach into the next text
        cut = offsets[1:] - back
        code[cut[cut >= 0]] = 1 << BITS
    word = (arrowtext.word_hashes(data, starts, ends) >> np.uint64(64 - BITS)).astype(np.int64)
    return code, offsets, word, first


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum of the values of each row."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[cuts[1:]] - total[cuts[:-1]]


def _fit(rows: list[tuple[np.ndarray, np.ndarray, int]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embeddings, softmax weights, bias) by stochastic gradient descent with a falling step."""
    rng = np.random.default_rng(10)
    embed = rng.uniform(-1 / SIZE, 1 / SIZE, ((1 << BITS) + 1, SIZE))
    out, bias = np.zeros((SIZE, n)), np.zeros(n)
    steps = EPOCHS * len(rows)
    for step, i in enumerate(np.concatenate([rng.permutation(len(rows)) for _ in range(EPOCHS)])):
        index, share, label = rows[i]
        share = share.astype(float)
        mean = share @ embed[index]
        logits = mean @ out + bias
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[label] -= 1
        rate = STEP * (1 - step / steps)
        back = out @ p
        out -= rate * np.outer(mean, p)
        bias -= 0.1 * rate * p
        embed[index] -= rate * np.outer(share, back) * min(100.0, 1 / max(1e-9, float(share @ share)))
    return embed, out, bias


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_train: int = MAX_TRAIN,
          max_values: int = MAX_VALUES) -> Model | None:
    """A model of at most ``max_train`` rows that fulfil ``usable``, a condition on the id, and at most ``max_values`` features of them (or one row); None without rows."""
    known = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = known.select(F.col(id_col).alias("k"), F.col(lang_col).cast("string").alias("y"), F.col(text_col).cast("string").alias("t")).withColumn("h", F.xxhash64("t"))
    chosen = least(rows.select("k", "h"), [F.xxhash64("k"), F.col("k"), F.col("h")], max_train).distinct()
    # Repeated rows are one row; max_train pairs of numbers at most are broadcast.
    sample = rows.join(F.broadcast(chosen), ["k", "h"]).dropDuplicates(["k", "h", "y"]).select("k", "y", "t")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row, data, offsets in arrowtext.blocks(batch.column(2)):
                code, cuts, word, first = _features(data, offsets)
                for i in range(len(offsets) - 1):
                    own = np.concatenate([code[cuts[i] : cuts[i + 1]], word[first[i] : first[i + 1]]])
                    index, count = np.unique(own[own < 1 << BITS], return_counts=True)
                    found.append((index.astype("<i4").tobytes(), (count / max(1, count.sum())).astype("<f4").tobytes(), batch.column(1)[row + i].as_py(), batch.column(0)[row + i].as_py()))
            yield pa.RecordBatch.from_arrays([
                pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary()), pa.array([f[2] for f in found], pa.string()),
                pa.array([str(f[3]) for f in found], pa.string()), pa.array([len(f[0]) // 4 for f in found], pa.int64())], names=["i", "v", "y", "k", "size"])

    features = materialise(sample.mapInArrow(described, "i binary, v binary, y string, k string, size long").withColumn("h", F.xxhash64("i", "v")), "features")
    # What the driver fits is bounded in rows and in numbers: rows in the order of their hashes while these are not used up.
    order = sorted((r["h"], r["k"], r["y"], r["size"]) for r in features.select("h", "k", "y", "size").collect())
    fitting = int(np.searchsorted(np.cumsum([size for *_, size in order]), max_values, "right"))
    last = order[max(0, fitting - 1)][0] if order else 0
    got = sorted(features.where(F.col("h") <= last).select("i", "v", "y", "k").collect(), key=lambda r: (r["k"], r["y"], bytes(r["i"])))
    if not got:
        return None
    languages = sorted({r["y"] for r in got})
    data = [(np.frombuffer(r["i"], "<i4"), np.frombuffer(r["v"], "<f4"), languages.index(r["y"])) for r in got]
    fit, held = [x for i, x in enumerate(data) if i % 5] or data, data[::5]
    embed, out, bias = _fit(fit, len(languages))
    table = embed @ out
    table[-1] = 0
    logits = np.array([share @ table[index] + bias for index, share, _ in held])
    truth = np.array([y for _, _, y in held])

    def calibrated(t: float) -> np.ndarray:
        p = np.exp((logits - logits.max(1, keepdims=True)) / t)
        return p / p.sum(1, keepdims=True)

    loss = lambda t: -np.log(calibrated(t)[np.arange(len(truth)), truth] + 1e-9).mean()
    temperature = min((float(t) for t in np.geomspace(0.1, 4, 40)), key=loss)
    best, right = calibrated(temperature).max(1), logits.argmax(1) == truth
    limits = [t for t in np.linspace(0.25, 0.99, 75) if (best >= t).any() and right[best >= t].mean() >= ACCURACY]
    return Model(languages, table.T.astype(np.float32).copy(), bias, temperature, float(min(limits, default=0.99)))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) of every whole text."""
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col), text.alias("t"), F.coalesce(text.rlike("\\p{L}"), F.lit(False)).alias("spoken"))
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            spoken = batch.column(2).to_numpy(zero_copy_only=False)
            best, score = np.zeros(n, np.int64), np.zeros(n)
            for row, data, offsets in arrowtext.blocks(batch.column(1)) if model else ():
                code, cuts, word, first = _features(data, offsets)
                count = _sums(code < 1 << BITS, cuts) + np.diff(first)
                sums = np.stack([_sums(t.take(code), cuts) + _sums(t.take(word), first) for t in model.table], 1)
                logits = (sums / np.maximum(count, 1)[:, None] + model.bias) / model.temperature
                p = np.exp(logits - logits.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                best[row : row + len(p)], score[row : row + len(p)] = p.argmax(1), p.max(1)
            known = spoken & (model is not None)
            names = np.array([*(model.languages if model else []), UNKNOWN], object)
            score = np.where(known, score, 0.0)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(names[np.where(known, best, len(names) - 1)], pa.string()), pa.array(score),
                pa.array(known & (score >= (model.limit if model else 2)))], names=[f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields))
