"""Secrets: base patterns, and Markov models of random strings and ordinary identifiers.

Two character bigram models, one of random strings and one of ordinary words and identifiers, give a log-likelihood ratio per
character of every long token. Tokens over the learned limit are added to the base spans as kind ``random``, unless they
overlap one. Both models are trained from labelled samples: random strings are base matches of a bounded sample of
documents (all of their tokens) and generated keys; ordinary ones are the other tokens of these documents and generated identifiers. Documents hold keys that no
base pattern knows: tokens that models of the generated strings alone take for random are left out of the ordinary ones, and the limit follows
a quantile of the ordinary tokens, so that a few keys among them do not raise it above their own kind.

Spans are in code points, end exclusive. Null texts count as empty and have no spans. Rows are independent, so repeated rows
give the same row again, an empty table none; columns other than the id and the text are not read. Whole texts are searched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.llm.sampling import least
from pulsemill.session import materialise

# The base patterns, in the order of their kinds. A run that is too short has no long enough part either.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SAMPLE_DOCS = 1000
GENERATED = 3000
#: This share of the ordinary training tokens, each as often as it occurs, must stay this far below the limit.
USUAL = 0.999
MARGIN = 0.35
#: Ordinary tokens from this size on count for the limit, and may be keys.
LONG = 12
#: Scores are counted in steps of this size.
STEP = 0.001

_INDEX = np.full(128, len(SYMBOLS), np.int64)
_INDEX[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Sorted (start, kind number, end) of the base patterns."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _codes(token: str) -> np.ndarray:
    return _INDEX[np.frombuffer(token.encode("ascii", "replace"), np.uint8) & 127]


_SIDE = len(SYMBOLS) + 1


def _pairs(tokens: Iterable[str]) -> np.ndarray:
    """How often each character pair occurs in the tokens."""
    counts = np.zeros((_SIDE, _SIDE))
    for token in tokens:
        c = _codes(token)
        np.add.at(counts, (c[:-1], c[1:]), 1)
    return counts


class Models:
    """Log-likelihood ratios of the character pairs, from their counts in random and ordinary strings, and the limit per character."""

    def __init__(self, random: np.ndarray, ordinary: np.ndarray, limit: float = 0.0):
        share = lambda counts: np.log((counts + 0.5) / (counts + 0.5).sum(1, keepdims=True))
        self.ratio, self.limit = share(random) - share(ordinary), limit

    def score(self, token: str) -> float:
        """Mean log-likelihood ratio of a character pair: above the limit, a random string."""
        c = _codes(token)
        return float(self.ratio[c[:-1], c[1:]].mean()) if len(c) > 1 else 0.0

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        found = base_spans(text)
        extra = []
        for m in TOKEN.finditer(text):
            if not any(a < m.end() and m.start() < b for a, _, b in found) and self.score(m[0]) >= self.limit:
                extra.append((m.start(), 3, m.end()))
        return sorted(found + extra)


def generated(n: int = GENERATED, seed: int = 6) -> tuple[list[str], list[str]]:
    """(random strings, ordinary identifiers) by a fixed rule."""
    rng = np.random.default_rng(seed)
    alphabets = [SYMBOLS[:62], SYMBOLS[:62] + "+/", SYMBOLS[:26] + "234567", "0123456789abcdef"]
    keys = ["".join(rng.choice(list(alphabets[i % 4]), int(rng.integers(20, 45)))) for i in range(n)]
    parts = ("get set list user name file path data index count value token stream batch window table column row query result error handler client "
             "server request response buffer cache node tree graph edge total offset length config option default parse format read write open close").split()
    words = [[str(x) for x in rng.choice(parts, int(rng.integers(2, 6)))] for _ in range(n)]
    shapes = [lambda w: "_".join(w), lambda w: w[0] + "".join(map(str.title, w[1:])), lambda w: "-".join(w), lambda w: "_".join(w).upper(), lambda w: "/".join(w), lambda w: "".join(map(str.title, w)) + "2"]
    return keys, [shapes[i % len(shapes)](w) for i, w in enumerate(words)] + ["=" * 40, "-" * 40, "_" * 40]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Models:
    """Models from generated tokens and those of the ``sample_docs`` rows of least hash of id and text.

    The tokens stay in Spark: what comes to the driver is the counts of character pairs and of scores, whose number does not
    depend on the texts, so no token of either kind is left out.
    """
    sample = docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("string").alias("t")).where(F.col("t").isNotNull()).withColumn("h", F.xxhash64("t"))
    chosen = least(sample.select(F.col("k").alias("own"), F.col("h").alias("hash")), [F.xxhash64("own"), F.col("own"), F.col("hash")], sample_docs).distinct()
    # Repeated rows are one row; sample_docs pairs of numbers at most are broadcast.
    rows = sample.join(F.broadcast(chosen), F.col("k").eqNullSafe(F.col("own")) & (F.col("h") == F.col("hash"))).dropDuplicates(["k", "h"])

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0):
                text = t.as_py()
                found = base_spans(text)
                out = [(1, m) for a, _, b in found for m in TOKEN.findall(text[a:b])]
                for a, _, b in reversed(found):
                    text = text[:a] + " " + text[b:]
                out += [(0, m) for m in re.findall(r"[A-Za-z0-9+/_=-]{6,}", text)]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int32()), pa.array([x for _, x in out], pa.string())], names=["label", "token"])

    found = materialise(rows.select("t").mapInArrow(tokens, "label int, token string").groupBy("label", "token").agg(F.count(F.lit(1)).alias("n")), "tokens")
    return _fitted(found)


def _fitted(found: DataFrame) -> Models:
    """Models from generated tokens and the distinct (label, token, n) of documents; unlabelled keys among these are left out."""
    keys, names = generated()
    first = Models(_pairs(keys), _pairs(names))
    first.limit = _limit(first, keys, [(first.score(t), 1) for t in names if len(t) >= LONG], [])

    def kept(label: int, token: str) -> bool:
        return label == 1 or len(token) < LONG or first.score(token) < first.limit

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, _SIDE, _SIDE))
        for batch in batches:
            rows = [(x, t) for x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if kept(x, t)]
            for label in (0, 1):
                total[label] += _pairs(t for x, t in rows if x == label)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel()[cell])], names=["cell", "n"])

    total = np.zeros((2, _SIDE, _SIDE))
    for r in found.select("label", "token").mapInArrow(pairs, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total.reshape(-1)[r["cell"]] = r["n"]
    models = Models(_pairs(keys) + total[1], _pairs(names) + total[0])

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(x, round(models.score(t) / STEP), n if x == 0 else 1) for x, t, n in zip(*(c.to_pylist() for c in batch.columns)) if len(t) >= (LONG, 20)[x] and kept(x, t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=["label", "score", "n"])

    # Scores are rounded, so their number is bounded.
    counted = found.select("label", "token", "n").mapInArrow(scores, "label int, score long, n long").groupBy("label", "score").agg(F.sum("n").alias("n")).collect()
    usual = [(models.score(t), 1) for t in names if len(t) >= LONG] + [(r["score"] * STEP, r["n"]) for r in counted if r["label"] == 0]
    models.limit = _limit(models, keys, usual, [(r["score"] * STEP, r["n"]) for r in counted if r["label"] == 1])
    return models


def _limit(models: Models, keys: list[str], usual: list[tuple[float, int]], labelled: list[tuple[float, int]]) -> float:
    """A margin over the quantile of the ordinary scores, and not below the least scores of keys."""
    def quantile(scores: list[tuple[float, int]], share: float) -> float:
        scores = sorted(scores)
        seen = np.cumsum([n for _, n in scores])
        return scores[min(len(scores) - 1, int(np.searchsorted(seen, share * seen[-1])))][0]

    low = (quantile(usual, USUAL) if usual else 0.0) + MARGIN
    known = [(models.score(t), 1) for t in keys if len(t) >= 20] + labelled
    return max(low, quantile(known, 0.02)) if known else low


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def scan(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base, spans): counts and base spans of the patterns, and all spans, as kind:start:end."""
    names = ["n_assign", "n_access", "n_hex"]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(n, T.LongType()) for n in names), T.StructField("base", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [models.spans(t.as_py() or "") for t in batch.column(1)]
            base = [[x for x in f if x[1] < 3] for f in found]
            counts = [pa.array([sum(x[1] == k for x in b) for b in base], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(map(written, base), pa.string()), pa.array(map(written, found), pa.string())], names=[f.name for f in schema])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema)
