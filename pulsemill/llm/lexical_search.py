"""Ranked lexical search by dense blocked matrix products: item vocabulary tiles times document impact tiles.

The items of a block have a compact vocabulary: only its terms are looked up in the documents, which become rows of (term number, count).
Up to ``TILE_ITEMS`` items with the vocabulary of just these items make a tile of term weights; documents make tiles of
impacts over the same vocabulary. Both are dense float64 matrices multiplied by BLAS. All entries are whole numbers and a vocabulary tile
is as narrow as it has to be to keep every partial sum below 2 ** 53, so the products are exact in any order; partial sums of
several vocabulary tiles are added as 64-bit integers.

Top lists are tie-safe: from each tile every document goes on that reaches the item's bound (its k-th best score so far), equal scores
included, and ties are cut by ascending id only. Each task gives ``k`` rows an item, merged in two rounds.

Terms are the maximal runs of ``TERM`` bytes with A-Z in lower case; every whole text is read, a very long one by itself. Null and empty
texts have no terms and are not counted. Statistics are of all documents. Repeated documents each count and rank for themselves,
repeated items (id and text) give one list; an id with two texts gives two. A null id of a document comes after all others in ties. Items
without a term that some document has give no rows, and neither do empty tables. Other columns are not read. Document ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.llm import arrowtext
from pulsemill.session import materialise

TOP = 10
#: Item text of one pass over the documents; more items take more passes.
BLOCK_CHARS = 2_000_000
TILE_ITEMS = 256
TILE_TERMS = 4096
TILE_DOCS = 512
EXACT = 1 << 53
_ROUNDS = 64

#: What no term holds, as bytes; bytes from 0x80 on are parts of letters.
_OUTSIDE = np.zeros(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _OUTSIDE[_low : _high + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-case bytes, start, end, first term of each row) of a block of texts."""
    starts, ends, first = arrowtext.words(data, offsets, _OUTSIDE)
    return _LOWER[data], starts, ends, first


def item_terms(text: str) -> list[bytes]:
    raw = np.frombuffer(text.encode(), np.uint8)
    data, starts, ends, _ = terms(raw, np.array([0, len(raw)]))
    whole = data.tobytes()
    return sorted({whole[s:e] for s, e in zip(starts.tolist(), ends.tolist())})


class Vocabulary:
    """The terms of a block of items, found in documents by hash and confirmed byte by byte."""

    def __init__(self, words: list[bytes]):
        self.data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        starts = ends - np.array([len(w) for w in words], np.int64)
        hashes = arrowtext.word_hashes(self.data, starts, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts, self.ends = hashes[self.order], starts[self.order], ends[self.order]
        self.bits = min(24, max(12, len(words).bit_length() + 6))
        self.known = np.zeros(1 << self.bits, bool)
        self.known[self.hashes >> np.uint64(64 - self.bits)] = True

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the term in the text, number of the word in the vocabulary) of all terms that are in it."""
        hashes = arrowtext.word_hashes(data, starts, ends)
        near = np.flatnonzero(self.known[hashes >> np.uint64(64 - self.bits)])
        low, high = np.searchsorted(self.hashes, hashes[near], "left"), np.searchsorted(self.hashes, hashes[near], "right")
        place, word = [near[:0]], [near[:0]]
        # Words with one hash stand side by side; nearly always there is one.
        for layer in range(int((high - low).max(initial=0))):
            some = np.flatnonzero(low + layer < high)
            at, entry = near[some], low[some] + layer
            size = ends[at] - starts[at]
            same = size == self.ends[entry] - self.starts[entry]
            at, entry, size = at[same], entry[same], size[same]
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            equal = data[np.repeat(starts[at], size) + step] == self.data[np.repeat(self.starts[entry], size) + step]
            kept = np.logical_and.reduceat(equal, np.cumsum(size) - size) if len(size) else np.zeros(0, bool)
            place.append(at[kept])
            word.append(self.order[entry[kept]])
        return np.concatenate(place), np.concatenate(word)


class Block:
    """The items that one pass over the documents holds, as whole numbers."""

    def __init__(self, items: list[tuple[object, str]]):
        found = [(i, item_terms(text)) for i, text in items]
        found = [x for x in found if x[1]]
        self.ids = [i for i, _ in found]
        self.words = sorted({w for _, ws in found for w in ws})
        number = {w: n for n, w in enumerate(self.words)}
        self.items = [np.array([number[w] for w in ws]) for _, ws in found]

    @cached_property
    def vocabulary(self) -> Vocabulary:
        return Vocabulary(self.words)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "vocabulary"}


def _counts(block: Block, ids: T.DataType):
    schema = T.StructType([T.StructField("d", ids), T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("tf", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = len(block.words)
        for batch in batches:
            for row, data, offsets in arrowtext.blocks(batch.column(1)):
                data, starts, ends, first = terms(data, offsets)
                n = np.diff(first)
                place, word = block.vocabulary.find(data, starts, ends)
                key, count = np.unique((np.searchsorted(first, place, "right") - 1) * words + word, return_counts=True)
                bounds = np.searchsorted(key, np.arange(len(n) + 1) * words).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32))) for x in (key % max(words, 1), count)]
                rows = pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(n)), pa.array(n.astype(np.int64)), *lists], names=schema.names)
                yield rows.filter(pa.array(n > 0))

    return run, schema


def _document_frequencies(counted: DataFrame, words: int) -> np.ndarray:
    """How many documents hold each word; a task adds up its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(words, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=words)
        word = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(total[word])], ["word", "df"])

    out = np.zeros(words, np.int64)
    for r in counted.select("terms").mapInArrow(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df")).collect():
        out[r["word"]] = r["df"]
    return out


def _tiles(block: Block, weights: np.ndarray, most: int) -> list[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """(items, [(vocabulary, weight matrix)]) of each tile; ``most`` terms a vocabulary at most."""
    out = []
    for at in range(0, len(block.items), TILE_ITEMS):
        items = np.arange(at, min(at + TILE_ITEMS, len(block.items)))
        whole = np.unique(np.concatenate([block.items[n] for n in items]))
        whole = whole[weights[whole] > 0]  # a term without weight adds nothing
        parts = []
        for low in range(0, len(whole), most):
            vocabulary = whole[low : low + most]
            matrix = np.zeros((len(items), len(vocabulary)))
            for row, n in enumerate(items):
                held = block.items[n][np.isin(block.items[n], vocabulary)]
                matrix[row, np.searchsorted(vocabulary, held)] = weights[held]
            parts.append((vocabulary, matrix))
        out.append((items, parts))
    return out


class _Top:
    """The ``k`` best (score, id) of each of some items, ties by ascending id."""

    def __init__(self, items: int, k: int):
        self.k, self.bound = k, np.ones(items, np.int64)
        self.item = np.zeros(0, np.int64)
        self.score, self.id, self.is_null = self.item, self.item, np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, is_null: np.ndarray) -> None:
        bound = self.bound
        if scores.shape[1] > self.k:
            bound = np.maximum(bound, np.partition(scores, scores.shape[1] - self.k, 1)[:, scores.shape[1] - self.k])
        item, doc = np.nonzero(scores >= bound[:, None])
        if not len(item):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[item, doc]])
        ids, is_null = np.concatenate([self.id, ids[doc]]), np.concatenate([self.is_null, is_null[doc]])
        order = np.lexsort((ids, is_null, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item, "left")
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        self.bound[item[place == self.k - 1]] = score[last]
        self.item, self.score, self.id, self.is_null = item[place < self.k], score[kept], ids[kept], is_null[kept]


def _scores(block: Block, weights: np.ndarray, n_docs: int, n_terms: int, k: int, most: int, item_type: T.DataType, id_type: T.DataType):
    from pyspark.sql.pandas.types import to_arrow_type

    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type), T.StructField("d", id_type),
                           T.StructField("score", T.LongType()), T.StructField("task", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = _tiles(block, weights, most)
        column = np.full((len(tiles), len(block.words)), -1, np.int64)  # place of a word in a tile, counted over its vocabularies
        for row, (_, parts) in zip(column, tiles):
            if parts:
                words = np.concatenate([v for v, _ in parts])
                row[words] = np.arange(len(words))
        tops = [_Top(len(items), k) for items, _ in tiles]
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                is_null = part.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = part.column(0).fill_null(0).to_numpy().astype(np.int64)
                m = 10 + 90 * part.column(1).to_numpy() * n_docs // n_terms
                word, tf = (part.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                row = np.repeat(np.arange(part.num_rows), np.diff(part.column(2).offsets.to_numpy()))
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
                for place, (items, parts), top in zip(column, tiles, tops):
                    total, low = np.zeros((len(items), part.num_rows), np.int64), 0
                    where = place[word]
                    for vocabulary, matrix in parts:
                        inside = np.flatnonzero((where >= low) & (where < low + len(vocabulary)))
                        tile = np.zeros((len(vocabulary), part.num_rows))
                        tile[where[inside] - low, row[inside]] = impact[inside]
                        total += (matrix @ tile).astype(np.int64)
                        low += len(vocabulary)
                    top.add(total, ids, is_null)
        task = TaskContext.get().partitionId() % _ROUNDS
        for (items, _), top in zip(tiles, tops):
            item = items[top.item]
            yield pa.RecordBatch.from_arrays(
                [pa.array(item.astype(np.int32)), pa.array([block.ids[n] for n in item], to_arrow_type(item_type)),
                 pa.array(top.id, mask=top.is_null).cast(to_arrow_type(id_type)), pa.array(top.score), pa.array(np.full(len(item), task, np.int32))], names=schema.names)

    return run, schema


def _blocks(items: DataFrame, item_id: str, item_text: str, block_chars: int) -> Iterator[Block]:
    wanted = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).alias("i"), F.col(item_text).cast("string").alias("t")).distinct()
    passes = -(-(wanted.agg(F.sum(F.length("t"))).first()[0] or 0) // block_chars)
    for n in range(passes):
        held = wanted if passes == 1 else wanted.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == n)
        block = Block(sorted(((r["i"], r["t"]) for r in held.collect()), key=lambda x: (x[1], str(x[0]))))
        if block.items:
            yield block


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
         item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item id, rank, id, score): the ``k`` documents of highest score above 0 of each item, ranks from 1."""
    source = docs.select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("t"))
    id_type, item_type = docs.schema[id_col].dataType, items.schema[item_id].dataType
    schema = T.StructType([T.StructField(item_id, item_type), T.StructField("rank", T.IntegerType()), T.StructField(id_col, id_type), T.StructField("score", T.LongType())])
    out, totals = docs.sparkSession.createDataFrame([], schema), None
    for block in _blocks(items, item_id, item_text, block_chars):
        counted = materialise(source.mapInArrow(*_counts(block, id_type)), "terms")
        totals = totals or counted.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not totals["docs"]:
            return out
        frequency = _document_frequencies(counted, len(block.words))
        weights = np.floor(1000 * np.log((2 * totals["docs"] + 2) / (2 * frequency + 1))).astype(np.int64)
        weights[frequency == 0] = 0
        # An impact is below 10 ** 6.
        most = int(max(1, min(TILE_TERMS, (EXACT - 1) // (max(1, int(weights.max())) * 1_000_000))))
        local = counted.mapInArrow(*_scores(block, weights, totals["docs"], totals["terms"], k, most, item_type, id_type))
        order = [F.desc("score"), F.asc_nulls_last("d")]
        first, last = Window.partitionBy("item", "task").orderBy(*order), Window.partitionBy("item").orderBy(*order)
        best = local.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k).withColumn("r", F.row_number().over(last)).where(F.col("r") <= k)
        out = out.unionByName(best.select(F.col("item_id").alias(item_id), F.col("r").alias("rank"), F.col("d").alias(id_col), "score"))
    return out
