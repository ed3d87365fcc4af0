"""Approximate nearest neighbours by largest inner product, found with an inverted multi-index.

Both halves of a vector are quantised by a codebook of their own, so ``m`` centroids a half give ``m * m`` cells. A query walks through
the pairs of centroids by summed distance (the negative inner products of its halves with the centroids) with a heap, until the cells it
has met hold enough entries; the entries of those cells are ranked by their exact inner product in double precision.

How many entries are enough is measured, not guessed: ``trial`` queries are searched in all rows, and the budget is the least one that
reaches the places of ``recall`` of their true neighbours. Codebooks are fitted by k-means on a bounded sample (``fit_rows`` rows of
least id hash); every row is indexed, and all candidates of the visited cells are ranked.

Equal vectors are one entry that names its ``k + 1`` least ids, so many copies of a vector cost one comparison and lose no neighbour. Cells
are packed into blocks of bounded size, a large cell into several, and a block with many visits is copied for parts of them; a
task holds one block and streams queries through it.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without an id or with another length
than the commonest one. Repeated rows count once; two vectors under one id are two rows, neither a candidate of the other's query, each
with its own list. Ties go to the smaller id. A table with fewer candidates gives them all, an empty one nothing. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.llm.sampling import least
from pulsemill.session import materialise

RECALL = 0.96
FIT_ROWS = 16_384
#: Numbers of the fitting sample and of the trial queries that the driver holds at most.
FIT_VALUES = 1 << 22
TRIAL = 256
MAX_CENTROIDS = 256
#: Entries of a block (twice that at most), and visits that one copy of a block serves.
BLOCK = 32_768
VISITS = 100_000
_SCORES = 1 << 21


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def k_means(rows: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """``k`` centroids of ``rows`` (as many as there are rows, if fewer)."""
    rng = np.random.default_rng(seed)
    centres = rows[np.sort(rng.choice(len(rows), min(k, len(rows)), replace=False))]
    for _ in range(rounds):
        nearest = nearest_centroids(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        count = np.bincount(nearest, minlength=len(centres))[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    return centres


def nearest_centroids(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1) / 2 - rows @ centres.T).argmin(1)


class Codebooks:
    """Centroids of both halves. A vector of one component has an empty first half, with one centroid."""

    def __init__(self, sample: np.ndarray, centroids: int, seed: int = 13):
        self.dim = sample.shape[1]
        self.half = self.dim // 2
        self.first = k_means(sample[:, : self.half], centroids if self.half else 1, seed)
        self.second = k_means(sample[:, self.half :], centroids, seed + 1)
        self.cells = len(self.first) * len(self.second)

    def cell(self, rows: np.ndarray) -> np.ndarray:
        return nearest_centroids(rows[:, : self.half], self.first) * len(self.second) + nearest_centroids(rows[:, self.half :], self.second)

    def distances(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return -rows[:, : self.half] @ self.first.T, -rows[:, self.half :] @ self.second.T


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, budget: int) -> list[int]:
    """The non-empty cells by summed distance, until they hold ``budget`` entries or all are met.

    Pairs wait in a heap: one brings in its right neighbour, and the first one of a row also the start of the next row, so each pair
    waits once and they leave in order of their sums.
    """
    rows, columns = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    a, b, width = first[rows].tolist(), second[columns].tolist(), len(second)
    heap, found, out = [(a[0] + b[0], 0, 0)], 0, []
    while heap and found < budget:
        _, i, j = heapq.heappop(heap)
        cell = rows[i] * width + columns[j]
        if sizes[cell]:
            out.append(cell)
            found += sizes[cell]
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return out


class Blocks:
    """Cells dealt to blocks in order: neighbours share one, and a cell over ``size`` entries has several of its own."""

    def __init__(self, sizes: np.ndarray, size: int):
        self.parts = np.maximum(1, -(-sizes // size))
        small = np.where(self.parts > 1, 0, sizes)
        packed = (np.cumsum(small) - small) // size
        # A new number wherever the pack changes or a cell stands alone or follows such a cell.
        fresh = np.append(True, (np.diff(packed) != 0) | (self.parts[1:] > 1) | (self.parts[:-1] > 1))
        steps = np.where(fresh, np.append(1, self.parts[:-1]), 0)
        steps[0] = 0
        self.first = np.cumsum(steps)
        self.count = int(self.first[-1] + self.parts[-1])


def _valid(v: Column) -> Column:
    return F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL,
            fit_rows: int = FIT_ROWS, trial: int = TRIAL, block: int = BLOCK, visits: int = VISITS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` holds, the ``k`` nearest other rows that are found."""
    spark, kind = rows.sparkSession, rows.schema[id_col].dataType
    out = T.StructType([T.StructField("query_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", kind), T.StructField("score", T.DoubleType())])
    item = rows.schema[vector_col].dataType.elementType
    kept = rows.select(F.col(id_col).alias("i"), F.col(vector_col).cast(f"array<{'float' if item == T.FloatType() else 'double'}>").alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("q")).where(F.col("i").isNotNull() & _valid(F.col("v")))
    lengths = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], out)
    dim = lengths["d"]
    pairs = materialise(kept.where(F.size("v") == dim).groupBy("v", "i").agg(F.max("q").alias("q")), "vectors")
    copies = Window.partitionBy("v").orderBy("i")
    unique = pairs.withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("i")).alias("ids"))
    asked = pairs.where("q").select("v").distinct()

    def chosen(df: DataFrame, n: int) -> np.ndarray:
        held = least(df.select("v"), [F.xxhash64("v"), F.col("v")], min(n, max(1, FIT_VALUES // dim))).toArrow()
        return _vectors(held.column(0).combine_chunks(), dim) if held.num_rows else np.zeros((0, dim))

    sample = chosen(pairs, fit_rows)
    books = Codebooks(sample, max(1, min(MAX_CENTROIDS, round(math.sqrt(lengths["count"]) / 4))))
    entries = materialise(_with_cells(unique, books), "cells")
    sizes = np.zeros(books.cells, np.int64)
    for r in entries.groupBy("cell").count().collect():  # MAX_CENTROIDS squared numbers at most
        sizes[r["cell"]] = r["count"]
    trials = chosen(asked, trial)
    if not len(trials):
        return spark.createDataFrame([], out)
    budget = _budget(entries, books, sizes, trials, k, recall)
    n_tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = Blocks(sizes, int(min(block, max(256, sizes.sum() // n_tasks))))
    # The share of the queries that visits the most wanted block, seen in the trial queries.
    seen = np.zeros(blocks.count)
    for t in range(len(trials)):
        one, two = books.distances(trials[t : t + 1])
        met = np.array(traverse(one[0], two[0], sizes, budget), np.int64)
        seen[np.unique(_block_numbers(met, blocks))] += 1
    copies_of = max(1, math.ceil(asked.count() * seen.max(initial=0) / len(trials) / visits))
    dealt = _entry_rows(entries, blocks, copies_of, kind).unionByName(_visit_rows(asked, books, blocks, sizes, budget, copies_of, kind))
    dealt = dealt.repartition(blocks.count * copies_of, "block", "part").sortWithinPartitions("block", "part", "is_visit")
    found = _search(dealt, dim, k, kind)
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "i")
    lists = found.select("h1", "h2", F.inline(F.arrays_zip(F.col("ids").alias("i"), F.col("scores").alias("score")))).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).groupBy("h1", "h2").agg(
        F.sort_array(F.collect_list(F.struct("n", "i", "score"))).alias("top"))
    members = pairs.where("q").select(F.col("i").alias("query_id"), *_hashes())
    own = F.slice(F.filter("top", lambda x: x["i"] != F.col("query_id")), 1, k)
    return members.join(lists, ["h1", "h2"]).select("query_id", F.posexplode(own).alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"), F.col("x.score").alias("score"))


def _hashes() -> list[Column]:
    """Two 64-bit hashes of a vector, which name it in joins."""
    return [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2")]


def _with_cells(unique: DataFrame, books: Codebooks) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("cell", pa.array(books.cell(_vectors(batch.column("v"), books.dim)).astype(np.int32)))

    return unique.mapInArrow(run, T.StructType([*unique.schema.fields, T.StructField("cell", T.IntegerType())]))


def _budget(entries: DataFrame, books: Codebooks, sizes: np.ndarray, trials: np.ndarray, k: int, recall: float) -> int:
    """Entries that a query has to meet so that ``recall`` of the trial queries' true neighbours are among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, cell = np.zeros((len(trials), 0)), np.zeros((len(trials), 0), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                rows = _vectors(part.column(0), books.dim)
                score = np.concatenate([score, trials @ rows.T], 1)
                cell = np.concatenate([cell, np.broadcast_to(part.column(1).to_numpy().astype(np.int64), (len(trials), len(rows)))], 1)
                if score.shape[1] > k + 1:
                    top = np.argpartition(-score, k, 1)[:, : k + 1]
                    score, cell = np.take_along_axis(score, top, 1), np.take_along_axis(cell, top, 1)
        number = np.repeat(np.arange(len(trials), dtype=np.int32), score.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(score.ravel()), pa.array(cell.ravel())], ["t", "score", "cell"])

    local = entries.select("v", "cell").mapInArrow(run, "t int, score double, cell long")
    ranked = local.withColumn("n", F.row_number().over(Window.partitionBy("t").orderBy(F.desc("score"), "cell")))
    # The nearest entry is the query itself.
    wanted: dict[int, list[int]] = {}
    for r in ranked.where((F.col("n") > 1) & (F.col("n") <= k + 1)).collect():  # trial queries times k rows
        wanted.setdefault(r["t"], []).append(r["cell"])
    need, (first, second) = [], books.distances(trials)
    for t, cells in wanted.items():
        order = np.argsort((first[t][:, None] + second[t][None]).ravel(), kind="stable")
        met = np.empty(len(order), np.int64)
        met[order] = np.cumsum(sizes[order])
        need += met[cells].tolist()
    return max(k + 1, int(np.quantile(need, recall, method="higher")) if need else 0)


def _block_numbers(cells: np.ndarray, blocks: Blocks) -> np.ndarray:
    """All blocks of ``cells``, those of a cell in a row."""
    count = blocks.parts[cells]
    return np.repeat(blocks.first[cells] - np.cumsum(count) + count, count) + np.arange(count.sum())


def _row_schema(vector: T.DataType, kind: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("block", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("is_visit", T.IntegerType()),
        T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("v", vector),
        T.StructField("ids", T.ArrayType(kind)), T.StructField("cells", T.ArrayType(T.IntegerType()))])


def _entry_rows(entries: DataFrame, blocks: Blocks, copies: int, kind: T.DataType) -> DataFrame:
    schema = _row_schema(entries.schema["v"].dataType, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, h1 = batch.column("cell").to_numpy(), batch.column("h1").to_numpy()
            number = (blocks.first[cell] + h1 % blocks.parts[cell]).astype(np.int32)
            one = np.ones(len(cell), np.int32)
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(cell) + 1, dtype=np.int32)), batch.column("cell"))
            for part in range(copies):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number), pa.array(one * part), pa.array(one * 0), batch.column("h1"), batch.column("h2"), batch.column("v"), batch.column("ids"), cells],
                    names=schema.names)

    return entries.select("v", "ids", "cell", *_hashes()).mapInArrow(run, schema)


def _visit_rows(asked: DataFrame, books: Codebooks, blocks: Blocks, sizes: np.ndarray, budget: int, copies: int, kind: T.DataType) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    schema = _row_schema(asked.schema["v"].dataType, kind)
    ids = pa.list_(to_arrow_type(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                first, second = books.distances(_vectors(part.column("v"), books.dim))
                row, number, cells = [], [], []
                for r in range(part.num_rows):
                    met = np.sort(np.array(traverse(first[r], second[r], sizes, budget), np.int64))
                    whole = met[blocks.parts[met] == 1]
                    starts = np.flatnonzero(np.append(True, np.diff(blocks.first[whole]) != 0)) if len(whole) else np.zeros(0, np.int64)
                    number += blocks.first[whole[starts]].tolist()
                    cells += np.split(whole, starts[1:]) if len(whole) else []
                    for cell in met[blocks.parts[met] > 1].tolist():
                        number += range(blocks.first[cell], blocks.first[cell] + blocks.parts[cell])
                        cells += [np.array([cell])] * int(blocks.parts[cell])
                    row += [r] * (len(number) - len(row))
                row, one = np.array(row, np.int64), np.ones(len(row), np.int32)
                held = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int32()), pa.array((held.column("h1").to_numpy() % copies).astype(np.int32)), pa.array(one), held.column("h1"), held.column("h2"),
                     held.column("v"), pa.nulls(len(row), ids), _lists(cells, pa.int32())], names=schema.names)

    return asked.select("v", *_hashes()).mapInArrow(run, schema)


class _Block:
    """The entries of one block, ready for queries."""

    def __init__(self, batches: list[pa.RecordBatch], dim: int):
        held = pa.Table.from_batches(batches).combine_chunks()
        self.rows = _vectors(held.column("v").combine_chunks(), dim)
        cells = held.column("cells").combine_chunks().flatten().to_numpy()
        self.names, self.cell = np.unique(cells, return_inverse=True)
        ids = held.column("ids").combine_chunks()
        self.ends, self.ids = ids.offsets.to_numpy().astype(np.int64), ids.values
        self.reach = float(np.sqrt((self.rows * self.rows).sum(1).max()))

    def top(self, queries: np.ndarray, cells: pa.Array, k: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(query, id, score) of the ``k`` best ids of every query in its cells, ties by the smaller id."""
        met = np.zeros((len(queries), len(self.names)), bool)
        met[np.repeat(np.arange(len(queries)), np.diff(cells.offsets.to_numpy())), np.searchsorted(self.names, cells.flatten().to_numpy())] = True
        with np.errstate(over="ignore", invalid="ignore"):
            score = np.where(met[:, self.cell], queries @ self.rows.T, -np.inf)
            bound = np.full(len(queries), -np.inf)
            if score.shape[1] > k:
                bound = np.partition(score, score.shape[1] - k, 1)[:, score.shape[1] - k]
            # Products from BLAS may differ in the last bit; the exact ones decide.
            slack = 1e-9 * self.reach * np.sqrt((queries * queries).sum(1))
            query, entry = np.nonzero((score >= (bound - slack)[:, None]) & met[:, self.cell])
            exact = np.einsum("ij,ij->i", queries[query], self.rows[entry])
        count = self.ends[entry + 1] - self.ends[entry]
        place = np.repeat(self.ends[entry] - np.cumsum(count) + count, count) + np.arange(count.sum())
        query, exact, ids = np.repeat(query, count), np.repeat(exact, count), self.ids.take(pa.array(place))
        order = np.lexsort((ids.to_numpy(zero_copy_only=False), -exact, query))
        query = query[order]
        kept = np.arange(len(query)) - np.searchsorted(query, query, "left") < k
        return query[kept], ids.take(pa.array(order[kept])), exact[order[kept]]


def _search(dealt: DataFrame, dim: int, k: int, kind: T.DataType) -> DataFrame:
    """(h1, h2, ids, scores): the ``k + 1`` best ids of every query in every block that it visits."""
    schema = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
                           T.StructField("scores", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy() for n in ("block", "part", "is_visit")])
            cuts = np.append(np.flatnonzero(np.append(True, np.diff(keys).any(0))), batch.num_rows) if batch.num_rows else [0]
            for low, high in zip(cuts[:-1], cuts[1:]):
                block, part, is_visit = keys[:, low].tolist()
                if (block, part) != at:
                    at, held, ready = (block, part), [], None
                rows = batch.slice(low, high - low)
                if not is_visit:
                    held.append(rows)
                    continue
                if ready is None and held:
                    ready, held = _Block(held, dim), []
                if ready is None:
                    continue
                step = max(1, _SCORES // len(ready.rows))
                for start in range(0, rows.num_rows, step):
                    some = rows.slice(start, step)
                    query, ids, score = ready.top(_vectors(some.column("v"), dim), some.column("cells"), k + 1)
                    ends = pa.array(np.searchsorted(query, np.arange(some.num_rows + 1)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [some.column("h1"), some.column("h2"), pa.ListArray.from_arrays(ends, ids), pa.ListArray.from_arrays(ends, pa.array(score))], names=schema.names)

    return dealt.mapInArrow(run, schema)
