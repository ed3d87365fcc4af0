"""Benchmark items found in documents: CGK embedding, bit-sampling LSH, exact edit verification.

A CGK walk reads a string with a pointer and writes one character per step; a random bit that depends on the step and
the character decides whether the pointer moves. Strings a few edits apart fall back into step, so edit distance becomes
Hamming distance, and characters sampled at fixed steps agree with good probability. Windows start at every word of a
document and, for items, at every character from which a full window remains. Items are put into size classes (``SHAPES``), each with an index of its own whose
window, walks and samples are fixed numbers: what is found of an item, and at what cost, does not depend on the other items. Windows are far
shorter than items, so a passage with ``max_edit`` edits still has some that are nearly whole, and every table has a walk of its own. In runs without white space, as in Chinese, Thai or code,
windows of a document start at every character from ``Index.gap`` bytes on, so any copy of an item holds a start. One agreeing sample anywhere in a passage
proposes it. Parts of 64 characters are compared first: their distances add up to no more than the item's, so this loses nothing; an exact semi-global
edit distance between the whole item and that place of the document decides. Items below the least class are searched as they are, by an
Aho-Corasick automaton; such a copy must not go on in letters or digits on either side.

Texts are compared with A-Z in lower case and runs of white space as one space. A passage is a leak at an edit distance of at
most ``max_edit`` times the item's length, a short item (below ``MIN_ITEM`` characters) only as an exact copy. Null or empty texts have no leaks; null, empty and shorter items than
``LEAST_EXACT`` characters are left out, as they cannot be told from chance. Repeated documents and repeated items are
reported each for itself, a pair once, with its best place (the first one in ties). Very long texts are read whole, one by itself. Only the named columns are read, and ``clean`` keeps all
columns whatever their names. Empty tables give an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.llm import arrowtext
from pulsemill.session import materialise

MAX_EDIT = 0.2
MIN_ITEM = 16
LEAST_EXACT = 8


@dataclass(frozen=True)
class Shape:
    """A size class: items of ``least`` characters and more. A walk of ``steps`` steps reads about half as many bytes, the window."""

    least: int
    steps: int
    tables: int
    samples: int

    @property
    def window(self) -> int:
        return self.steps // 2


#: Walks and samples are set for the recall at MAX_EDIT itself (README has the figures).
SHAPES = (Shape(72, 30, 8, 15), Shape(MIN_ITEM, 14, 5, 9))
SEED = 20
#: Text of items that one pass holds in each task; more items take more passes over the documents.
BLOCK_CHARS = 2_000_000
_CHUNK = 1 << 14
_PLACES = 1 << 12


def _normal(text: str | None) -> str:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return arrowtext.compact(raw, np.array([0, len(raw)]))[0].tobytes().decode().rstrip(" ")


class Walk:
    """The random walks' bits and the sampled steps, a walk for each table, the same for documents and items."""

    def __init__(self, shape: Shape, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.steps, self.tables = shape.steps, shape.tables
        self.moves = rng.integers(0, 2, (self.tables, self.steps, 256), dtype=np.uint8).astype(np.int64)
        # One step from each of ``samples`` parts of the walk, so that every key says something of the whole window.
        edges = np.linspace(0, self.steps, shape.samples + 1).astype(int)
        self.drawn = [{int(rng.integers(low, max(low + 1, high))) for low, high in zip(edges, edges[1:])} for _ in range(self.tables)]

    def keys(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(tables, windows) sampled keys of the windows at ``starts``; ``data`` is padded by ``steps`` bytes."""
        out = np.empty((self.tables, len(starts)), np.uint64)
        width = -(-max(len(drawn) for drawn in self.drawn) // 8)
        sampled = np.zeros((len(starts), 8 * width), np.uint8)
        with np.errstate(over="ignore"):
            for key, moves, drawn in zip(out, self.moves, self.drawn):
                place, last, column = starts.astype(np.int64), max(drawn), 0
                sampled[:, len(drawn) :] = 0
                for step in range(last + 1):
                    seen = data.take(place, mode="clip")
                    if step in drawn:
                        sampled[:, column] = seen
                        column += 1
                    if step < last:
                        place += moves[step].take(seen, mode="clip")
                words = sampled.view("<u8")
                key[:] = words[:, 0]
                for n in range(1, width):
                    key[:] = arrowtext.mix(key) + words[:, n]
        return arrowtext.mix(out)


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of each character and the end, last byte of each character) of UTF-8."""
    first = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    return first, data[first[1:] - 1]


def edit_distance_within(item: str, text: str) -> int:
    """Smallest edit distance between ``item`` and any substring of ``text`` (bit-parallel columns)."""
    if item in text:
        return 0
    size = len(item)
    full, high = (1 << size) - 1, 1 << (size - 1)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    plus, minus, score, best = full, 0, size, size
    for c in text:
        eq = masks.get(c, 0)
        across = (((eq & plus) + plus) ^ plus) | eq
        up = (minus | ~(across | plus)) & full
        down = plus & across
        if up & high:
            score += 1
        elif down & high:
            score -= 1
            best = min(best, score)
        up = up << 1 & full
        down = down << 1 & full
        seen = eq | minus
        plus = (down | ~(seen | up)) & full
        minus = up & seen
    return best


class Index:
    """Sampled keys of all windows of the items of one size class; ``numbers`` are their places in the block."""

    def __init__(self, items: list[tuple[object, str]], numbers: list[int], shape: Shape):
        self.items, self.numbers = items, numbers
        self.walk, window = Walk(shape), shape.window
        #: Bytes at the start of a run without white space in which no further window of a document starts.
        self.gap = max(1, min(window, shape.least - window))
        self.size = np.array([len(text) for _, text in items])
        self.part = np.cumsum(np.append(0, -(-self.size // 64)))
        #: Bits of the characters' last bytes, for each 64 characters of an item.
        self.masks = np.zeros((self.part[-1], 256), np.uint64)
        keys, owner, offset = [], [], []
        for n, (_, text) in enumerate(items):
            raw = text.encode()
            data = np.frombuffer(raw + bytes(self.walk.steps + 1), np.uint8)
            first, last = _characters(data[: len(raw)])
            number = np.arange(len(last))
            np.bitwise_or.at(self.masks, (self.part[n] + number // 64, last), np.uint64(1) << (number % 64).astype(np.uint64))
            number = number[first[:-1] <= max(0, len(raw) - window)]
            keys.append(self.walk.keys(data, first[number]))
            owner.append(np.full(len(number), n, np.int32))
            offset.append(number.astype(np.int32))
        self.owner, self.offset, keys = np.concatenate(owner), np.concatenate(offset), np.concatenate(keys, 1)
        self.bits = min(24, max(16, int(len(self.owner)).bit_length() + 8))
        self.tables = []
        for row in keys:
            order = np.argsort(row, kind="stable").astype(np.int32)
            known = np.zeros(1 << self.bits, bool)
            known[row >> np.uint64(64 - self.bits)] = True
            # A bit for each place, as workers keep the index.
            self.tables.append((row[order], order, np.packbits(known, bitorder="little")))

    def proposals(self, data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item number, number of the window, the window's character in the item) of windows that share a sampled key with the item."""
        for at in range(0, len(starts), _CHUNK):
            part = starts[at : at + _CHUNK]
            for row, (keys, order, known) in zip(self.walk.keys(data, part), self.tables):
                place = (row >> np.uint64(64 - self.bits)).astype(np.int64)
                hit = np.flatnonzero(known.take(place >> 3) >> (place & 7).astype(np.uint8) & 1)
                low, high = np.searchsorted(keys, row[hit], "left"), np.searchsorted(keys, row[hit], "right")
                count = high - low
                if count.any():
                    entry = order[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
                    yield self.owner[entry].astype(np.int64), at + np.repeat(hit, count), self.offset[entry].astype(np.int64)

    def possible(self, text: np.ndarray, item: np.ndarray, begin: np.ndarray, low: np.ndarray, high: np.ndarray, slack: np.ndarray) -> np.ndarray:
        """Which items can be within ``slack`` of ``text[low:high]`` when their start is from ``begin - slack`` to ``begin + 2 * slack``: the smallest
        distances of the parts, each in all places it can have, add up to no more than the item's distance."""
        total, out = np.zeros(len(item), np.int64), np.arange(len(item))
        for n in range(int(-(-self.size[item].max(initial=0) // 64))):
            more = np.flatnonzero(self.size[item[out]] > 64 * n)
            for at in range(0, len(more), _PLACES):
                to = out[more[at : at + _PLACES]]
                left = begin[to] + 64 * n - slack[to]
                right = np.minimum(high[to], begin[to] + 64 * n + 64 + 2 * slack[to])
                total[to] += self._part_distance(text, self.part[item[to]] + n, np.minimum(64, self.size[item[to]] - 64 * n), np.maximum(left, low[to]), right)
            out = out[total[out] <= slack[out]]
        return out

    def _part_distance(self, text: np.ndarray, part: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Smallest edit distance between each part of an item and any substring of ``text[left:right]`` (bit-parallel columns)."""
        masks, row = self.masks.reshape(-1), part * 256
        high, one = (size - 1).astype(np.uint64), np.uint64(1)
        plus, minus = np.full(len(part), ~np.uint64(0)), np.zeros(len(part), np.uint64)
        score = size.astype(np.int64)
        best = score.copy()
        with np.errstate(over="ignore"):
            for step in range(int((right - left).max(initial=0))):
                place = left + step
                eq = masks.take(row + text.take(place, mode="clip")) * (place < right)
                across = (((eq & plus) + plus) ^ plus) | eq
                up = minus | ~(across | plus)
                down = plus & across
                score += (up >> high & one).astype(np.int64) - (down >> high & one).astype(np.int64)
                np.minimum(best, score, out=best)
                up, down, seen = up << one, down << one, eq | minus
                plus = down | ~(seen | up)
                minus = up & seen
        return best


def _starts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, gap: int) -> np.ndarray:
    """Starts of the windows: the words', and the characters of each word from ``gap`` bytes on."""
    more = np.maximum(ends - starts - gap, 0)
    if not more.any():
        return starts
    long = np.flatnonzero(more)
    more = more[long]
    inner = np.repeat(starts[long] + gap - np.cumsum(more) + more, more) + np.arange(more.sum())
    return np.sort(np.concatenate([starts, inner[(data[inner] & 0xC0) != 0x80]]))


class Exact:
    """Short items, searched as they are."""

    def __init__(self, items: list[tuple[object, str]], numbers: list[int]):
        self.automaton = ahocorasick.Automaton()
        found: dict[str, list[int]] = {}
        for (_, text), number in zip(items, numbers):
            found.setdefault(text, []).append(number)
        for text, held in found.items():
            self.automaton.add_word(text, (text, held))
        self.automaton.make_automaton()

    def leaks(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(row, item number, 0, word) of every item that stands in a text of a compacted block."""
        def goes_on(one: str, other: str) -> bool:
            return one.isascii() and one.isalnum() and other.isascii() and other.isalnum()

        bounds = offsets.tolist()
        for row, (low, high) in enumerate(zip(bounds, bounds[1:])):
            text, seen = data[low:high].tobytes().decode(), set()
            for last, (item, numbers) in self.automaton.iter(text):
                start, end = last - len(item) + 1, last + 1
                if item in seen or start and goes_on(text[start - 1], text[start]) or end < len(text) and goes_on(text[last], text[end]):
                    continue
                seen.add(item)
                for number in numbers:
                    yield row, number, 0, text.count(" ", 0, start)


class Block:
    """All that a pass over the documents searches for."""

    def __init__(self, held: list[tuple[object, str]]):
        self.held, self.searches = held, []
        above = None
        for shape in SHAPES:
            of = [n for n, (_, t) in enumerate(held) if shape.least <= len(t) and (above is None or len(t) < above)]
            if of:
                self.searches.append(Index([held[n] for n in of], of, shape))
            above = shape.least
        short = [n for n, (_, t) in enumerate(held) if len(t) < MIN_ITEM]
        if short:
            self.searches.append(Exact([held[n] for n in short], short))

    def leaks(self, data: np.ndarray, offsets: np.ndarray, max_edit: float) -> Iterator[tuple[int, int, int, int]]:
        """(row, item number, distance, word) of one block of texts."""
        data, offsets = arrowtext.compact(data, offsets)
        for search in self.searches:
            if isinstance(search, Exact):
                yield from search.leaks(data, offsets)
            else:
                for row, item, distance, word in _leaks(search, data, offsets, max_edit):
                    yield row, search.numbers[item], distance, word


def _shared(name: str, held: list[tuple[object, str]]) -> Block:
    """The worker's block, kept from task to task; it holds one at a time."""
    return arrowtext.keep(("items", name), lambda: Block(held))


def _leaks(index: Index, data: np.ndarray, offsets: np.ndarray, max_edit: float) -> Iterator[tuple[int, int, int, int]]:
    """(row, item number in the index, distance, word) of one compacted block of texts."""
    starts, ends, first = arrowtext.words(data, offsets)
    windows = _starts(data, starts, ends, index.gap)
    padded = np.concatenate([data, np.zeros(index.walk.steps + 1, np.uint8)])
    # From here on, places are numbers of characters.
    character, last = _characters(data)
    bounds, at = np.searchsorted(character, offsets), np.searchsorted(character, starts)
    rows, number = np.searchsorted(offsets, windows, "right") - 1, np.searchsorted(character, windows)
    slacks = (max_edit * index.size).astype(np.int64)
    found = [np.stack([rows[window], item, number[window] - offset]) for item, window, offset in index.proposals(padded, windows)]
    if not found:
        return
    row, item, begin = np.unique(np.concatenate(found, 1), axis=1)
    # Of the places within one slack of each other, the first one stands for all.
    slack = slacks[item]
    near = begin // np.maximum(slack, 1)
    head = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(item) != 0) | (np.diff(near) != 0)))
    row, item, begin, slack = row[head], item[head], begin[head], slack[head]
    kept = index.possible(last, item, begin, bounds[row], bounds[row + 1], slack)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    reach: dict[tuple[int, int], int] = {}
    for r, n, begin in zip(row[kept].tolist(), item[kept].tolist(), begin[kept].tolist()):
        text = index.items[n][1]
        slack, low, high = int(slacks[n]), int(bounds[r]), int(bounds[r + 1])
        if (r, n) in reach and begin <= reach[r, n]:
            continue  # this place lies in a stretch that has been compared
        left, right = max(low, begin - 2 * slack), min(high, begin + len(text) + 3 * slack)
        distance = edit_distance_within(text, data[character[left] : character[max(left, right)]].tobytes().decode())
        reach[r, n] = begin + slack
        if distance <= slack:
            old = best.get((r, n))
            if old is None or distance < old[0]:
                best[r, n] = distance, int(np.searchsorted(at[first[r] : first[r + 1]], max(begin, low)))
    for (row, item), (distance, word) in best.items():
        yield row, item, distance, word


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text", max_edit: float = MAX_EDIT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item id, distance, item_chars, word): every document and benchmark item that it holds.

    The items are a stated set and documents are searched for them in one narrow pass, without a shuffle. At most
    ``block_chars`` characters of items are held by a task; larger benchmarks are dealt into blocks by the hash of
    id and text and take one pass each.
    """
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField(item_id, items.schema[item_id].dataType),
        T.StructField("distance", T.IntegerType()), T.StructField("item_chars", T.IntegerType()), T.StructField("word", T.IntegerType())])
    arrow = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in schema])
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("t"))
    out = docs.sparkSession.createDataFrame([], schema)
    for held in _blocks(items, item_id, item_text, block_chars):
        out = out.unionByName(source.mapInArrow(_search(held, max_edit, arrow), schema))
    return out


def _blocks(items: DataFrame, item_id: str, item_text: str, block_chars: int) -> Iterator[list[tuple[object, str]]]:
    """The items of every pass over the documents. Blocks are dealt by id and text, so copies of one text under many ids
    spread over them and each block is of bounded size."""
    wanted = items.select(F.col(item_id).alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t")).distinct()
    passes = -(-(wanted.agg(F.sum(F.length("t"))).first()[0] or 0) // block_chars)
    for n in range(passes):
        block = wanted if passes == 1 else wanted.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == n)
        held = sorted(((r["i"], _normal(r["t"])) for r in block.collect()), key=lambda x: (x[1], str(x[0])))
        held = [x for x in held if len(x[1]) >= LEAST_EXACT]
        if held:
            yield held


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _search(held, max_edit, arrow):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _shared(name, held)
        for batch in batches:
            ids = batch.column(0)
            columns: list[list] = [[], [], [], [], []]
            for row, data, offsets in arrowtext.blocks(batch.column(1)):
                for r, item, distance, word in block.leaks(data, offsets, max_edit):
                    for column, value in zip(columns, (ids[row + r].as_py(), held[item][0], distance, len(held[item][1]), word)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return run


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
          max_edit: float = MAX_EDIT, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item, in one narrow pass for each block of items; columns stay as they are."""
    at = docs.columns.index(text_col)

    def without(held: list):
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = _shared(name, held)
            for batch in batches:
                kept = np.ones(batch.num_rows, bool)
                for row, data, offsets in arrowtext.blocks(batch.column(at)):
                    for r, _, _, _ in block.leaks(data, offsets, max_edit):
                        kept[row + r] = False
                yield batch.filter(pa.array(kept))

        return run

    for n, held in enumerate(_blocks(items, item_id, item_text, block_chars)):
        if n:  # the pass before ends here, so a worker holds one block at a time
            docs = materialise(docs, "clean")
        docs = docs.mapInArrow(without(held), docs.schema)
    return docs
