"""Alignment of two tokenizers over the same bytes, with an associative fragment monoid.

A text with a space before it is encoded by tokenizer A (byte-level BPE) and, with the space that it adds itself, by tokenizer B
(pieces with byte fallback). Byte offsets where tokens of both end cut the tokens into groups; an A and a B token whose bytes overlap are linked.

A *fragment* is what is known of a byte range: open tokens before its first common end (``head``), whole groups between the first and the last
one (``closed``), and open tokens behind (``tail``). Two neighbours compose by aligning the open tokens that meet; this is
associative, so fragments may be composed in any tree. Texts over ``CHUNK`` characters are cut into chunks, encoded by
different tasks, and their fragments are composed level by level, ``FAN`` at a time. A chunk of A starts where a run of white space starts,
a chunk of B where a run of spaces starts, as no token of either reaches across such a place from the left; the two
places of a cut may differ, and the fragments then meet in open tokens. Text without such a place stays in one chunk, so memory follows
the longest text without white space while it is encoded, and the longest text's group text at the root.

A pair's count is the number of documents that hold the pair linked. Documents keep their distinct pairs; pairs are counted with
map-side combination. The counts come back to the documents in two ways that together cover every pair: the most
frequent pairs, ``HOT_PAIRS`` at most, are broadcast, and the others, none of which is in many documents, are joined by shuffle.

Null and empty texts, and texts whose tokens do not give back their bytes, have no tokens. Strings of special tokens are plain text.
Repeated rows each count as a document of their own; an empty table gives an empty one; other columns are not read. Links of equal
count are all best. Ids of tokens are written in decimal.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.session import materialise

CHUNK = 1 << 18
FAN = 8
HOT_PAIRS = 1 << 20
#: Characters of the texts that are encoded at a time.
BLOCK = 1 << 19

# What comes before a cut is never white space in any reading: the last two are white space in some.
_CUT_A = regex.compile(r"(?<=[^\s\x1c-\x1f\x85᠎▁])[\t\n\x0b\x0c\r ]")
_CUT_B = regex.compile(r"(?<=[^\s\x1c-\x1f\x85᠎▁]) (?=[^\s\x1c-\x1f\x85᠎▁])")


class Encoders:
    """Both tokenizers, with the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}  # byte symbols that stand for themselves
        rest = iter(range(256, 512))
        symbol = {chr(b) if b in plain else chr(next(rest)): b for b in range(256)}
        names = spec["model"]["vocab"]
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, n in names.items():
            if all(c in symbol for c in name):  # special tokens need no bytes
                self.bytes_a[n] = bytes(symbol[c] for c in name)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(n) for n in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)]
        #: Whether no piece goes from other characters on into a space, so that B may be cut there.
        self.cuts = all("▁" not in p.lstrip("▁") for p in pieces)
        #: Byte symbols for all bytes and no normaliser: tokens of A always give back their text's bytes.
        self.exact_a = spec.get("normalizer") is None and all(s in names for s in symbol)
        self.size_a, self.size_b = (np.array([len(x) for x in xs], np.int64) for xs in (self.bytes_a, self.bytes_b))

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """``texts`` lack the leading space, which the tokenizer adds."""
        return self.b.encode(texts, out_type=int, num_threads=1)

    def restores(self, a: list[int], raw_a: bytes, b: list[int], raw_b: bytes) -> bool:
        """Whether the tokens give back the bytes that they stand for."""
        if b"".join([self.bytes_b[n] for n in b]) != raw_b:
            return False
        return self.exact_a or b"".join([self.bytes_a[n] for n in a]) == raw_a


@lru_cache(2)
def encoders(path_a: str, path_b: str) -> Encoders:
    """The worker's tokenizers, kept from task to task."""
    return Encoders(path_a, path_b)


@dataclass
class Tokens:
    """Tokens of A and B in order, with the byte at which each ends."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([x, y]) for x, y in zip(self.parts(), other.parts())))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_end, self.b, self.b_end

    def split(self, end: int) -> tuple[Tokens, Tokens]:
        """Those that end at ``end`` at the latest, and the others."""
        i, j = np.searchsorted(self.a_end, end, "right"), np.searchsorted(self.b_end, end, "right")
        return Tokens(self.a[:i], self.a_end[:i], self.b[:j], self.b_end[:j]), Tokens(self.a[i:], self.a_end[i:], self.b[j:], self.b_end[j:])

    def common_ends(self) -> np.ndarray:
        return self.a_end[np.isin(self.a_end, self.b_end, assume_unique=True)]


EMPTY = Tokens(*[np.zeros(0, np.int64)] * 4)


@dataclass
class Closed:
    """Whole groups: their text ``a1,a2|b1;...;``, their numbers, and their distinct linked pairs with the links of each."""

    text: bytes
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    pairs: np.ndarray
    links: np.ndarray

    def __add__(self, other: Closed) -> Closed:
        pairs, at = np.unique(np.concatenate([self.pairs, other.pairs]), return_inverse=True)
        links = np.bincount(at, np.concatenate([self.links, other.links]), len(pairs)).astype(np.int64)
        return Closed(self.text + other.text, self.n_a + other.n_a, self.n_b + other.n_b, self.n_groups + other.n_groups,
                      self.n_links + other.n_links, pairs, links)


@dataclass
class Fragment:
    """What a byte range says: ``closed`` is None if no common end was seen, and ``head`` then holds all its tokens."""

    head: Tokens
    closed: Closed | None = None
    tail: Tokens | None = None

    def __add__(self, other: Fragment) -> Fragment:
        middle = fragment((self.head if self.closed is None else self.tail) + other.head)
        if middle.closed is None:  # no common end in what was open, so the right one has none either
            return middle if self.closed is None else Fragment(self.head, self.closed, middle.head)
        head, closed, tail = middle.head, middle.closed, middle.tail
        if self.closed is not None:
            head, closed = self.head, self.closed + groups(middle.head) + closed
        if other.closed is not None:  # its head ended at a common end, so nothing is open before its groups
            closed, tail = closed + other.closed, other.tail
        return Fragment(head, closed, tail)

    def finish(self) -> Closed:
        """The groups of a whole text, whose start and end are common ends."""
        return groups(EMPTY) if self.closed is None else groups(self.head) + self.closed


def fragment(tokens: Tokens) -> Fragment:
    ends = tokens.common_ends()
    if not len(ends):
        return Fragment(tokens)
    head, rest = tokens.split(ends[0])
    closed, tail = rest.split(ends[-1])
    return Fragment(head, groups(closed), tail)


def groups(tokens: Tokens) -> Closed:
    """Groups of tokens that start and end at common ends."""
    whole = Aligned(tokens, np.array([tokens.a_end[-1]]) if len(tokens.a_end) else np.zeros(0, np.int64))
    if not len(whole.ends):
        return Closed(b"", 0, 0, 0, 0, EMPTY.a, EMPTY.a)
    return whole.closed(0)


_SHIFT = 32


@lru_cache(4)
def _decimals(size: int) -> np.ndarray:
    """The decimal digits of 0 to ``size - 1`` as bytes, zero bytes in front, with room for a mark behind."""
    width = len(str(size - 1))
    value = np.arange(size, dtype=np.int64)[:, None]
    power = 10 ** np.arange(width - 1, -1, -1, dtype=np.int64)
    out = np.zeros((size, width + 1), np.uint8)
    out[:, :width] = np.where((value >= power) | (power == 1), value // power % 10 + ord("0"), 0)
    return out


class Aligned:
    """Many texts aligned at once: tokens one after the other, ``ends`` the last byte of each text, in order."""

    def __init__(self, tokens: Tokens, ends: np.ndarray):
        base = min(tokens.a_end[0], tokens.b_end[0]) if len(tokens.a) and len(tokens.b) else 0
        last = max(tokens.a_end[-1], tokens.b_end[-1]) if len(tokens.a) and len(tokens.b) else -1
        flag = np.zeros(last - base + 1, np.uint8)
        flag[tokens.a_end - base] = 1
        flag[tokens.b_end - base] += 2
        at = np.flatnonzero(flag)
        flag = flag[at]
        is_a, is_b, is_common = (flag & 1).astype(bool), flag > 1, flag == 3
        upto_a, upto_b, upto = np.cumsum(is_a), np.cumsum(is_b), np.cumsum(is_common)
        self.ends = ends
        bound = np.append(0, np.searchsorted(at, ends - base, "right"))
        #: Per text: tokens of A, of B, groups and links before its end.
        self.a_bound, self.b_bound, self.group_bound = (np.append(0, x)[bound] for x in (upto_a, upto_b, upto))
        self.link_bound = bound
        # Between two neighbouring ends lies the overlap of exactly one token of A and one of B.
        a, b = tokens.a[upto_a - is_a], tokens.b[upto_b - is_b]
        row = np.repeat(np.arange(len(ends)), np.diff(bound))
        bits = [max(1, int(x.max(initial=0)).bit_length()) for x in (row, a, b)]
        if sum(bits) > 63:
            raise ValueError("token ids are too large")
        key = np.sort(row << (bits[1] + bits[2]) | a << bits[2] | b)
        heads = np.flatnonzero(np.append(np.ones(min(1, len(key)), bool), key[1:] != key[:-1]))
        self.links, key = np.diff(np.append(heads, len(key))), key[heads]
        self.pairs = (key >> bits[2] & ((1 << bits[1]) - 1)) << _SHIFT | key & ((1 << bits[2]) - 1)
        self.pair_bound = np.searchsorted(key, np.arange(len(ends) + 1) << (bits[1] + bits[2]))
        # The groups as text: all tokens of A of a group, then those of B.
        group = upto - is_common
        a_upto, b_upto = np.append(0, upto_a[is_common]), np.append(0, upto_b[is_common])
        a_place, b_place = np.arange(len(tokens.a)) + b_upto[group[is_a]], np.arange(len(tokens.b)) + a_upto[group[is_b] + 1]
        value = np.empty(len(tokens.a) + len(tokens.b), np.int64)
        value[a_place], value[b_place] = tokens.a, tokens.b
        shown = _decimals(1 << int(value.max(initial=1)).bit_length())[value]
        shown[:, -1] = ord(",")
        shown[a_place[a_upto[1:] - 1], -1] = ord("|")
        shown[b_place[b_upto[1:] - 1], -1] = ord(";")
        size = np.append(0, np.cumsum(np.count_nonzero(shown, axis=1)))
        shown = shown.ravel()
        self.text, self.text_bound = shown[shown > 0].tobytes(), size[self.a_bound + self.b_bound]

    def columns(self, digests: bool) -> list[pa.Array]:
        """The result columns of all texts."""
        bounds = self.text_bound.tolist()
        texts = [self.text[low:high] for low, high in zip(bounds, bounds[1:])]
        lists = [pa.ListArray.from_arrays(pa.array(self.pair_bound.astype(np.int32)), pa.array(x.astype(np.int64))) for x in (self.pairs, self.links)]
        counts = [pa.array(np.diff(x).astype(np.int64)) for x in (self.a_bound, self.b_bound, self.group_bound, self.link_bound)]
        return [pa.array([digest(t) for t in texts], pa.string()) if digests else pa.array(texts, pa.binary()), *counts, *lists]

    def closed(self, n: int) -> Closed:
        counts = [int(x[n + 1] - x[n]) for x in (self.a_bound, self.b_bound, self.group_bound, self.link_bound)]
        low, high = self.pair_bound[n], self.pair_bound[n + 1]
        return Closed(self.text[self.text_bound[n] : self.text_bound[n + 1]], *counts, self.pairs[low:high], self.links[low:high])


def _tokens(ids_a: list[list[int]], ids_b: list[list[int]], enc: Encoders, start_a: int = 0, start_b: int = 0) -> Tokens:
    a, b = (np.array(list(chain.from_iterable(x)), np.int64) for x in (ids_a, ids_b))
    return Tokens(a, start_a + np.cumsum(enc.size_a[a]), b, start_b + np.cumsum(enc.size_b[b]))


def align_texts(texts: list[str | None], enc: Encoders) -> Aligned:
    """Whole texts, all aligned in one go."""
    raw = [" " + (t or "") for t in texts]
    ids_a, ids_b = enc.encode_a(raw), enc.encode_b([t or "" for t in texts])
    sizes = np.zeros(len(texts), np.int64)
    for n, (text, a, b) in enumerate(zip(raw, ids_a, ids_b)):
        written = text.encode()
        if len(text) > 1 and enc.restores(a, written, b, written):
            sizes[n] = len(written)
        else:
            ids_a[n], ids_b[n] = [], []
    return Aligned(_tokens(ids_a, ids_b, enc), np.cumsum(sizes))


def cuts(text: str, size: int, enc: Encoders) -> list[tuple[int, int]]:
    """Places of ``text`` (which starts with its space) where chunks of A and B start, the first one included and the end not."""
    out, at = [(0, 0)], size
    while enc.cuts and at < len(text):
        b = _CUT_B.search(text, at)
        if b is None:
            break
        a = _CUT_A.search(text, at)
        out.append((a.start(), b.start()))
        at = max(at + size, b.start() + 1)
    return out


def chunk_fragment(text: str, a: tuple[int, int], b: tuple[int, int], start: int, enc: Encoders) -> Fragment | None:
    """The fragment of one chunk: ``text[slice(*a)]`` for A and ``text[slice(*b)]`` for B, where ``text`` starts at byte ``start``. None if the
    tokens do not give back their bytes."""
    part_a, part_b = text[slice(*a)], text[slice(*b)]
    ids_a, ids_b = enc.encode_a([part_a]), enc.encode_b([part_b[1:]])
    if not enc.restores(ids_a[0], part_a.encode(), ids_b[0], part_b.encode()):
        return None
    return fragment(_tokens(ids_a, ids_b, enc, start + len(text[: a[0]].encode()), start + len(text[: b[0]].encode())))


_CLOSED = [("groups", T.BinaryType()), ("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()),
           ("pairs", T.ArrayType(T.LongType())), ("links", T.ArrayType(T.LongType()))]
_OPEN = [f"{part}_{name}" for part in ("head", "tail") for name in ("a", "a_end", "b", "b_end")]


def digest(text: bytes) -> str:
    """What names the groups of a text: the hash of their text without its last mark, or nothing if there are none."""
    return hashlib.sha256(text[:-1]).hexdigest() if text else ""


def _closed_row(c: Closed) -> list:
    return [c.text, c.n_a, c.n_b, c.n_groups, c.n_links, c.pairs, c.links]


def _record(columns: list[list], kept: list[pa.Array], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type

    made = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema.fields[len(kept) :])]
    return pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` characters."""
    low, held = 0, 0
    for n, size in enumerate(sizes):
        if n > low and held + size > most:
            yield low, n
            low, held = n, 0
        held += size
    if low < len(sizes):
        yield low, len(sizes)


def _whole(path_a: str, path_b: str, schema: T.StructType, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoders(path_a, path_b)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in _slices([len(t or "") for t in texts], BLOCK):
                columns = align_texts(texts[low:high], enc).columns(digests)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *columns], names=schema.names)

    return run


def _cut(path_a: str, path_b: str, schema: T.StructType, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoders(path_a, path_b)
        for batch in batches:
            for row in range(batch.num_rows):
                text, key = " " + batch.column(1)[row].as_py(), uuid.uuid4().hex
                places = [*cuts(text, size, enc), (len(text), len(text))]
                start, at = 0, 0
                for n, (here, after) in enumerate(zip(places[:-1], places[1:])):
                    low, high = min(here), max(after)
                    start, at = start + len(text[at:low].encode()), low
                    bounds = [here[0] - low, after[0] - low, here[1] - low, after[1] - low]
                    yield _record([[key], [n], [text[low:high]], [start], [bounds]], [batch.column(0).slice(row, 1)], schema)

    return run


def _fragments(path_a: str, path_b: str, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoders(path_a, path_b)
        for batch in batches:
            for row in range(batch.num_rows):
                text, start, bounds = (batch.column(c)[row].as_py() for c in ("chunk", "start", "bounds"))
                found = chunk_fragment(text, tuple(bounds[:2]), tuple(bounds[2:]), start, enc)
                yield _fragment_record(found, [batch.column(c).slice(row, 1) for c in ("d", "key", "n")], schema)

    return run


def _fragment_record(found: Fragment | None, kept: list[pa.Array], schema: T.StructType) -> pa.RecordBatch:
    closed = [None] * len(_CLOSED) if found is None or found.closed is None else _closed_row(found.closed)
    opened = [None] * 8 if found is None else [*found.head.parts(), *(found.tail or EMPTY).parts()]
    return _record([[found is not None], *[[x] for x in closed], *[[x] for x in opened]], kept, schema)


def _fragment_of(row: dict) -> Fragment:
    opened = [np.array(row[c], np.int64) for c in _OPEN]
    if row["n_a"] is None:
        return Fragment(Tokens(*opened[:4]))
    closed = Closed(*[np.array(row[c], np.int64) if c in ("pairs", "links") else row[c] for c, _ in _CLOSED])
    return Fragment(Tokens(*opened[:4]), closed, Tokens(*opened[4:]))


def _compose(schema: T.StructType):
    def run(held: pa.Table) -> pa.Table:
        rows = sorted(held.to_pylist(), key=lambda r: r["n"])
        total = None
        if all(r["whole"] for r in rows):
            total = _fragment_of(rows[0])
            for r in rows[1:]:
                total = total + _fragment_of(r)
        first = held.slice(0, 1).combine_chunks()
        kept = [first.column("d").chunk(0), first.column("key").chunk(0), pa.array([rows[0]["n"] // FAN], pa.int32())]
        return pa.Table.from_batches([_fragment_record(total, kept, schema)])

    return run


def _finish(schema: T.StructType, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, values in enumerate(batch.to_pylist()):
                found = _fragment_of(values).finish() if values["whole"] else groups(EMPTY)
                first = digest(found.text) if digests else found.text
                yield _record([[x] for x in (first, *_closed_row(found)[1:])], [batch.column("d").slice(row, 1)], schema)

    return run


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, digests: bool = False) -> DataFrame:
    """(d, groups, n_a, n_b, n_groups, n_links, pairs, links) of each document; ``groups`` is the text ``a1,a2|b1;a3|b2,b3;``, ``pairs``
    its distinct linked ids as ``a << 32 | b``, ``links`` how often each is linked. With ``digests``, ``groups_sha256`` stands in place of ``groups``."""
    source = docs.select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("t"))
    kind = docs.schema[id_col].dataType
    named = T.StructField("d", kind)
    parts_schema = [T.StructField(n, t) for n, t in _CLOSED]
    schema = T.StructType([named, T.StructField("groups_sha256", T.StringType()) if digests else parts_schema[0], *parts_schema[1:]])
    is_long = F.coalesce(F.char_length("t") > chunk, F.lit(False))
    short = source.where(~is_long).mapInArrow(_whole(path_a, path_b, schema, digests), schema)
    chunk_schema = T.StructType([named, T.StructField("key", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("chunk", T.StringType()),
                                 T.StructField("start", T.LongType()), T.StructField("bounds", T.ArrayType(T.IntegerType()))])
    # Written once, as a second run would name the texts anew.
    chunks = materialise(source.where(is_long).mapInArrow(_cut(path_a, path_b, chunk_schema, chunk), chunk_schema), "chunks")
    most = (chunks.agg(F.max("n")).first()[0] or 0) + 1
    held = T.StructType([named, *chunk_schema.fields[1:3], T.StructField("whole", T.BooleanType()), *parts_schema,
                         *[T.StructField(c, T.ArrayType(T.LongType())) for c in _OPEN]])
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = chunks.repartition(tasks, "key", "n").mapInArrow(_fragments(path_a, path_b, held), held)
    while most > 1:
        parts = parts.groupBy("key", F.floor(F.col("n") / FAN)).applyInArrow(_compose(held), held)
        most = -(-most // FAN)
    return short.unionByName(parts.mapInArrow(_finish(schema, digests), schema))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs, is_best): in how many documents each pair is linked, and whether that is the most of all pairs of its A id."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    best = F.max("docs").over(Window.partitionBy(F.shiftright("pair", _SHIFT)))
    return counts.withColumn("is_best", F.col("docs") == best)


def align_and_count(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
                    hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each document."""
    aligned = align(docs, path_a, path_b, id_col, text_col, chunk, digests=True)
    rows = materialise(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = materialise(pair_counts(rows), "pairs")
    linked = rows.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("links").alias("links"))))
    # Counts are put into classes of an eighth of a power of two; whole classes are broadcast while they fit.
    size = F.floor(8 * F.log2(F.col("docs"))).cast("int")
    least, total = None, 0
    for r in counts.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect():  # some hundred classes
        if total + r["count"] > hot_pairs:
            break
        least, total = r["size"], total + r["count"]
    hot = counts.where(size >= F.lit(least)) if least is not None else counts.limit(0)
    found = linked.join(F.broadcast(hot), "pair")
    if total < counts.count():
        cold = counts.where(size < F.lit(least)) if least is not None else counts
        found = found.unionByName(linked.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(cold, "pair"))
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("docs")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "links").join(sums, "row", "left").select(
        F.col("d").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
