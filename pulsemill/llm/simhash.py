"""SimHash near-duplicates: fingerprints, BK-trees per shard, connected components.

Fingerprints within three bits of each other agree in one of four 16-bit blocks and, of the other 48 bits, in one of four
12-bit parts. The sixteen (block, part) values of a fingerprint are its keys; all links of a fingerprint lie in the
shards of its keys. A shard's BK-tree holds children by their Hamming distance to the parent, and a search follows only
the edges within the radius. Trees are built where the rows of their shard are dealt to, so nothing is collected: a key with
more than ``SHARD`` fingerprints is dealt to several shards, and each of its fingerprints also searches the others'
trees. A shard gives a spanning forest of its links, never all pairs.

A text without words (also a null or empty one) has the fingerprint zero and is linked like any other. Repeated rows and
exact copies share one fingerprint, which is searched once. Rows without an id take part; a component's id is the
smallest id in it (null if none has one). Columns other than the id and the text are not read. An empty table gives no rows. Very long
texts are hashed whole, one by itself.

``similar_texts`` is for near copies by Jaccard similarity, which lie further apart than any radius that keys can serve.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.llm import arrowtext
from pulsemill.llm.components import connected_components
from pulsemill.operators.ranges import broadcast_if_small
from pulsemill.session import materialise

RADIUS = 3
SHINGLE = 3
SHARD = 4096
_VOTES = 1 << 15
#: Word shingles, similarity and samples of ``similar_texts``.
SIMILAR_SHINGLE = 5
SIMILARITY = 0.8
SAMPLES, SAMPLE = 16, 6
#: Rounds in which neighbouring components of a group are compared before the rest is.
ROUNDS = 2
#: Shingles of a block of texts that is compared with another one.
BLOCK = 1 << 17
_SIGNATURE = 64
#: Bytes of text that a pass over the documents takes at a time.
_BLOCK = 1 << 18
#: Texts with so many shingles are compared by their signatures first, at the similarity less four standard errors.
_ESTIMATED, _SLACK = 256, 0.2
#: Ids that are broadcast, as text; more are joined by shuffle.
DROPPED_BYTES = 16 << 20


def _fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _VOTES):
        part = hashes[at : at + _VOTES].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def _shingle_hashes(text: bytes, starts: list[int], ends: list[int], size: int) -> np.ndarray:
    if len(starts) < size:
        return np.array([xxhash.xxh64_intdigest(text[starts[0] : ends[-1]], 42)], np.uint64)
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(text[a:b], 42) for a, b in zip(starts, ends[size - 1 :])], np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the 64-bit SimHash of the whole text's word shingles, as a signed long."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, np.uint64)
            for row, data, offsets in arrowtext.blocks(batch.column(1)):
                data, offsets = arrowtext.compact(data, offsets)
                starts, ends, first = arrowtext.words(data, offsets)
                text, starts, ends = data.tobytes(), starts.tolist(), ends.tolist()
                for i in np.flatnonzero(np.diff(first)).tolist():
                    a, b = int(first[i]), int(first[i + 1])
                    found[row + i] = _fingerprint(_shingle_hashes(text, starts[a:b], ends[a:b], shingle))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[id_col, "fp"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema)


def keys(fp: Column) -> Column:
    """The sixteen keys of a fingerprint: number of the key, its 16-bit block, a 12-bit part of the other bits."""
    block = [F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    out = []
    for i in range(4):
        a, b, c = (block[j] for j in range(4) if j != i)
        rest = a.bitwiseOR(F.shiftleft(b, 16)).bitwiseOR(F.shiftleft(c, 32))
        for j in range(4):
            part = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            out.append(F.lit((4 * i + j) << 28).cast("long").bitwiseOR(F.shiftleft(block[i], 12)).bitwiseOR(part))
    return F.array(*out)


class BKTree:
    """Values in a tree whose edges carry the Hamming distance of child and parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """Insert a value; its number."""
        own, at = len(self.values), 0
        self.values.append(value)
        self.children.append({})
        while own:
            edge = (value ^ self.values[at]).bit_count()
            if edge not in self.children[at]:
                self.children[at][edge] = own
                break
            at = self.children[at][edge]
        return own

    def within(self, value: int, radius: int) -> list[int]:
        """Numbers of the values within the radius."""
        found, stack = [], [0] if self.values else []
        values, children = self.values, self.children
        while stack:
            at = stack.pop()
            distance = (value ^ values[at]).bit_count()
            if distance <= radius:
                found.append(at)
            for edge, child in children[at].items():
                if -radius <= edge - distance <= radius:
                    stack.append(child)
        return found


class Shard:
    """A shard's tree and the components of its values. Its own fingerprints come first, then the guests stream through, so
    memory is bounded by the shard however many guests a hot key sends."""

    def __init__(self, radius: int) -> None:
        self.tree, self.root, self.radius = BKTree(), [], radius

    def _top(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def feed(self, value: int, guest: bool) -> list[tuple[int, int]]:
        """Links from ``value`` to one member of each component it meets; these are one component from then on."""
        found, own, links = self.tree.within(value, self.radius), None, []
        if not guest:
            own = self.tree.add(value)
            self.root.append(own)
        for i in found:
            top = self._top(i)
            if top != own:
                links.append((value, self.tree.values[top]))
                if own is None:
                    own = top
                self.root[top] = own
        return links


def _shards(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, Shard(radius)
        for batch in batches:
            key, part, guest, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            # The groups at both ends of a batch may go on in the next one; between them, a single row has no link.
            new = np.zeros(len(key) + 1, bool)
            new[1:-1] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
            rows = np.flatnonzero(~(new[:-1] & new[1:]))
            pairs = []
            for k, p, g, value in zip(*(x[rows].tolist() for x in (key, part, guest, fp.view(np.uint64)))):
                if (k, p) != at:
                    at, shard = (k, p), Shard(radius)
                pairs += shard.feed(value, bool(g))
            found = np.array(pairs, np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, i].view(np.int64)) for i in range(2)], names=["u", "v"])

    return run


def links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that span every component of those within the radius."""
    if not 0 <= radius <= 3:
        raise ValueError("four blocks and four parts find links of at most three bits")
    dealt = distinct.select("fp", F.explode(keys(F.col("fp"))).alias("key"))
    hot = materialise(dealt.groupBy("key").count().where(F.col("count") > shard).select("key", F.ceil(F.col("count") / shard).alias("n")), "hot-keys")
    few = hot.count() <= 100_000
    dealt = dealt.join(F.broadcast(hot) if few else hot, "key", "left").select(
        "key", "fp", F.coalesce("n", F.lit(1)).cast("long").alias("n"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n")))
    rows = dealt.select("key", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("shard")).select(
        "key", "shard", (F.col("own") != F.col("shard")).cast("byte").alias("guest"), "fp")
    return rows.repartition("key", "shard").sortWithinPartitions("key", "shard", "guest", "fp").mapInArrow(_shards(radius), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                    shingle: int = SHINGLE, shard: int = SHARD) -> DataFrame:
    """(id, fingerprint, component_id): every row with the smallest id that its links reach."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct-fingerprints")
    found = connected_components(links(distinct, radius, shard))
    rooted = distinct.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the row whose id is the component's. Rows without an id stay, and ids are taken
    to name a document: rows that share an id stay or go together."""
    found = near_duplicates(docs.where(F.col(id_col).isNotNull()), id_col, text_col, **options)
    return _without(docs, id_col, found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("c")))


def _without(docs: DataFrame, id_col: str, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id is in ``dropped(c)``; their texts are only shuffled if the ids are too many to broadcast."""
    named = f"dropped_{uuid.uuid4().hex}"
    dropped = materialise(dropped.distinct().withColumnRenamed("c", named), "dropped")
    return docs.join(broadcast_if_small(dropped, DROPPED_BYTES), F.col(id_col) == F.col(named), "left_anti")


def _shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row) of the distinct word shingles of a block, rows and hashes ascending, and a hash of each row's words. A shorter
    text has one shingle, its words; a text without words none."""
    data, offsets = arrowtext.compact(data, offsets)
    starts, ends, first = arrowtext.words(data, offsets)
    words, n = arrowtext.word_hashes(data, starts, ends), np.diff(first)
    row = np.repeat(np.arange(len(n)), np.where(n > 0, np.maximum(1, n - size + 1), 0))
    begin = first[row] + np.arange(len(row)) - np.searchsorted(row, row, "left")
    hashes = arrowtext.run_hashes(words, begin, np.minimum(begin + size, first[row + 1]))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.append(np.ones(min(1, len(row)), bool), (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))
    return hashes[new], row[new], arrowtext.run_hashes(words, first[:-1], first[1:])


def _majority(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The SimHash of each run of hashes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    out, bounds = np.empty(len(starts), np.uint64), np.append(starts, len(hashes))
    if np.diff(bounds).max() > _VOTES:  # a very long text by itself
        return np.array([_fingerprint(hashes[low:high]) for low, high in zip(bounds, bounds[1:])], np.uint64)
    # Runs are taken some at a time, as a hash becomes 64 counters.
    step = np.searchsorted(bounds, np.arange(0, len(hashes), _VOTES), "right") - 1
    for low, high in zip(np.unique(step), [*np.unique(step)[1:], len(starts)]):
        part = hashes[bounds[low] : bounds[high]].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes = np.add.reduceat(np.unpackbits(part, axis=1, bitorder="little"), bounds[low:high] - bounds[low], axis=0, dtype=np.int32)
        out[low:high] = np.packbits(2 * votes > np.diff(bounds[low : high + 1])[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def _sketches(size: int, samples: int, sample: int, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrowtext.held.clear()
        for batch in batches:
            for at, data, offsets in arrowtext.blocks(batch.column(1), _BLOCK):
                hashes, row, words = _shingles(data, offsets, size)
                rows = np.arange(len(words))
                bounds = np.searchsorted(row, np.arange(len(rows) + 1))
                filled = np.flatnonzero(np.diff(bounds))
                prints = np.zeros(len(rows), np.uint64)
                prints[filled] = _majority(hashes, bounds[filled])
                # The least hashes of each part of the hash range are the same in two texts unless one of them differs.
                part = (hashes >> np.uint64(32)) * np.uint64(samples) >> np.uint64(32)
                slot = row * samples + part.astype(np.int64)
                taken = np.flatnonzero(np.arange(len(slot)) - np.searchsorted(slot, slot, "left") < sample)
                slot = slot[taken]
                heads = np.flatnonzero(np.append(np.ones(min(1, len(slot)), bool), slot[1:] != slot[:-1]))
                views, slot = _majority(hashes[taken], heads), slot[heads]
                # The part's number is mixed in, so that one column names both.
                views = arrowtext.mix(views ^ arrowtext.mix((slot % samples).astype(np.uint64) + np.uint64(1)))
                ends = pa.array(np.searchsorted(slot, np.arange(len(rows) + 1) * samples).astype(np.int32))
                # The least hash of each of 64 parts of another order, as a signature that estimates the similarity.
                other = arrowtext.mix(hashes)
                least = np.full((len(rows), _SIGNATURE), np.iinfo(np.int32).max, np.int32)
                np.minimum.at(least, (row, (other & np.uint64(_SIGNATURE - 1)).astype(np.int64)), (other >> np.uint64(33)).astype(np.int32))
                signature = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * _SIGNATURE), pa.array(least.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(rows)), pa.array(words.view(np.int64)), pa.array(np.diff(bounds)), pa.array(prints.view(np.int64)),
                     pa.ListArray.from_arrays(ends, pa.array(views.view(np.int64))), signature], names=schema.names)

    return run


def _sets(size: int, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in arrowtext.blocks(batch.column(1), _BLOCK):
                hashes, row, _ = _shingles(data, offsets, size)
                bounds = np.searchsorted(row, np.arange(len(offsets))).tolist()
                sets = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), sets], names=schema.names)

    return run


def _blocks(similarity: float, schema: T.StructType):
    """One near pair (u, v) of any two components that meet in two blocks, from rows sorted by (view, low, high)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in (b for b in batches if b.num_rows):
            view, low, high = (batch.column(i).to_numpy() for i in range(3))
            heads = np.flatnonzero(np.append(True, (np.diff(view) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)))
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), batch.num_rows]):
                if held and (view[a], low[a], high[a]) != at:
                    yield _near(held, at[1] == at[2], similarity, schema)
                    held = []
                at = view[a], low[a], high[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield _near(held, at[1] == at[2], similarity, schema)

    return run


def _near(held: list[pa.RecordBatch], is_one: bool, similarity: float, schema: T.StructType) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held).combine_chunks()
    name, sets = rows.column("c").chunk(0), rows.column("set").chunk(0)
    root = rows.column("root").chunk(0).dictionary_encode().indices.to_numpy()
    n = np.diff(sets.offsets.to_numpy())
    row = np.repeat(np.arange(len(n)), n)
    # Shingles of two texts and more are the columns of a table of bits.
    _, code, holders = np.unique(sets.flatten().to_numpy().view(np.uint64), return_inverse=True, return_counts=True)
    shared = holders[code] > 1
    row, code = row[shared], (np.cumsum(holders > 1) - 1)[code[shared]]
    words = int(code.max(initial=0)) // 64 + 1
    bits = np.zeros(len(n) * words, np.uint64)
    place = row * words + code // 64
    if len(place):
        heads = np.flatnonzero(np.append(True, np.diff(place) != 0))
        bits[place[heads]] = np.bitwise_or.reduceat(np.uint64(1) << (code % 64).astype(np.uint64), heads)
    bits = bits.reshape(len(n), words)
    is_left = rows.column("is_left").chunk(0).to_numpy(zero_copy_only=False)
    right = np.arange(len(n)) if is_one else np.flatnonzero(~is_left)
    pairs, met = [], set()
    for a in (range(len(n)) if is_one else np.flatnonzero(is_left).tolist()):
        others = right[(root[right] != root[a]) & ((right > a) if is_one else True)]
        # More than this share of the larger set cannot be common.
        others = others[np.minimum(n[others], n[a]) >= similarity * np.maximum(n[others], n[a])]
        common = np.bitwise_count(bits[a] & bits[others]).sum(1, dtype=np.int64)
        for b in others[common >= similarity * (n[a] + n[others] - common)].tolist():
            if (root[a], root[b]) not in met:
                met |= {(root[a], root[b]), (root[b], root[a])}
                pairs.append((a, b))
    u, v = np.array(pairs, np.int64).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([name.take(pa.array(x)) for x in (u, v)], schema=pa.schema([(f, name.type) for f in schema.names]))


def similar_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SIMILAR_SHINGLE, similarity: float = SIMILARITY,
                  samples: int = SAMPLES, sample: int = SAMPLE, radius: int = RADIUS, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(id, component_id): every named row with the smallest id that links of Jaccard ``similarity`` and more reach.

    At a similarity of 0.8 whole-text fingerprints differ in some ten bits, which no set of keys finds at scale. So besides fingerprints within
    ``radius`` bits (the BK-trees above), pairs are proposed whose SimHash of a consistent sample is equal: the least ``sample`` shingles
    of each of ``samples`` parts of the hash range. Two texts of similarity J agree in a part with probability J ** sample, so one of sixteen
    parts of six agrees in 99 % of the pairs at 0.8. Each text is proposed with the first text of its group; then, in ``ROUNDS`` rounds, one text of each
    least neighbour in a group with those of the next two. Sizes and a signature of 64 least hashes leave out what is hardly near, and the exact Jaccard similarity of
    the distinct shingles decides. In groups that are not one component then, all pairs of different components are compared exactly, whatever the signatures
    estimate: in blocks of some ``block`` shingles, so that no task holds a group. So no pair that a group proposes is lost; the work is quadratic only in groups of texts
    that are not near. Equal word sequences are one text; texts without words are equal.
    """
    kind = docs.schema[id_col].dataType
    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    schema = T.StructType([T.StructField("i", kind), *[T.StructField(c, T.LongType()) for c in ("words", "n", "fp")],
                           T.StructField("views", T.ArrayType(T.LongType())), T.StructField("signature", T.ArrayType(T.IntegerType()))])
    spark = docs.sparkSession
    with arrowtext.small_batches(spark):
        sketches = materialise(named.mapInArrow(_sketches(shingle, samples, sample, schema), schema), "sketches")
    text = ["words", "n", "fp"]
    classes = materialise(sketches.groupBy(*text).agg(
        F.min("i").alias("c"), F.first("views").alias("views"), F.first("signature").alias("signature")), "classes")

    # More than this share of the larger set cannot be common, so a long text never goes to many short ones.
    sizes = F.least("n_u", "n_v") >= similarity * F.greatest("n_u", "n_v")
    tested = []

    def likely(proposed: DataFrame) -> DataFrame:
        """The pairs of ``proposed(a, b)`` that may be near by their signatures, as (u, v)."""
        pairs = proposed.where("a != b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        for side in ("u", "v"):
            pairs = pairs.join(classes.select(F.col("c").alias(side), F.col("n").alias(f"n_{side}"), F.col("signature").alias(f"s_{side}")), side)
        return pairs.where(sizes & ((F.greatest("n_u", "n_v") < _ESTIMATED) | (_estimate("s_u", "s_v") >= similarity - _SLACK))).select("u", "v")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """(i, set): the distinct shingles of the texts ``wanted(i)``."""
        held = T.StructType([T.StructField("i", kind), T.StructField("set", T.ArrayType(T.LongType()))])
        with arrowtext.small_batches(spark):
            return materialise(named.join(broadcast_if_small(wanted, DROPPED_BYTES), "i", "left_semi").mapInArrow(_sets(shingle, held), held), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs of near texts among ``pairs(u, v)`` that were not looked at before."""
        for before in tested:
            pairs = pairs.join(before, ["u", "v"], "left_anti")
        pairs = materialise(pairs, "proposed")
        tested.append(pairs)
        sets = sets_of(materialise(pairs.select(F.explode(F.array("u", "v")).alias("i")).distinct(), "wanted"))
        both = pairs.join(sets.select(F.col("i").alias("u"), F.col("set").alias("one")), "u").join(sets.select(F.col("i").alias("v"), F.col("set").alias("other")), "v")
        # The sets never leave the JVM, whose memory is bounded whatever their size.
        common, whole = F.size(F.array_intersect("one", "other")), F.size("one") + F.size("other")
        return materialise(both.where(common >= similarity * (whole - common)).select("u", "v"), "near")

    # Fingerprints within the radius, by the first text of each.
    prints = materialise(classes.groupBy("fp").agg(F.min("c").alias("first")), "distinct-fingerprints")
    near = materialise(links(prints, radius, shard), "fingerprint-links")
    of = prints.select(F.col("fp").alias("v"), F.col("first").alias("b"))
    proposed = near.join(prints.select(F.col("fp").alias("u"), F.col("first").alias("a")), "u").join(of, "v").select("a", "b").unionByName(
        classes.join(prints, "fp").select(F.col("first").alias("a"), F.col("c").alias("b")))
    # Equal samples, by the first text of each. The fingerprints that links reach are a group like those of a sample.
    reached = connected_components(near).select(F.col("node").alias("fp"), "root")
    kin = classes.join(reached, "fp", "left").select("c", F.xxhash64(F.lit("fp"), F.coalesce("root", "fp")).alias("view"))
    seen = classes.select("c", F.explode("views").alias("view")).unionByName(kin)
    groups = materialise(seen.groupBy("view").agg(F.min("c").alias("a"), F.count(F.lit(1)).alias("size")).where("size > 1"), "groups")
    found = verified(likely(proposed.unionByName(seen.join(groups, "view").select("a", F.col("c").alias("b")))))
    for _ in range(ROUNDS):
        # The least neighbour stands for the component here: one aggregate instead of all components in every round.
        both = found.select(F.col("u").alias("c"), F.col("v").alias("x")).unionByName(found.select(F.col("v").alias("c"), F.col("u").alias("x")))
        roots = both.groupBy("c").agg(F.least("c", F.min("x")).alias("root"))
        held = seen.join(groups.select("view", "size"), "view").join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
        # One text of each component in a group, another one in each group.
        chance = F.xxhash64("c", "view")
        parts = held.groupBy("view", "size", "root").agg(F.min_by("c", chance).alias("c"))
        around = Window.partitionBy("view", F.pmod(F.xxhash64("root"), F.ceil(F.col("size") / shard))).orderBy(F.xxhash64("root", "view"))
        neighbours = parts.select("c", F.lag("c", 1).over(around).alias("x"), F.lag("c", 2).over(around).alias("y")).select("c", F.explode(F.array("x", "y")).alias("b"))
        found = materialise(found.unionByName(verified(likely(neighbours.where("b is not null").select(F.col("c").alias("a"), "b")))), "near")
    # The rest: groups with several components.
    joined = connected_components(found)
    rooted = classes.select("c", "n").join(joined.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    held = materialise(seen.join(groups.select("view"), "view").join(rooted, "c"), "rooted")
    parted = held.groupBy("view").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.ceil(F.sum("n") / block).alias("blocks")).where("least < most")
    members = materialise(held.join(parted.select("view", "blocks"), "view").withColumn("own", F.pmod(F.xxhash64("c"), "blocks")), "parted")
    sets = sets_of(members.select(F.col("c").alias("i")).distinct()).distinct()
    # Block i meets block j if i <= j; a text stands on the left where its own block is i.
    dealt = members.select("view", "c", "root", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("to")).select(
        "view", F.least("own", "to").alias("low"), F.greatest("own", "to").alias("high"), (F.col("own") <= F.col("to")).alias("is_left"), "c", "root")
    pairs = T.StructType([T.StructField("u", kind), T.StructField("v", kind)])
    with arrowtext.small_batches(spark):
        rest = materialise(dealt.join(sets.withColumnRenamed("i", "c"), "c").select(*dealt.columns, "set").repartition("view", "low", "high")
                           .sortWithinPartitions("view", "low", "high").mapInArrow(_blocks(similarity, pairs), pairs), "rest")
    found = joined if rest.isEmpty() else connected_components(found.unionByName(rest))
    roots = classes.join(found.select(F.col("node").alias("c"), "root"), "c", "left").select(*text, F.coalesce("root", "c").alias("component_id"))
    return sketches.join(roots, text).select(F.col("i").alias(id_col), "component_id")


def _estimate(one: str, other: str) -> Column:
    """Share of the signatures' filled places that are equal."""
    empty = (1 << 31) - 1
    both = F.zip_with(one, other, lambda x, y: F.when((x == empty) & (y == empty), None).when(x == y, 1).otherwise(0))
    filled = F.filter(both, lambda x: x.isNotNull())
    return F.size(F.filter(filled, lambda x: x == 1)) / F.greatest(F.size(filled), F.lit(1))


def keep_one_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of similar texts, as ``keep_one`` does with fingerprints."""
    found = similar_texts(docs, id_col, text_col, **options)
    return _without(docs, id_col, found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("c")))
