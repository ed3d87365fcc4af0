"""BPE encoding and decoding with a public tokenizer file, merges by a priority queue over a linked list.

A word starts as a doubly linked list of symbols. Its adjacent pairs wait in a heap by merge rank and place; the best is
merged, its neighbours give new pairs, and entries whose symbols have changed since are skipped. Words are encoded once
per worker while they stay in a table of bounded bytes. Decoding joins the vocabulary strings of the ids, as the file
names no decoder: with one space between tokens.

The file's steps are followed: special tokens are cut out of the raw text first; the rest is brought to NFC and letters
become lower case one by one; words, which never hold white space,
are found by the pattern and written as byte symbols, the last one with the word end. Null texts count as empty: no ids
and an empty decoded text. Very long texts are encoded piece by piece between white space, very long words whole. Rows are independent of each other, so repeated rows give
the same row again and an empty table none; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.llm import arrowtext
from pulsemill.llm.wordtable import WordTable

#: Characters of a text that are encoded at a time, up to the next white space.
PIECE = 1 << 18

# What the tokenizer's pattern language calls white space.
WHITE = r"[\x09-\x0D\x20\x85\xA0  -     　]"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or one from 256 on in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Tokenizer:
    """A BPE tokenizer read from a tokenizers JSON file with word ends and byte symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("decoder") or spec.get("post_processor") or not model.get("end_of_word_suffix"):
            raise ValueError("a BPE file with a word end and without decoder and post-processor is needed")
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = [self.ids[a] for a, _ in merges]
        self.right = [self.ids[b] for _, b in merges]
        self.merged = [self.ids[a + b] for a, b in merges]
        self.ranks = {a << 32 | b: n for n, (a, b) in enumerate(zip(self.left, self.right))}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.ids | self.special).items()}
        self.inner = [self.ids[x] for x in byte_symbols()]
        self.last = [self.ids[x + self.end] for x in byte_symbols()]
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s\p{L}", WHITE[1:-1] + r"\p{L}"))
        self.gap = re.compile("[\t\n\r ]")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        size = max(self.names) + 1
        self.decimal = [str(n) for n in range(size)]
        self.strings = [self.names.get(n) for n in range(size)]
        self.table = WordTable()

    def normal(self, text: str) -> str:
        """NFC and lower case, letter by letter. White space needs no care: the pattern drops it in any form."""
        text = unicodedata.normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join(map(str.lower, text))

    def merge(self, word: str) -> list[int]:
        """Ids of a word: the pair of the lowest rank is merged first, the leftmost among equals."""
        raw = word.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        size, rank_of, left, right = len(ids), self.ranks.get, self.left, self.right
        after, before = [*range(1, size), -1], [*range(-1, size - 1)]
        shift = size.bit_length()
        # An entry of the queue is a rank over the place of the pair's left symbol.
        heap = [r << shift | i for i in range(size - 1) if (r := rank_of(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        mask = (1 << shift) - 1
        while heap:
            entry = heapq.heappop(heap)
            i, rank = entry & mask, entry >> shift
            j = after[i]
            if j < 0 or ids[i] != left[rank] or ids[j] != right[rank]:
                continue  # stale: a symbol of the pair has been merged since
            ids[i], ids[j] = self.merged[rank], -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank_of(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(heap, r << shift | i)
            h = before[i]
            if h >= 0 and (r := rank_of(ids[h] << 32 | ids[i])) is not None:
                heapq.heappush(heap, r << shift | h)
        return [x for x in ids if x >= 0]

    def word(self, word: str) -> bytes:
        """Ids of a word that is not in the table's young generation, four bytes each."""
        found = self.table.earlier(word)
        if found is None:
            found = array("i", self.merge(word)).tobytes()
            self.table.add(word, found)
        return found

    def pieces(self, text: str) -> Iterator[str]:
        """``text`` cut before white space into pieces of about ``PIECE`` characters."""
        at = 0
        while len(text) - at > PIECE:
            gap = self.gap.search(text, at + PIECE)
            if gap is None:
                break
            yield text[at : gap.start()]
            at = gap.start()
        yield text[at:] if at else text

    def encode(self, text: str) -> Iterator[list[int]]:
        """The ids of ``text``, piece by piece."""
        known, word = self.table.known.get, self.word
        for part in self.cut.split(text) if any(s in text for s in self.special) else [text]:
            if part in self.special:
                yield [self.special[part]]
                continue
            for piece in self.pieces(part):
                words = self.words.findall(self.normal(piece))
                if words:
                    yield array("i", b"".join([known(w) or word(w) for w in words])).tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.names[i] for i in ids if i in self.names])


def shared(path: str) -> Tokenizer:
    """The worker's tokenizer, kept from task to task with the words that it remembers."""
    return arrowtext.keep(("bpe", path), lambda: Tokenizer(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """(id, n_tokens, ids, ids_sha256, decoded_sha256) of every whole text; ``ids=False`` leaves out the ids themselves."""
    return _texts(docs, path, id_col, text_col, ids, False)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded, ids_sha256, decoded_sha256): ids and the text that they decode to."""
    return _texts(docs, path, id_col, text_col, True, True)


def _texts(docs: DataFrame, path: str, id_col: str, text_col: str, ids: bool, decoded: bool) -> DataFrame:
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids + [T.StructField("decoded", T.StringType())] * decoded
    fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def encoded(tokenizer: Tokenizer, text: str) -> list:
        """One row: number of ids, ids, decoded text, and both digests, made piece by piece."""
        count, kept, strings, digests = 0, [], [], (hashlib.sha256(), hashlib.sha256())
        for piece in tokenizer.encode(text):
            names = " ".join([tokenizer.strings[n] for n in piece])
            for digest, shown in zip(digests, (" ".join([tokenizer.decimal[n] for n in piece]), names)):
                digest.update((" " + shown if count else shown).encode())
            count += len(piece)
            if ids:
                kept += piece
            if decoded:
                strings.append(names)
        return [count, *[kept] * ids, *[" ".join(strings)] * decoded, *[d.hexdigest() for d in digests]]

    kinds = [pa.int64(), *[pa.list_(pa.int32())] * ids, *[pa.string()] * (decoded + 2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [encoded(tokenizer, t.as_py() or "") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]], names=[f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("t")).mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded): the text of each row's ids; unknown ids are left out, null gives null."""
    schema = T.StructType([T.StructField(id_col, encoded.schema[id_col].dataType), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared(path)
        for batch in batches:
            texts = [None if x.as_py() is None else tokenizer.decode(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "decoded"])

    return encoded.select(F.col(id_col), F.col(ids_col).cast("array<int>").alias("i")).mapInArrow(run, schema)
