"""Token counts of a unigram vocabulary: a Viterbi pass that carries only the best score and its piece count.

An Aho-Corasick automaton enumerates the vocabulary pieces in a word; per place the pass keeps the best score and how many
pieces it takes. Ties follow the tokenizers library's unigram model: matches are offered from earlier starts first and an equal score
does not replace an earlier one. Where no one-character piece covers a character, an unknown piece of that character is
offered after the others, at the lowest score less ten; neighbouring unknowns fuse and count as their UTF-8
bytes (byte fallback). Words are cut before each space (written as the space mark, and put before the text), counted
once per worker while they stay in a table of bounded bytes.

A null or empty text has no tokens. Very long words are counted whole. Rows are independent, so repeated rows give the
same count again and an empty table gives no rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.llm.wordtable import WordTable

MARK = "▁"
UNKNOWN_PENALTY = 10.0


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.table = WordTable()

    def viterbi(self, word: str) -> int:
        """Number of pieces on the best path through ``word``."""
        size, unknown = len(word), self.unknown
        best, count = [0.0] * (size + 1), [0] * (size + 1)
        place, top, origin, single = 1, None, -1, False

        def close() -> None:
            """Settle ``place``: the best match that ends there, or an unknown character."""
            if not single and (top is None or best[place - 1] + unknown > top):
                # Fused unknowns fall back to bytes, so each character counts its own bytes either way.
                best[place] = best[place - 1] + unknown
                count[place] = count[place - 1] + len(word[place - 1].encode())
            else:
                best[place], count[place] = top, count[origin] + 1

        # Matches come by their end and, for one end, from the earliest start on.
        for end, (length, score) in self.automaton.iter(word):
            while place <= end:
                close()
                place, top, single = place + 1, None, False
            score += best[place - length]
            if top is None or score > top:
                top, origin = score, place - length
            if length == 1:
                single = True
        while place <= size:
            close()
            place, top, single = place + 1, None, False
        return count[size]

    def word(self, word: str) -> int:
        """The count of a word that is not in the table's young generation."""
        n = self.table.earlier(word)
        if n is None:
            n = self.viterbi(MARK + word)
            self.table.add(word, n)
        return n

    def text(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")
        if len(words) > 1 and not words[0]:
            words = words[1:]  # the text brings its own first mark
        known, word = self.table.known.get, self.word
        return sum([known(w) or word(w) for w in words])


@lru_cache(2)
def shared(path: str) -> Counter:
    """The worker's counter, kept from task to task with the words that it remembers."""
    return Counter(vocabulary(path))


def count(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) of every whole text, with the pieces and scores of a sentencepiece file as a unigram vocabulary."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared(path)
        for batch in batches:
            counts = [counter.text(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=[id_col, "n_tokens"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema)
