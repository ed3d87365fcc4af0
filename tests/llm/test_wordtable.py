"""Words that workers remember: bounded by bytes, whatever the texts hold, and without effect on results."""

import random
import sys

import pytest

from pulsemill.llm import bpe, queries, token_counts, wordtable


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(queries.tokenizer_file("word_bpe_49k.json"))


def ids(tokenizer, text):
    return [n for piece in tokenizer.encode(text) for n in piece]


def held(table):
    return sum(sys.getsizeof(x) for d in (table.known, table.older) for x in (d, *d, *d.values()))


def test_unspaced_runs_are_not_remembered(tokenizer):
    rng = random.Random(7)
    counter = token_counts.Counter([("▁", -1.0), ("漢", -2.0), ("字", -2.0)])
    for _ in range(2000):
        run = "".join(rng.choices("漢字仮名交文章長書読", k=200))
        ids(tokenizer, run)
        counter.text(run)
    assert not tokenizer.table.known and not counter.table.known


def test_tables_hold_bounded_bytes(tokenizer):
    table = wordtable.WordTable(1 << 20)
    for i in range(200_000):
        word = f"word{i}" + "é" * (i % 50)
        table.add(word, bytes(4 * (i % 9 + 1)))
    assert held(table) < 3 << 20 and table.known and table.older
    assert table.earlier("word0") is None
    word = next(iter(table.older))
    assert table.earlier(word) == table.known[word]


def test_a_small_table_changes_nothing(tokenizer, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(f"{rng.choice(['Stone', 'river', 'ñandú', 'x1'])}{rng.randrange(50)}" for _ in range(400)) for _ in range(5)]
    texts += ["<|endoftext|>a\t b<|startoftext|>", "y" * 300, "é́ ́e", "a\n\n b c　d\x1ce"]
    want = [ids(tokenizer, t) for t in texts]
    other = bpe.Tokenizer(queries.tokenizer_file("word_bpe_49k.json"))
    other.table = wordtable.WordTable(5000)
    assert [ids(other, t) for t in texts] == want
    monkeypatch.setattr(bpe, "PIECE", 7)
    assert [ids(other, t) for t in texts] == want and len(list(other.pieces(texts[0]))) > 100
    assert "".join(other.pieces(texts[0])) == texts[0]
