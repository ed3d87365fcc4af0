"""Tokenizer alignment, lexical search and the multi-index against plain versions, on small tables with odd rows."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemill.llm import alignment, lexical_search, multi_index, queries

PATHS = [queries.tokenizer_file(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
DOCS = "doc_id long, text string, d long, n long, t string, pair long, row long, key string, score long, item int, groups string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = "the of Don't ñandú 12,345 über 漢字かな 🙂 <|endoftext|> </s> a\tb x\n\ny [end] ÉTÉ stone Stone river's".split(" ")

    def prose(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\n", "\t "]) for _ in range(n))

    whole = prose(60)
    return [None, "", " ", "\n", "one", " lead", "trail ", "▁odd", "a▁b", "\x00\x01", "x" * 700, "漢" * 300, prose(900), whole, whole,
            "   wide  spaces \x85 \x1c here ", *[prose(rng.randrange(1, 80)) for _ in range(25)]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, 7, 7, "t", 7, 7, "k", 7, 7, "g") for i, t in enumerate(texts)] + [(None, "no id here", *[None] * 9), (3, "id again", *[None] * 9)]
    return spark.createDataFrame(rows, DOCS)


def plain_alignment(text):
    """(n_a, n_b, groups text, links) by walking over the bytes."""
    enc = alignment.encoders(*PATHS)
    raw = " " + (text or "")
    a, b = enc.encode_a([raw])[0], enc.encode_b([text or ""])[0]
    if not text or b"".join(enc.bytes_a[n] for n in a) != raw.encode() or b"".join(enc.bytes_b[n] for n in b) != raw.encode():
        return 0, 0, "", []
    spans = []
    for ids, table in ((a, enc.bytes_a), (b, enc.bytes_b)):
        at, out = 0, []
        for n in ids:
            out.append((n, at, at + len(table[n])))
            at = out[-1][2]
        spans.append(out)
    common = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    shown, low = [], 0
    for high in common:
        shown.append("|".join(",".join(str(n) for n, s, e in x if low <= s and e <= high) for x in spans))
        low = high
    links = [(n, m) for n, s, e in spans[0] for m, u, v in spans[1] if max(s, u) < min(e, v)]
    return len(a), len(b), ";".join(shown), links


@pytest.mark.parametrize("chunk, hot", [(1 << 18, 1 << 20), (40, 50), (150, 0)])
def test_alignment(docs, texts, chunk, hot, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 3)
    got = collections.defaultdict(list)
    for r in alignment.align_and_count(docs, *PATHS, chunk=chunk, hot_pairs=hot).collect():
        got[r["doc_id"]].append(tuple(r[1:]))
    every = [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (3, "id again")]
    plain = [plain_alignment(t) for _, t in every]
    held = collections.Counter(p for _, _, _, links in plain for p in set(links))
    top = collections.Counter()
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    want = collections.defaultdict(list)
    for (i, _), (n_a, n_b, shown, links) in zip(every, plain):
        want[i].append((n_a, n_b, shown.count(";") + bool(shown), len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links),
                        hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert alignment.align_and_count(docs.limit(0), *PATHS).count() == 0


def test_fragments_compose_in_any_tree(texts):
    """Fragments of any byte ranges, cut without regard to either tokenizer's words, give the same groups whichever way they are composed."""
    enc = alignment.encoders(*PATHS)
    text = texts[12]
    a, b = enc.encode_a([" " + text]), enc.encode_b([text])
    whole = alignment._tokens(a, b, enc)
    want = alignment.groups(whole)
    rng = random.Random(1)
    for _ in range(20):
        parts, rest = [], whole
        for end in sorted(rng.sample(range(1, int(whole.a_end[-1])), 12)):
            # A and B are cut at places of their own.
            one, more = rest.split(end)
            extra, _ = more.split(end + rng.randrange(30))
            cut = alignment.Tokens(one.a, one.a_end, np.append(one.b, extra.b), np.append(one.b_end, extra.b_end))
            parts.append(alignment.fragment(cut))
            rest = alignment.Tokens(more.a, more.a_end, more.b[len(extra.b):], more.b_end[len(extra.b):])
        parts.append(alignment.fragment(rest))
        while len(parts) > 1:
            n = rng.randrange(len(parts) - 1)
            parts[n : n + 2] = [parts[n] + parts[n + 1]]
        got = parts[0].finish()
        assert (got.text, got.n_a, got.n_b, got.n_groups, got.n_links) == (want.text, want.n_a, want.n_b, want.n_groups, want.n_links)
        assert np.array_equal(got.pairs, want.pairs) and np.array_equal(got.links, want.links)


def test_chunks_encode_as_the_whole(texts):
    enc = alignment.encoders(*PATHS)
    for text in texts:
        raw = " " + (text or "")
        for size in (5, 17, 60):
            places = [*alignment.cuts(raw, size, enc), (len(raw), len(raw))]
            a = [n for (s, _), (e, _) in zip(places, places[1:]) for n in enc.encode_a([raw[s:e]])[0]]
            b = [n for (_, s), (_, e) in zip(places, places[1:]) for n in enc.encode_b([raw[s + 1 : e]])[0]]
            assert a == enc.encode_a([raw])[0] and b == enc.encode_b([raw[1:]])[0]


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranking(rows, items, k):
    docs = [(i, collections.Counter(plain_terms(t))) for i, t in rows if plain_terms(t)]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in docs:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(plain_terms(text)) if c[t])
            if score:
                scored.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return collections.Counter(out)


@pytest.mark.parametrize("tiles", [(256, 4096, 512, 2_000_000), (2, 3, 5, 200)])
def test_lexical_search(spark, docs, texts, tiles, monkeypatch):
    for name, value in zip(("TILE_ITEMS", "TILE_TERMS", "TILE_DOCS"), tiles):
        monkeypatch.setattr(lexical_search, name, value)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (3, "id again")]
    items = [(1, "The stone; the RIVER's übEr"), (2, None), (3, ""), (4, "?? !!"), (5, "unheard words"), (1, "漢字かな Don't"), (6, "stone stone"), (6, "stone stone"),
             (7, texts[13]), (None, "x id"), (8, texts[10] + " again")]
    table = spark.createDataFrame([(i, t, "d", 1) for i, t in items], "item_id long, text string, d string, score int")
    got = collections.Counter(map(tuple, lexical_search.rank(docs, table, block_chars=tiles[3]).collect()))
    assert got == plain_ranking(rows, [x for x in items if x[1] is not None], 10)
    assert lexical_search.rank(docs.limit(0), table).count() == lexical_search.rank(docs, table.limit(0)).count() == 0


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(lexical_search.arrowtext, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) << np.uint64(40))
    raw = np.frombuffer(b"cat dog cow dog emu", np.uint8)
    data, starts, ends, _ = lexical_search.terms(raw, np.array([0, len(raw)]))
    words = [b"cow", b"dog", b"bird"]
    place, word = lexical_search.Vocabulary(words).find(data, starts, ends)
    assert sorted(zip(place.tolist(), word.tolist())) == [(1, 1), (2, 0), (3, 1)]


def test_lexical_ties_and_exact_sums(spark):
    """Sixty equal documents tie for ten places; sums go far beyond what a float could hold if they were fractions."""
    docs = spark.createDataFrame([(900 - i, "alpha beta") for i in range(60)] + [(1, "alpha"), (2, "gamma"), (3, "delta")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "beta alpha"), (2, "gamma")], "item_id long, text string")
    got = [tuple(r) for r in lexical_search.rank(docs, items).where("item_id = 1").orderBy("rank").collect()]
    assert [r[2] for r in got] == list(range(841, 851)) and len({r[3] for r in got}) == 1


VECTORS = "vec_id long, embedding array<float>, label int, v int, i int, cell int, h1 long"


def plain_nearest(rows, every, k):
    kept = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            kept.append((i, tuple(float(np.float32(x)) for x in v)))
    sizes = collections.Counter(len(v) for _, v in kept)
    dim = max(sizes, key=lambda d: (sizes[d], d))
    kept = sorted({x for x in kept if len(x[1]) == dim})
    out = collections.defaultdict(list)
    for q, v in kept:
        if q % every == 0:
            scored = sorted((-float(np.dot(v, w)), i) for i, w in kept if i != q)[:k]
            out[q].append([(i, -s) for s, i in scored])
    return out


def vector_rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 9))
    rows = [(i, (centres[i % 6] + rng.normal(size=9) * 0.7).tolist()) for i in range(700)]
    copies = [(1000 + i, rows[3][1]) for i in range(120)]
    odd = [(None, rows[5][1]), (2000, None), (2005, []), (2010, [0.0] * 9), (2015, [float("nan")] + [1.0] * 8), (2020, [None] + [1.0] * 8),
           (2025, [float("inf")] + [1.0] * 8), (2030, [1.0, 2.0]), (20, rows[20][1])]
    return rows + copies + odd


def test_multi_index_with_all_cells_is_exact(spark):
    """At a recall of 1 on all queries as trials, every true neighbour is met; copies, ties and odd rows included."""
    rows = vector_rows()
    table = spark.createDataFrame([(i, v, 1, 1, 1, 1, 1) for i, v in rows], VECTORS).repartition(5)
    got = collections.defaultdict(list)
    for r in multi_index.nearest(table, F.col("vec_id") % 5 == 0, 20, recall=1.0, trial=10_000, block=64, visits=30).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = plain_nearest(rows, 5, 20)
    assert set(got) == set(want)
    for q, lists in want.items():
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        assert sum(a == b[0] for (_, a, _), b in zip(got[q], lists[0])) >= 19
        assert np.allclose([s for _, _, s in got[q]], [s for _, s in lists[0]], atol=1e-12)
        assert q not in {i for _, i, _ in got[q]}


def test_multi_index_recall_and_small_tables(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 16)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]) for r in multi_index.nearest(table, F.col("vec_id") % 20 == 0, 20).collect()}
    true = {(q, i) for q, lists in plain_nearest_double(rows, 20, 20).items() for i in lists}
    assert len(got & true) >= 0.9 * len(true) and len(got) == len(true)
    few = multi_index.nearest(table.where("vec_id in (0, 1, 2, 20)"), F.col("vec_id") % 20 == 0).collect()
    assert collections.Counter(r["query_id"] for r in few) == {0: 3, 20: 3}
    assert multi_index.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert multi_index.nearest(table.where("vec_id = 1"), F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-3.0]), (3, [2.0])], "vec_id long, embedding array<double>")
    assert [(r["vec_id"], r["score"]) for r in multi_index.nearest(one, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 2.0), (3, 2.0), (2, -3.0)]


def plain_nearest_double(rows, every, k):
    x = np.array([v for _, v in rows])
    return {i: [j for j in np.argsort(-(x @ x[i]), kind="stable").tolist() if j != i][:k] for i, _ in rows if i % every == 0}


def test_traversal_follows_the_sums():
    rng = np.random.default_rng(2)
    first, second, sizes = rng.normal(size=7), rng.normal(size=5), rng.integers(0, 4, 35)
    order = np.argsort((first[:, None] + second[None]).ravel(), kind="stable")
    assert multi_index.traverse(first, second, sizes, 10**9) == [c for c in order.tolist() if sizes[c]]
    some = multi_index.traverse(first, second, sizes, 20)
    assert sizes[some].sum() >= 20 > sizes[some[:-1]].sum()


def test_blocks_are_bounded():
    sizes = np.array([3, 0, 50, 4, 4, 4, 0, 120, 1])
    blocks = multi_index.Blocks(sizes, 10)
    assert blocks.parts.tolist() == [1, 1, 5, 1, 1, 1, 1, 12, 1]
    numbers = [range(f, f + p) for f, p in zip(blocks.first.tolist(), blocks.parts.tolist())]
    alone = [set(r) for r, p in zip(numbers, blocks.parts) if p > 1]
    assert all(not s & set(r) for s in alone for r in numbers if set(r) != s)
    assert max(x for r in numbers for x in r) == blocks.count - 1


@pytest.mark.parametrize("name", ["op11_alignment", "op12_lexical_search", "op13_multi_index"])
def test_queries_run_on_the_given_tables(spark, name):
    rows = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert rows.count() > 0


def test_group_texts_and_their_digests(docs, texts):
    """The operator's own output is the group text; chunked texts give the same."""
    got = collections.Counter((r["d"], bytes(r["groups"]).decode()) for r in alignment.align(docs, *PATHS, chunk=60).collect())
    every = [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (3, "id again")]
    shown = [(i, plain_alignment(t)[2]) for i, t in every]
    assert got == collections.Counter((i, s + ";" if s else "") for i, s in shown)
