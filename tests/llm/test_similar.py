"""Near copies by five-word Jaccard similarity, against all pairs."""

import collections
import itertools
import os
import random
import re

import pytest

from pulsemill.llm import queries, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.01"


def shingles(text, size=5):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset(" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_pairs(sets):
    """All pairs of similarity 0.8 and more, found over the shingles that they share."""
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    seen = {p for ids in holders.values() for p in itertools.combinations(ids, 2)} | set(itertools.combinations([i for i, s in sets.items() if not s], 2))
    return {p for p in seen if jaccard(sets[p[0]], sets[p[1]]) >= 0.8}


def roots(sets, pairs):
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {i: top(i) for i in sets}


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + rng.randint(0, 1)] = [f"new{rng.randrange(1000)}"]
    return " ".join(words)


def test_near_copies_against_all_pairs(spark):
    rng = random.Random(21)
    prose = lambda n: " ".join(rng.choice("abcdefghijkl") + rng.choice("aeiou") + rng.choice("mnrst") for _ in range(n))
    base = [prose(n) for n in (300, 300, 200, 500, 120, 80)]
    texts = [None, "", " \n", "one", "One ", "one two", "a b c d", "a b c d e", "A b  c d e", prose(5000)]
    texts += [edited(rng, rng.choice(base), rng.randrange(1, 14)) for _ in range(400)] + base * 2 + [prose(rng.randrange(5, 200)) for _ in range(60)]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    pairs = near_pairs(sets)
    rows = [(i, t, 1, 1, "c", "w") for i, t in enumerate(texts)] + [(None, base[0], 1, 1, "c", "w"), (3, "one", 1, 1, "c", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, fp long, c string, words string")
    got = collections.defaultdict(set)
    for r in simhash.similar_texts(docs).collect():
        got[r.doc_id].add(r.component_id)
    assert set(got) == set(sets) and all(len(v) == 1 for v in got.values())
    found = {i: min(v) for i, v in got.items()}
    joined = sum(found[a] == found[b] for a, b in pairs)
    assert len(pairs) > 500 and joined >= 0.97 * len(pairs)
    want = roots(sets, pairs)
    assert all(want[i] == want[c] for i, c in found.items())  # nothing is joined that no chain of near copies joins
    kept = simhash.keep_one_similar(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted([*{c for c in found.values()}, 3]) and None in ids
    assert simhash.similar_texts(docs.limit(0)).count() == 0 == simhash.keep_one_similar(docs.limit(0)).count()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")
def test_recall_on_the_given_documents(spark):
    docs = queries.table(spark, FOLDER, "documents")
    sets = {r.doc_id: shingles(r.text) for r in docs.select("doc_id", "text").collect()}
    pairs = near_pairs({i: s for i, s in sets.items() if len(s) > 1})
    differing = {(a, b) for a, b in pairs if sets[a] != sets[b]}
    found = {r.doc_id: r.component_id for r in simhash.similar_texts(docs).collect()}
    assert differing and sum(found[a] == found[b] for a, b in differing) >= 0.9 * len(differing)
    assert all(found[a] == found[b] for a, b in pairs - differing)
    want = roots(sets, near_pairs(sets))
    assert all(want[i] == want[c] for i, c in found.items())


def test_all_near_pairs_of_a_large_group_are_joined(spark):
    """Texts that share their least shingles but are not near, with near pairs among them: one sample of one shingle makes large groups."""
    rng = random.Random(18)
    common = " ".join(f"common{n}" for n in range(100))
    own = lambda i: " ".join(f"own{i}x{n}" for n in range(45))
    texts = [f"{common} {own(i)}" for i in range(120)]
    texts += [texts[i] + f" end{i}" for i in range(0, 120, 2)]
    rng.shuffle(texts)
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    pairs = near_pairs(sets)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.similar_texts(docs, samples=1, sample=1, radius=0, block=2000).collect()}
    assert len(pairs) == 60 and sum(found[a] == found[b] for a, b in pairs) >= 0.9 * len(pairs)
    want = roots(sets, pairs)
    assert all(want[i] == want[c] for i, c in found.items())
