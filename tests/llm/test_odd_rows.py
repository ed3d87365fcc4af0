"""Repeated rows, ids that stand on several rows, empty tables and clashing column names, for every operator on documents."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from pulsemill.llm import (
    alignment, bpe, decontamination, language_id, lexical_search, pii, quality_classifier, quality_rules, queries, secret_scan, simhash, substring_dedup, token_counts,
)

NAMES = "t string, n long, fp long, key string, row long, words string, `__id` long, `__text` string, start int, spans string, score double, token string, k long, h long, d long, c string"


def pipelines(docs):
    """name -> (operator on a table, rows it gives for each row of the table)."""
    word_bpe, piece = queries.tokenizer_file("word_bpe_49k.json"), queries.tokenizer_file("piece_bpe_32k.model")
    models, labels = secret_scan.train(docs), docs.select("doc_id", F.lit(1).alias("quality"))
    weights = quality_classifier.train(docs, labels, F.lit(True))
    model = language_id.train(docs, F.lit(True))
    return {
        "quality_rules": lambda x: quality_rules.apply_policy(quality_rules.ledger(x)), "simhash": simhash.near_duplicates,
        "pii": pii.detect, "redact": pii.redact, "quality_classifier": lambda x: quality_classifier.score(x, weights), "secret_scan": lambda x: secret_scan.scan(x, models),
        "token_counts": lambda x: token_counts.count(x, piece), "bpe": lambda x: bpe.round_trip(x, word_bpe), "substring_dedup": substring_dedup.remove_repeated,
        "language_id": lambda x: language_id.predict(x, model), "alignment": lambda x: alignment.align_and_count(x, queries.tokenizer_file("byte_bpe_50k.json"), piece, chunk=300)}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(17)
    words = lambda n: " ".join(rng.choice("stone river cloud the of and 555-123-4567 x@y.org token=abcdefgh1 ñandú".split()) for _ in range(n))
    plain = [(i, words(rng.randrange(0, 90)), "en" if i % 2 else None) for i in range(20)]
    # Exact repeats, one id on several texts, one text under several ids, nulls everywhere, one long text.
    return plain + plain[:5] * 3 + [(1, words(50), "en"), (1, None, None), (900, plain[2][1], "es"), (901, None, None), (902, "", "es"), (903, words(8000), "en"), (None, None, None), (None, words(9), "en")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for column in NAMES.split(", "):
        name, kind = column.split(" ")
        table = table.withColumn(name.strip("`"), F.lit(None).cast(kind))
    return table


def test_every_row_gets_its_row(docs, rows):
    for name, run in pipelines(docs).items():
        out = run(docs)
        got = out.collect()
        assert collections.Counter(r.doc_id for r in got) == collections.Counter(i for i, _, _ in rows), name
        # Rows of one id and text are the same row; the repeats of a repeated row see each other as other places in substring_dedup alone.
        if name not in ("substring_dedup", "simhash"):
            kinds = collections.defaultdict(set)
            texts = collections.defaultdict(set)
            for i, t, _ in rows:
                texts[i].add(t)
            for r in got:
                kinds[r.doc_id].add(str(r))
            assert all(len(kinds[i]) <= len(texts[i]) for i in texts), name
        assert run(docs.limit(0)).count() == 0, name


def test_items_and_documents_with_odd_rows(spark, docs, rows):
    items = spark.createDataFrame([(1, rows[3][1] + " river stone", "d"), (1, rows[3][1] + " river stone", "d"), (None, rows[4][1], "d"), (2, None, None), (3, "", "d")], "item_id long, text string, doc_id string")
    found = decontamination.leaks(docs, items).collect()
    assert all(r.item_id in (1, None) for r in found)
    kept = decontamination.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() + len({(r.doc_id) for r in found}) <= docs.count() + len(rows)
    ranked = lexical_search.rank(docs, items).collect()
    assert {r.item_id for r in ranked} <= {1, None} and all(r.score > 0 for r in ranked)
    held = collections.Counter((r.item_id, r["rank"]) for r in ranked)
    assert set(held.values()) == {1}
