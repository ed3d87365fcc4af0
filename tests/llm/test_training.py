"""Bounded training samples, and the learned models against plain loops."""

import collections
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemill.llm import arrowtext, language_id, pii, quality_classifier, queries, secret_scan

FOLDER = "/root/testdata/sf0.001"


def prose(rng, n):
    return " ".join(rng.choice("stone river cloud the of and".split()) + rng.choice(["", "s", "ly"]) for _ in range(n))


def test_every_labelled_key_counts(spark):
    """Two hundred thousand different ordinary words do not push a labelled key out of the training."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(200_000)]
    rows = [(i, " ".join(words[200 * i : 200 * i + 200]) + f" token={'%032x' % rng.getrandbits(128)}") for i in range(1000)]
    seen = []
    original = secret_scan._fitted
    secret_scan._fitted = lambda found: seen.append(found) or original(found)
    try:
        models = secret_scan.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    finally:
        secret_scan._fitted = original
    counts = {r["label"]: r["count"] for r in seen[0].groupBy("label").count().collect()}
    assert counts[0] >= 199_000 and counts[1] >= 1000  # a key alone and with the word before it
    keys, names = secret_scan.generated(200, 77)
    assert np.mean([models.score(k) >= models.limit for k in keys]) > 0.9 and np.mean([models.score(n) >= models.limit for n in names]) < 0.02


def test_pair_counts_and_scores_against_loops():
    rng = random.Random(1)
    tokens = ["".join(rng.choice(secret_scan.SYMBOLS + "é") for _ in range(rng.randrange(1, 30))) for _ in range(50)]
    other = ["some_name_here", "getUserName", "x"]
    at = {c: i for i, c in enumerate(secret_scan.SYMBOLS)}
    number = lambda c: at.get(c, len(at))

    def logs(strings):
        n = len(at) + 1
        counts = [[0.5] * n for _ in range(n)]
        for s in strings:
            for a, b in zip(s, s[1:]):
                counts[number(a)][number(b)] += 1
        return [[math.log(x / sum(row)) for x in row] for row in counts]

    a, b = logs(tokens), logs(other)
    models = secret_scan.Models(secret_scan._pairs(tokens), secret_scan._pairs(other))
    for t in tokens + other:
        pairs = [(number(x), number(y)) for x, y in zip(t, t[1:])]
        want = sum(a[x][y] - b[x][y] for x, y in pairs) / len(pairs) if pairs else 0.0
        assert models.score(t) == pytest.approx(want, abs=1e-12)


def test_one_id_on_many_rows_is_bounded(spark):
    rng = random.Random(5)
    rows = [(7, prose(rng, 6) if i % 2 else "la piedra del rio " + prose(rng, 2), "en" if i % 2 else "es") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    taken = []
    original = language_id._fit
    language_id._fit = lambda rows, n: taken.append(len(rows)) or original(rows, n)
    try:
        language_id.train(docs, F.lit(True), max_train=10)
        language_id.train(docs, F.lit(True), max_train=1000, max_values=400)
    finally:
        language_id._fit = original
    assert taken[0] <= 10 and 1 <= taken[1] < 40
    labels = spark.createDataFrame([(7, 1)], "doc_id long, quality int")
    held = []
    learn = quality_classifier._learn
    weights = quality_classifier.train(docs, labels, F.lit(True), max_train=10)
    assert weights.shape == (quality_classifier.BUCKETS + 1,) and not held and learn is quality_classifier._learn
    assert quality_classifier.train(docs.limit(0), labels, F.lit(True)).sum() == 0


def test_ftrl_against_a_plain_loop():
    rng = np.random.default_rng(4)
    rows = [(np.sort(rng.choice(50, 8, replace=False)), rng.random(8), float(rng.integers(0, 2))) for _ in range(120)]
    c = quality_classifier
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i):
        if abs(z[i]) <= c.L1:
            return 0.0
        return (math.copysign(c.L1, z[i]) - z[i]) / ((c.BETA + math.sqrt(n[i])) / c.ALPHA + c.L2)

    for _ in range(c.EPOCHS):
        for index, value, label in rows:
            w = [weight(i) for i in index]
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(w, value))))))
            for i, x, old in zip(index, value, w):
                g = (p - label) * x
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / c.ALPHA * old
                n[i] += g * g
    got = c._learn(rows)
    assert np.allclose(got[:50], [weight(i) for i in range(50)], atol=1e-9) and not got[50:].any()


def test_scores_are_sparse_dot_products(spark):
    rng = random.Random(6)
    texts = ["", None, "one", "a b", *[prose(rng, rng.randrange(3, 60)) for _ in range(40)], "same words here " * 20]
    weights = np.random.default_rng(3).normal(size=quality_classifier.BUCKETS + 1).astype(np.float32)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality_classifier.score(docs, weights).collect()}
    for i, t in enumerate(texts):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        total = float(weights[-1])
        if len(raw):
            bucket, share, own = quality_classifier._features(raw, np.array([0, len(raw)]))
            for b, s, o in zip(bucket.tolist(), share.tolist(), own.tolist()):
                assert o == 0
                total += float(weights[b]) * s
        assert got[i] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, total)))), abs=1e-6)


def test_language_averages_and_softmax_against_loops(spark):
    rng = random.Random(7)
    texts = ["", None, "123", "a", "ab c", *[prose(rng, rng.randrange(1, 40)) for _ in range(30)]]
    numbers = np.random.default_rng(5)
    buckets = 1 << language_id.BITS
    table = numbers.normal(size=(3, buckets + 1)).astype(np.float32)
    table[:, -1] = 0
    model = language_id.Model(["de", "en", "es"], table, numbers.normal(size=3), 0.7, 0.5)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    for i, t in enumerate(texts):
        if not any(ch.isalpha() for ch in t or ""):
            assert (got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False)
            continue
        data, offsets = arrowtext.compact(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        raw, used = data.tolist(), []
        for a, b, c in zip(raw, raw[1:], raw[2:]):
            used.append(((a | b << 8 | c << 16) * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - language_id.BITS)
        starts, ends, _ = arrowtext.words(data, offsets)
        used += [int(h) >> 64 - language_id.BITS for h in arrowtext.word_hashes(data, starts, ends)]
        logits = [(sum(float(row[u]) for u in used) / len(used) + float(b)) / 0.7 for row, b in zip(table, model.bias)]
        p = [math.exp(x - max(logits)) for x in logits]
        p = [x / sum(p) for x in p]
        assert got[i].lang_pred == model.languages[p.index(max(p))] and got[i].score == pytest.approx(max(p), abs=1e-4)
        assert got[i].accepted == (got[i].score >= 0.5)


def test_sgd_against_a_plain_loop():
    rng = np.random.default_rng(8)
    rows = [(np.sort(rng.choice(40, 6, replace=False)).astype(np.int32), np.full(6, 1 / 6, np.float32), int(rng.integers(0, 2))) for _ in range(25)]
    embed, out, bias = language_id._fit(rows, 2)
    again = np.random.default_rng(10)
    size = language_id.SIZE
    e = again.uniform(-1 / size, 1 / size, ((1 << language_id.BITS) + 1, size)).tolist()
    o, b = [[0.0, 0.0] for _ in range(size)], [0.0, 0.0]
    order = [i for _ in range(language_id.EPOCHS) for i in again.permutation(len(rows))]
    for step, i in enumerate(order):
        index, share, label = rows[i]
        share = [float(x) for x in share]
        mean = [sum(s * e[j][d] for j, s in zip(index, share)) for d in range(size)]
        logits = [sum(mean[d] * o[d][k] for d in range(size)) + b[k] for k in (0, 1)]
        p = [math.exp(x - max(logits)) for x in logits]
        p = [x / sum(p) - (k == label) for k, x in enumerate(p)]
        rate = language_id.STEP * (1 - step / len(order))
        back = [sum(o[d][k] * p[k] for k in (0, 1)) for d in range(size)]
        for d in range(size):
            for k in (0, 1):
                o[d][k] -= rate * mean[d] * p[k]
        b = [b[k] - 0.1 * rate * p[k] for k in (0, 1)]
        scale = rate * min(100.0, 1 / sum(x * x for x in share))
        for j, s in zip(index, share):
            for d in range(size):
                e[j][d] -= scale * s * back[d]
    assert np.allclose(out, o, atol=1e-9) and np.allclose(bias, b, atol=1e-9) and np.allclose(embed[:40], e[:40], atol=1e-9)


def spans_of(spark, texts):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, `__base` int, start int")
    return {r.doc_id: r.text for r in pii.redact(docs).collect()}, {r.doc_id: r for r in pii.detect(docs).collect()}


def test_numbers_beside_each_other(spark):
    texts = ["call 555-123-4567 555-987-6543 now", "pay 4111 1111 1111 1111 020 123 4567 today", "host 192.168.10.20 (555) 123-4567 up", "phone 5551234567 please",
             "order 5551234567 of part", "on 2021-10-11 555-123-4567 rang", "a list: 212-555-0101, 212-555-0102, 212-555-0103", None, ""]
    red, found = spans_of(spark, texts)
    assert not any(c.isdigit() for c in red[0]) and not any(c.isdigit() for c in red[1]) and not any(c.isdigit() for c in red[2] if c != ".") and not any(c.isdigit() for c in red[3])
    assert red[4] == texts[4] and "4567" not in red[5] and not any(c.isdigit() for c in red[6])
    assert red[7] is None and red[8] == "" and not found[7].spans
    for i, t in enumerate(texts):
        spans = [tuple(s) for s in found[i].spans]
        assert spans == sorted(spans) and set(map(tuple, found[i].base)) <= set(spans)


def test_positions_in_long_lists(spark):
    """Places over several blocks of sums, with letters of several bytes in between."""
    text = " é ".join(f"u{i}@x{i}.org" for i in range(700))
    _, found = spans_of(spark, [text])
    assert [text[s.start : s.end] for s in found[0].base] == [f"u{i}@x{i}.org" for i in range(700)] == [text[s.start : s.end] for s in found[0].spans]


def test_a_text_of_eight_thousand_addresses(spark):
    import time

    text = " ".join(f"user{i}@example{i}.org" for i in range(8000))
    spans_of(spark, ["warm up a@b.org 555-123-4567"])
    begin = time.perf_counter()
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = pii.detect(docs).collect()
    took = time.perf_counter() - begin
    assert len(row.base) == len(row.spans) == 8000 and took < 6


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")
@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n.split("_")[0] in ("op2", "op3", "op4", "op5", "op6", "op7", "op8", "op10")])
def test_queries_keep_their_contract(spark, name):
    documents = queries.table(spark, FOLDER, "documents")
    rows = queries.QUERIES[name](spark, FOLDER)
    got = rows.collect()
    columns = {
        "op2": "doc_id item_id", "op3": "doc_id fingerprint component_id", "op4": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op5": "doc_id held_out score predicted",
        "op6": "doc_id n_assign n_access n_hex base_sha256 spans", "op7": "doc_id n_tokens", "op8": "doc_id n_tokens ids_sha256 decoded_sha256", "op10": "doc_id held_out lang_pred score"}[name.split("_")[0]]
    assert rows.columns[: len(columns.split())] == columns.split()
    ids = {r.doc_id for r in documents.select("doc_id").collect()}
    assert {r.doc_id for r in got} <= ids if name.startswith("op2") else sorted(r.doc_id for r in got) == sorted(ids)
    import zlib

    if name.startswith("op5"):
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    if name.startswith("op10"):
        known = {r.lang for r in documents.select("lang").distinct().collect()} | {"und"}
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.lang_pred in known for r in got)
    if name.startswith("op4"):
        import hashlib

        for r in got:
            base = [s for s in r.spans.split(",") if s.split(":")[0] in ("email", "ip", "card", "phone")]
            assert len(base) == r.n_email + r.n_ip + r.n_card + r.n_phone and hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def test_samples_of_least_hash(spark):
    from pulsemill.llm.sampling import least

    table = spark.range(20_000).withColumn("id", F.when(F.col("id") < 9000, F.lit(5)).otherwise(F.col("id")))
    order = [F.xxhash64("id"), F.col("id")]
    for n in (1, 50, 900, 3000, 30_000):
        assert [r.id for r in least(table, order, n).collect()] == [r.id for r in table.orderBy(*order).limit(n).collect()]
    same = spark.range(5000).select(F.lit(3).alias("id"))
    assert least(same, [F.xxhash64("id")], 10).count() == 10 and least(same.limit(0), [F.xxhash64("id")], 10).count() == 0
