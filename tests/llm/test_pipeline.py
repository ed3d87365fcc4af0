"""The pipeline, stage by stage against plain versions, and the registered queries with SQL."""

import os

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from pulsemill.llm import decontamination, queries, quality_rules, simhash

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")


def test_pipeline(spark):
    docs = queries.table(spark, FOLDER, "documents")
    want = {r.doc_id: r.text for r in docs.collect()}
    out = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "bpe"]
    kept = {r.doc_id for r in quality_rules.apply_policy(quality_rules.ledger(docs)).collect() if r.kept}
    first = out["quality_rules"](spark, docs, FOLDER)
    assert {r.doc_id for r in first.collect()} == kept and first.columns == docs.columns
    second = out["near_dedup"](spark, first, FOLDER)
    assert {r.doc_id for r in second.collect()} == {r.component_id for r in simhash.similar_texts(first).collect()}
    items = [decontamination._normal(r.text) for r in queries.table(spark, FOLDER, "benchmark").collect()]
    third = out["decontamination"](spark, second, FOLDER)
    left = {r.doc_id for r in third.collect()}
    held = {r.doc_id for r in second.collect() if any(i in decontamination._normal(want[r.doc_id]) for i in items)}
    assert not left & held and left | held == {r.doc_id for r in second.collect()}
    fourth = out["pii"](spark, third, FOLDER)
    assert fourth.columns == docs.columns and all(r.n_chars == len(r.text) for r in fourth.collect())
    encoded = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert set(encoded) == left and all(len(r.ids) == r.n_tokens for r in encoded.values())


def test_pipeline_on_odd_rows(spark):
    """Nulls in any column, empty and repeated texts, ties, and columns whose names the operators use themselves."""
    text = "the stone stands by the river and the cloud goes on over it to the sea where the wind of the night sings of one who went out and came home again " * 3
    words = " ".join(f"{w}{i}" for i, w in enumerate(text.split()))
    rows = [(1, words, "a"), (2, words, "b"), (2, words, "b"), (None, words + " more", None), (4, None, None), (5, "", "c"), (6, words.replace("stone0", "x") + " call 555-123-4567 now", None)]
    docs = spark.createDataFrame([(i, t, None, s, None, 1, "k", 2, 3, "c", "w") for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, fp long, key string, kept int, n int, c string, words string")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None"]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert len(last) == 2 and all(r.n_tokens > 0 for r in last)


def test_pipeline_on_an_empty_table(spark):
    docs = queries.table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = entry_point.queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    relation = con.sql(entry_point.oracle_sql()[name])
    places = [relation.columns.index(c) for c in columns]
    assert sorted(tuple(repr(r[i]) for i in places) for r in relation.fetchall()) == sorted(tuple(repr(r[c]) for c in columns) for r in result.collect())
