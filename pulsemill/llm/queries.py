"""One registered query for each operator, over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm import (
    alignment, bpe, decontamination, language_id, lexical_search, multi_index, pii, quality_classifier, quality_rules, secret_scan, simhash,
    substring_dedup, token_counts,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _fold(count: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % count


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    entries = quality_rules.apply_policy(quality_rules.ledger(table(spark, folder, "documents")))
    base = F.col("failed_bits").bitwiseAND(F.lit(quality_rules.BASE_MASK).cast("long")) != 0
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed_bits")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.detect(table(spark, folder, "documents"))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{pii.KINDS[k]}") for k in range(4)]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def _of_kind(k: int):
    return lambda x: x["kind"] == k


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    weights = quality_classifier.train(docs, table(spark, folder, "labels"), _fold(5) != 0)
    scores = quality_classifier.score(docs, weights)
    return scores.select(
        "doc_id", (_fold(5) == 0).alias("held_out"), "score", F.when(F.col("score") >= quality_classifier.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count(table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), ids=False)


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeated(table(spark, folder, "documents"), texts=False)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language_id.predict(docs, language_id.train(docs, _fold(4) != 2))
    return found.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_and_count(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_decontamination, op3_simhash, op4_pii, op5_quality_classifier, op6_secret_scan, op7_token_counts, op8_bpe,
    op9_substring_dedup, op10_language_id, op11_alignment, op12_lexical_search, op13_multi_index)}

SQL = {
    "op1_quality_rules": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(array_to_string(ws, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines
  FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
f AS (
  SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 5 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS BIGINT) AS failed_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       failed_bits = 0 AS kept, failed_bits
FROM f""",
    "op9_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM g) WHERE n > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r),
k AS (SELECT doc_id, ws[i] AS word, i FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
l AS (SELECT k.doc_id, string_agg(k.word, ' ' ORDER BY k.i) AS kept, count(*) AS n FROM k ANTI JOIN c ON c.doc_id = k.doc_id AND c.i = k.i GROUP BY k.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(l.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(l.kept, '')) AS kept_sha256
FROM w LEFT JOIN l ON l.doc_id = w.doc_id""",
    "op12_lexical_search": r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
d AS (SELECT doc_id, ts, len(ts) AS n FROM low WHERE len(ts) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
f AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM f GROUP BY t), s),
p AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // terms))))) AS BIGINT) AS score
  FROM i JOIN f USING (t) JOIN w USING (t), s GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
}
