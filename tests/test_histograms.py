"""Digests and histograms against known values, exact order statistics and conservation laws."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import digest, histograms, validate

POWERS = [(0.1, 1), (1.0, 1), (10.0, 2), (100.0, 1), (1000.0, 1), (10000.0, 2), (100000.0, 1)]


def samples(spark, values, series="s", ts=0):
    return spark.createDataFrame([(series, ts, float(v)) for v in values], "series string, ts_ms bigint, value double")


def one(spark, values):
    return histograms.histogram_bins(samples(spark, values), bin_ms=None)


def ask(rows, *qs):
    return {r["q"]: r["value"] for r in digest.quantiles(rows, ["series"], qs).collect()}


@pytest.fixture(scope="module")
def powers(spark):
    bulk = spark.createDataFrame([("s", m, c) for m, c in POWERS], "series string, mean double, count int")
    return histograms.histogram_bulk(bulk, ["series"])


def test_power_set(powers):
    row = histograms.histogram_stats(powers, ["series"]).first()
    assert (row["count"], row["size"], row["min"], row["max"]) == (9, 7, 0.1, 100000.0)
    assert row["sum"] == pytest.approx(121121.1) and row["mean"] == pytest.approx(13457.9, abs=0.05)
    assert ask(powers, 0.5) == {0.5: 100.0}
    values = sorted(r["value"] for r in histograms.histogram_values(powers, ["series"]).collect())
    assert values == [m for m, c in POWERS for _ in range(c)]


def test_one_to_thousand(spark):
    rows = one(spark, range(1, 1001)).cache()
    assert 64 < rows.count() < 200
    row = histograms.histogram_stats(rows, ["series"]).first()
    assert (row["count"], row["sum"], row["mean"], row["min"], row["max"]) == (1000, 500500.0, 500.5, 1.0, 1000.0)
    assert round(row["stddev"]) == 289
    bounds = {0.5: (490.5, 510.5), 0.75: (745.5, 755.5), 0.95: (949, 952), 0.98: (980, 981), 0.99: (990, 991), 0.999: (999, 1000)}
    for q, value in ask(rows, *bounds).items():
        assert bounds[q][0] <= value <= bounds[q][1]


def test_one_to_hundred(spark):
    rows = one(spark, range(1, 101))
    row = histograms.histogram_stats(rows, ["series"]).first()
    assert (row["count"], row["sum"]) == (100, 5050.0) and round(row["stddev"]) == 29
    assert ask(rows, 0.999)[0.999] == pytest.approx(100, abs=0.05)


def test_quantiles_of_ten_values(spark):
    got = ask(one(spark, range(10)), 0.29999999, 0.3, 0.39999999, 0.8, 0.99999999, 0.0, 1.0)
    assert got == {0.29999999: 2.0, 0.3: 3.0, 0.39999999: 3.0, 0.8: 8.0, 0.99999999: 9.0, 0.0: 0.0, 1.0: 9.0}


def test_quantile_edges(spark):
    rng = random.Random(5)
    values = [rng.random() for _ in range(100)]
    assert ask(one(spark, values), 0.001, 1.0) == {0.001: min(values), 1.0: max(values)}
    assert ask(one(spark, [7.5]), 0.0, 0.5, 1.0) == {0.0: 7.5, 0.5: 7.5, 1.0: 7.5}
    with pytest.raises(ValueError):
        digest.quantiles(one(spark, [1]), ["series"], [1.1])


def test_heavy_ends_interpolate_between_the_extremes(spark):
    rows = spark.createDataFrame(
        [("s", 1.5, 2, 1.0, 2.0), ("s", 5.0, 6, 4.0, 6.0), ("s", 9.0, 2, 8.5, 9.5)],
        "series string, mean double, weight bigint, lo double, hi double")
    got = ask(rows, 0.0, 0.15, 0.5, 0.85, 1.0)
    assert got == {0.0: 1.0, 0.15: 2.0, 0.5: 5.0, 0.85: 8.5, 1.0: 9.5}


def test_every_key_and_quantile_answers_once(spark):
    rng = random.Random(11)
    rows = [(f"s{k}", 0, float(rng.choice([rng.randint(0, 20), rng.gauss(0, 100)]))) for k in range(12) for _ in range(1 + k * k * 6)]
    bins = histograms.histogram_bins(spark.createDataFrame(rows, "series string, ts_ms bigint, value double"), bin_ms=None)
    qs = [i / 40 for i in range(41)]
    got = digest.quantiles(bins, ["series"], qs).collect()
    assert len(got) == 12 * 41
    for k in range(12):
        values = sorted(v for s, _, v in rows if s == f"s{k}")
        answers = [r["value"] for r in sorted((r for r in got if r["series"] == f"s{k}"), key=lambda r: r["q"])]
        assert answers == sorted(answers) and answers[0] == values[0] and answers[-1] == values[-1]
        for q, a in zip(qs, answers):
            # The answer's true rank is within two percent of the asked one, plus a step for few values.
            low, high = sum(v < a for v in values) / len(values), sum(v <= a for v in values) / len(values)
            assert low - 0.02 - 1.5 / len(values) <= q <= high + 0.02 + 1.5 / len(values)


def test_counts_of_repeated_and_extreme_values(spark):
    rows = one(spark, [0.0] * 100 + [-1.0])
    assert {(r["mean"], r["weight"]) for r in rows.collect()} == {(0.0, 100), (-1.0, 1)}
    kept = one(spark, [1.0, float("nan"), float("inf"), 2.0])
    assert sorted(r["mean"] for r in kept.collect()) == [1.0, 2.0]


def test_small_digests_stay_exact(spark):
    values = [i / 7 for i in range(64)]
    assert sorted(r["mean"] for r in one(spark, values).collect()) == values


@pytest.fixture
def seams(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_split_digest_is_the_same_digest(spark, seams):
    rng = random.Random(2)
    values = samples(spark, [rng.expovariate(0.1) for _ in range(4000)]).unionByName(samples(spark, range(30), "small"))
    plain = histograms.histogram_bins(values, bin_ms=None, split=False)
    split = histograms.histogram_bins(values, bin_ms=None, split=True)

    def rows(df):
        return sorted((r["series"], round(r["mean"], 9), r["weight"], r["lo"], r["hi"]) for r in df.collect())

    assert rows(plain) == rows(split)


def test_merging_writers_keeps_counts_and_quantiles(spark):
    rng = random.Random(8)
    values = [rng.gauss(50, 20) for _ in range(6000)]
    rows = spark.createDataFrame([("s", i % 5, v, 1) for i, v in enumerate(values)], "series string, writer int, mean double, weight bigint")
    keys = ["series", "writer"]
    parts = digest.compress_digest(digest.as_digest(rows, keys), keys)
    merged = digest.merge_digests(parts, ["series"]).cache()
    assert merged.agg(F.sum("weight")).first()[0] == 6000
    assert merged.agg(F.min("lo"), F.max("hi")).first()[:] == (min(values), max(values))
    values.sort()
    for q, value in ask(merged, 0.01, 0.25, 0.5, 0.75, 0.99).items():
        rank = sum(v <= value for v in values) / len(values)
        assert abs(rank - q) < 0.01


def test_empty_histogram(spark):
    keys = spark.createDataFrame([("s",), ("none",)], "series string")
    stats = {r["series"]: r for r in histograms.histogram_stats(one(spark, [1, 3]), ["series"], keys).collect()}
    assert stats["s"]["count"] == 2 and stats["s"]["stddev"] == 1.0
    empty = stats["none"]
    assert (empty["count"], empty["stddev"], empty["size"]) == (0, 0.0, 0) and math.isnan(empty["mean"])


def test_rollup_and_flush(spark):
    minute, hour, day = 60_000, 3_600_000, 86_400_000
    rows = [("s", 0, 1.0), ("s", minute, 2.0), ("s", hour, 2.0), ("s", day + 5, 4.0), ("s", day + minute + 5, 8.0)]
    bins = histograms.histogram_bins(spark.createDataFrame(rows, "series string, ts_ms bigint, value double"))
    rolled = histograms.histogram_rollup(bins).groupBy("granularity", "start_ms").agg(F.sum("weight").alias("n")).collect()
    assert sorted((r["granularity"], r["start_ms"], r["n"]) for r in rolled) == [
        ("!D", 0, 3), ("!D", day, 2), ("!H", 0, 2), ("!H", hour, 1), ("!H", day, 2),
        ("!M", 0, 1), ("!M", minute, 1), ("!M", hour, 1), ("!M", day, 1), ("!M", day + minute, 1)]
    flushed = sorted(histograms.flush_order(bins, day + minute + 30).collect(), key=lambda r: r["pos"])
    assert [(r["pos"], r["minute_ms"]) for r in flushed] == [(1, day), (2, hour), (3, minute), (4, 0)]


def test_only_the_newest_bins_are_retained(spark):
    rows = [("a", i * 60_000, float(i)) for i in range(15)] + [("b", i * 60_000, 1.0) for i in range(3)]
    bins = histograms.histogram_bins(spark.createDataFrame(rows, "series string, ts_ms bigint, value double"))
    kept = sorted((r["series"], r["minute_ms"] // 60_000) for r in histograms.retain_recent_bins(bins).collect())
    assert kept == [("a", i) for i in range(4, 15)] + [("b", i) for i in range(3)]


def test_serialized_text_and_round_trip(spark):
    rows = [("s", 60_000, 0.01), ("s", 0, 10.0), ("s", 0, 10.0), ("s", 0, 0.1), ("s", 0, 1e20), ("s", 86_400_000, 5.0)]
    bins = histograms.histogram_bins(spark.createDataFrame(rows, "series string, ts_ms bigint, value double"))
    pairs = histograms.serialize_bins(bins).orderBy("period_ms")
    assert [(r["timestamps"], r["centroids"]) for r in pairs.collect()] == [("0;60000", "0.1 1,10 2,1E+20 1;0.01 1"), ("86400000", "5 1")]

    def shown(df):
        return sorted((r["series"], r["minute_ms"], r["mean"], r["weight"]) for r in df.collect())

    assert shown(histograms.deserialize_bins(pairs)) == shown(bins)
    uneven = spark.createDataFrame([("s", "0;60000;120000", "1 1,2.5 3;4 1")], "series string, timestamps string, centroids string")
    assert shown(histograms.deserialize_bins(uneven)) == [("s", 0, 1.0, 1), ("s", 0, 2.5, 3), ("s", 60_000, 4.0, 1)]


def test_heavy_centroid_is_expanded_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(histograms, "REPEAT_BLOCK", 10)
    rows = spark.createDataFrame([("s", 1.0, 1234), ("s", 2.0, 1), ("s", 3.0, 100)], "series string, mean double, weight bigint")
    counts = histograms.histogram_values(rows, ["series"]).groupBy("value").count().collect()
    assert {r["value"]: r["count"] for r in counts} == {1.0: 1234, 2.0: 1, 3.0: 100}


def test_bulk_leaves_out_weights_that_are_not_positive(spark):
    rows = spark.createDataFrame([("s", 0, 1.0, 1), ("s", 0, 2.0, -1), ("s", 0, 3.0, None), ("s", 0, float("nan"), 2)], "series string, minute_ms bigint, mean double, count int")
    (only,) = histograms.histogram_bulk(rows).collect()
    assert only["mean"] == 1.0
    assert validate.rejected_samples(rows.withColumnRenamed("mean", "value")).count() == 1


def test_tasks_send_digests_and_not_values(spark):
    """Half a million distinct doubles under three keys, one with most rows: a few hundred rows per key and task leave a task."""
    rows = spark.range(0, 500_000, 1, 8).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 2).cast("string"))).alias("series"),
        F.lit(0).cast("bigint").alias("ts_ms"), (F.rand(7) * 1000).alias("value"))
    values = rows
    sent = digest.partial_digests(values.select("series", F.col("value").alias("mean")), ["series"])
    per = sent.groupBy("series", F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert 100 < per[0] < 600 and per[1] < 3 * 8 * 600
    bins = histograms.histogram_bins(values, bin_ms=None)
    plan = bins._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.index("Exchange") and "Exchange" not in plan[plan.index("MapInArrow"):]
    sizes = {r["series"]: (r["n"], r["size"]) for r in bins.groupBy("series").agg(F.sum("weight").alias("n"), F.count("*").alias("size")).collect()}
    assert {k: n for k, (n, _) in sizes.items()} == {"hot": 400_000, "s0": 50_000, "s1": 50_000} and all(s < 300 for _, s in sizes.values())
    hot = sorted(r["value"] for r in values.where("series = 'hot'").collect())
    for q, value in digest.quantiles(bins.where("series = 'hot'"), ["series"], [0.001, 0.1, 0.5, 0.9, 0.999]).select("q", "value").collect():
        rank = sum(v <= value for v in hot) / len(hot)
        assert abs(rank - q) < 0.15 * min(q, 1 - q)


def test_partial_digests_of_one_task_change_nothing(spark):
    """A key in one task gets the digest that it gets without partial digests, also when the task clusters several times."""
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 1), float(rng.randrange(40)), -0.0, 0.0])) for _ in range(6000)]
    table = spark.createDataFrame(rows, "series string, value double").withColumn("ts_ms", F.lit(5).cast("bigint")).coalesce(1)

    def shown(df):
        return sorted((r["series"] or "", round(r["mean"], 9) + 0.0, r["weight"], r["lo"] + 0.0, r["hi"] + 0.0) for r in df.collect())

    assert shown(histograms.histogram_bins(table)) == shown(histograms.histogram_bins(table, split=False))


def test_a_task_with_many_keys_holds_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(digest, "HELD_ROWS", 700)
    rows = spark.range(0, 20_000, 1, 2).select((F.col("id") % 3000).cast("string").alias("series"), F.lit(0).cast("bigint").alias("ts_ms"), F.col("id").cast("double").alias("value"))
    bins = histograms.histogram_bins(rows, bin_ms=None)
    assert bins.agg(F.sum("weight"), F.countDistinct("series"), F.min("lo"), F.max("hi")).first()[:] == (20_000, 3000, 0.0, 19_999.0)
    empty = histograms.histogram_bins(rows.limit(0))
    assert empty.count() == 0 and empty.columns == ["series", "minute_ms", "mean", "weight", "lo", "hi"]


def test_a_digest_does_not_depend_on_how_tasks_are_cut(spark):
    """Rows of a key in many tasks, some values in several of them, give the digest of all its distinct values."""
    rows = spark.range(0, 6000, 1, 7).select(F.lit("a").alias("series"), F.expr("double(id * 7919 % 4001) / 100").alias("mean"), F.expr("id % 3 + 1").alias("weight"))
    keys = ["series"]

    def shown(digest_rows):
        return sorted((round(r["mean"], 9), r["weight"], r["lo"], r["hi"]) for r in digest_rows.collect())

    wanted = shown(digest.compress_digest(digest.as_digest(rows, keys), keys, False))
    assert shown(digest.exact_digests(rows, keys)) == shown(digest.exact_digests(rows.coalesce(1), keys)) == wanted
    assert sum(r[1] for r in wanted) == 12000
    samples = rows.withColumns({"ts_ms": F.lit(0).cast("bigint"), "value": F.col("mean")})
    bins = histograms.histogram_bins(samples.select("series", "ts_ms", "value"), exact=True)
    assert shown(bins) == shown(digest.compress_digest(digest.as_digest(rows.withColumn("weight", F.lit(1)), keys), keys, False))


def test_values_of_one_scan_task_are_counted_in_many(spark):
    """A scan of one huge row group: what it holds must not depend on its rows."""
    rows = spark.range(0, 4000, 1, 1).selectExpr(
        "concat('s', id % 3) AS series", "CASE WHEN id % 4 = 0 THEN 7.5D ELSE double(id % 1500) END AS mean", "CAST(id % 5 + 1 AS BIGINT) AS weight")

    def shown(counted):
        return sorted(map(tuple, counted.select("series", "mean", "weight", "lo", "hi").collect()))

    wanted = shown(digest.as_digest(rows, ["series"]))
    dealt = digest.count_values(rows, ["series"], task_rows=100)
    assert dealt.rdd.getNumPartitions() == 40 and shown(dealt) == wanted
    hot = digest.count_values(rows, ["series"], task_rows=100, hot_rows=300)
    assert shown(hot) == wanted
    # Nothing is counted below the first shuffle of a large table.
    plan = digest.count_values(rows, ["series"], task_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan[plan.index("Exchange"):]
