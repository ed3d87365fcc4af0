"""Ordered calculations: the split way equals the plain way, whatever the skew."""

import random

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import ranges


@pytest.fixture(autouse=True, scope="module")
def many_small_parts(spark):
    """Small test data would otherwise be coalesced into one partition without seams."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = rng.choice(["hot", "hot", f"k{rng.randint(0, 40)}", None])
        rows.append((key, rng.randint(0, 50), i, rng.randint(-5, 9)))
    return spark.createDataFrame(rows, "key string, ts bigint, id bigint, amount bigint").repartition(7)


def order():
    return [F.col("ts"), F.col("id")]


def brute(rows, visit):
    out, state = {}, {}
    for r in sorted(rows, key=lambda r: (r["key"] or "", r["ts"], r["id"])):
        out[r["id"]], state[r["key"]] = visit(state.get(r["key"]), r)
    return out


@pytest.mark.parametrize("split", [False, True])
def test_running_sum(skewed, split):
    expected = brute(skewed.collect(), lambda s, r: ((s or 0) + r["amount"],) * 2)
    got = ranges.running_sum(skewed, ["key"], order(), F.col("amount"), "total", split)
    assert {r["id"]: r["total"] for r in got.collect()} == expected


@pytest.mark.parametrize("split", [False, True])
def test_row_rank_descending(skewed, split):
    backwards = [F.col("ts").desc(), F.col("id").desc()]
    got = {r["id"]: r["n"] for r in ranges.row_rank(skewed, ["key"], backwards, "n", split).collect()}
    sizes, ascending = {}, brute(skewed.collect(), lambda s, r: ((s or 0) + 1,) * 2)
    keys = {r["id"]: r["key"] for r in skewed.collect()}
    for i, k in keys.items():
        sizes[k] = sizes.get(k, 0) + 1
    assert got == {i: sizes[keys[i]] + 1 - n for i, n in ascending.items()}


@pytest.mark.parametrize("split", [False, True])
def test_previous_value(skewed, split):
    expected = brute(skewed.collect(), lambda s, r: (s, r["amount"]))
    got = ranges.previous_value(skewed, ["key"], order(), "amount", "before", split)
    assert {r["id"]: r["before"] for r in got.collect()} == expected


def test_split_spreads_the_hot_key(skewed):
    parts = ranges._range_parts(skewed, ["key"], order())
    hot = parts.filter("key = 'hot'").groupBy("_part").count().collect()
    assert len(hot) >= 2


def names_of(spark, df, keys, hashes):
    return {r["key"] for r in df.select("key", F.xxhash64(*keys).alias("h")).distinct().collect() if r["h"] in set(hashes)}


def test_only_hot_keys_are_named(spark, skewed):
    assert names_of(spark, skewed, ["key"], ranges.hot_keys(skewed, ["key"], 500)) == {"hot", None}
    assert ranges.hot_keys(skewed, ["key"], 5000) == [] == ranges.hot_keys(skewed, ["id"], 500) == ranges.hot_keys(skewed.limit(0), ["key"], 0)
    # Among two hundred thousand keys, the three that hold two hundredths of the rows each stand out.
    many = spark.range(0, 200_000, 1, 9).select(F.when(F.col("id") % 50 < 3, F.col("id") % 50).otherwise(F.col("id")).cast("string").alias("key"))
    assert names_of(spark, many, ["key"], ranges.hot_keys(many, ["key"], 3000)) == {"0", "1", "2"}


def test_cold_keys_take_the_plain_window(skewed):
    auto = ranges.row_rank(skewed, ["key"], order(), "n", hot_rows=500)
    plain = ranges.row_rank(skewed, ["key"], order(), "n", split=False)
    assert sorted(map(tuple, auto.select("id", "n").collect())) == sorted(map(tuple, plain.select("id", "n").collect()))
    lagged = ranges.previous_value(skewed, ["key"], order(), "amount", "before", hot_rows=500)
    plain = ranges.previous_value(skewed, ["key"], order(), "amount", "before", split=False)
    assert sorted(map(str, lagged.select("id", "before").collect())) == sorted(map(str, plain.select("id", "before").collect()))
    # What was range-partitioned and written holds the rows of the hot keys alone.
    spread = []
    assert ranges._by_heat(skewed, ["key"], None, 500, lambda df: df, lambda df: spread.append(df) or df).count() == 3000
    assert {r["key"] for r in spread[0].select("key").distinct().collect()} == {"hot", None}


@pytest.mark.parametrize("split", [False, True])
def test_totals_and_sizes(skewed, split):
    got = ranges.running_sum(skewed, ["key"], order(), F.col("amount"), "run", split, total="total", size="size")
    expected = skewed.groupBy("key").agg(F.sum("amount"), F.count(F.lit(1))).collect()
    assert sorted(map(str, got.select("key", "total", "size").distinct().collect())) == sorted(
        f"Row(key={r[0]!r}, total={r[1]}, size={r[2]})" for r in expected)


@pytest.mark.parametrize("window_rows", [100_000, 40, 1])
def test_first_rows(spark, skewed, window_rows):
    before = dict(spark.conf.getAll)
    for n in (1, 20, 700, 5000):
        ranks = ranges.row_rank(skewed, ["key"], order(), "n", split=False).filter(F.col("n") <= n)
        got = ranges.first_rows(skewed, ["key"], "ts", "id", n, window_rows)
        assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in ranks.collect())
        if window_rows < 100:
            break
    assert dict(spark.conf.getAll) == before


@pytest.mark.parametrize("window_rows", [100_000, 3])
def test_cutoffs_follow_the_order_of_texts_and_numbers(spark, window_rows):
    rng = random.Random(4)
    texts = ["", "a", "aa", "aé", "b", "é", "漢", "id-0001", "id-0002", "id-00020", "z" * 70, "z" * 70 + "a", None]
    rows = [(k, rng.choice([-(10**12), -1, 0, 5, 10**15, None]), t, i) for k in ("x", None) for i, t in enumerate(texts * 3)]
    table = spark.createDataFrame([(k, ts, t, i * (-1) ** i * 10**9) for k, ts, t, i in rows], "key string, ts bigint, text string, number bigint")
    for tie in ("text", "number"):
        for n in (1, 7, 20):
            marked = ranges.within_cutoff(table, ranges.cutoffs(table, ["key"], "ts", tie, n, window_rows), ["key"], "ts", tie, "in")
            for key in ("x", None):
                held = [(r["ts"], r[tie], r["in"]) for r in marked.collect() if r["key"] == key]
                rank = lambda x: tuple((v is not None, v.encode() if isinstance(v, str) else v or 0) for v in x[:2])
                cut = rank(sorted(held, key=rank)[n - 1])
                assert all(inside == (rank((ts, t)) <= cut) for ts, t, inside in held)


def test_cutoffs_sort_no_rows_of_a_task(spark, skewed, monkeypatch):
    plans, write = [], ranges.materialise
    monkeypatch.setattr(ranges, "materialise", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, label))
    ranges.cutoffs(skewed, ["key"], "ts", "id", 20, 1).collect()
    assert len(plans) > 1 and not any("SortAggregate" in p for p in plans)


def test_cutoffs_of_equal_rows(spark):
    table = spark.range(50).select(F.lit("k").alias("key"), F.lit(1).cast("bigint").alias("ts"), F.lit("same").alias("id"))
    assert [r["_cut"][:] for r in ranges.cutoffs(table, ["key"], "ts", "id", 10, 5).collect()] == [(1, "same")]


def test_broadcast_is_bounded_by_bytes(spark):
    rows = spark.createDataFrame([(i, {"k": "x" * 100}) for i in range(20)], "id int, tags map<string,string>")
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(ranges.broadcast_if_small(rows)) and "broadcast" not in plan(ranges.broadcast_if_small(rows, 1000))
    assert "broadcast" in plan(ranges.broadcast_if_small(rows.limit(0)))


def test_a_scan_of_one_row_group_is_dealt_whatever_its_bytes(spark, tmp_path):
    """As many splits as cores, but one row group: all rows are those of one task. Work on rows stays behind the shuffle."""
    path = str(tmp_path / "one.parquet")
    spark.range(0, 30_000, 1, 1).selectExpr("id", "md5(CAST(id AS STRING)) AS text").write.parquet(path)
    with_split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        scan = spark.read.parquet(path)
        assert scan.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        rows = ranges.dealt(scan, least_rows=1000)
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 10_000 and sum(sizes) == 30_000
        checked = rows.withColumn("checked", F.sha2("text", 256)).filter(F.col("checked") > "4")
        plan = checked._jdf.queryExecution().executedPlan().toString()
        assert "sha2" not in plan[plan.index("Exchange"):]
        assert sorted(r["id"] for r in rows.select("id").collect()) == list(range(30_000))
        even = spark.range(0, 30_000, 1, 4)
        assert ranges.dealt(even, least_rows=1000) is even
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", with_split)
