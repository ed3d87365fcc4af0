"""Counters, registry and heartbeats."""

from pyspark.sql import functions as F

from pulsemill.functions.tags import tags_text
from pulsemill.operators import counters

OBS = "name string, kind string, op string, n bigint, value double, ts_ms bigint, id bigint, source string, tags map<string,string>"
SERIES = ("s", {"k": "1"})


def test_counter_totals(spark):
    script = [("c", op, n) for op, n in (("inc", 1), ("inc", 2), ("clear", 0), ("inc", 5), ("dec", 1), ("dec", 2))]
    script += [("never", "inc", 3), ("gone", "inc", 9), ("gone", "clear", 0)]
    rows = spark.createDataFrame([(name, op, n, i // 2, i, *SERIES) for i, (name, op, n) in enumerate(script)],
                                 "name string, op string, n bigint, ts_ms bigint, id bigint, source string, tags map<string,string>")
    assert {r["name"]: r["total"] for r in counters.counter_totals(rows).collect()} == {"c": 2, "never": 3, "gone": 0}


def test_counters_of_other_sources_and_tags_are_others(spark):
    schema = "name string, op string, n bigint, ts_ms bigint, id bigint, source string, tags map<string,string>"
    rows = spark.createDataFrame([
        ("c", "inc", 1, 0, 1, "a", {"k": "1", "j": "2"}), ("c", "inc", 2, 1, 2, "a", {"j": "2", "k": "1"}), ("c", "inc", 4, 2, 3, "b", {"k": "1"}),
        ("c", "inc", 8, 3, 4, None, None), ("c", "clear", 0, 4, 5, None, {}), ("c", "inc", 16, 5, 6, None, {}), ("c", "clear", 0, 6, 7, "b", {"k": "1"}),
    ], schema)
    assert sorted((r["source"] or "", r["total"]) for r in counters.counter_totals(rows).collect()) == [("", 16), ("a", 3), ("b", 0)]
    report = counters.registry_report(rows.withColumns({"kind": F.lit("counter"), "value": F.lit(None).cast("double")}), "p")
    assert sorted((r["source"] or "", r["name"], r["value"]) for r in report.collect()) == [
        ("", "p.c.count", 24.0), ("a", "p.c.count", 3.0), ("b", "p.c.count", 4.0)]


def observations(spark):
    return spark.createDataFrame([(*row, *SERIES) for row in [
        ("g", "gauge", None, None, 1.5, 0, 1), ("g", "gauge", None, None, 2.5, 59_000, 2), ("g", "gauge", None, None, 4.0, 180_000, 3),
        ("c", "counter", "inc", 2, None, 10, 4), ("c", "counter", "dec", 1, None, 20, 5), ("c", "counter", "inc", 5, None, 180_001, 6),
        ("d", "delta", "inc", 5, None, 30, 7), ("d", "delta", "dec", 1, None, 40, 8), ("d", "delta", "dec", 1, None, 60_000, 9),
        ("∆e", "delta", "inc", 1, None, 60_001, 10),
    ]], OBS)


def shown(report):
    return sorted((r["report_ms"], r["name"], r["value"]) for r in report.collect())


def test_registry_report(spark):
    assert shown(counters.registry_report(observations(spark), "p")) == [
        (60_000, "p.c.count", 1.0), (60_000, "p.g", 2.5), (60_000, "∆p.d.count", 4.0), (120_000, "∆p.∆e.count", 1.0),
        (240_000, "p.c.count", 6.0), (240_000, "p.g", 4.0)]


def test_registry_repeats_idle_intervals(spark):
    report = shown(counters.registry_report(observations(spark), fill_idle=True))
    assert [(t, v) for t, n, v in report if n == "g"] == [(60_000, 2.5), (120_000, 2.5), (180_000, 2.5), (240_000, 4.0)]
    assert [(t, v) for t, n, v in report if n == "c.count"] == [(60_000, 1.0), (120_000, 1.0), (180_000, 1.0), (240_000, 6.0)]
    assert [(t, v) for t, n, v in report if n == "∆d.count"] == [(60_000, 4.0)]


def test_gauge_value_is_the_users_column(spark):
    report = counters.registry_report(observations(spark).filter("kind = 'gauge'"), gauge_value=F.col("value") * 10)
    assert shown(report) == [(60_000, "g", 25.0), (240_000, "g", 40.0)]


def test_counter_deltas(spark):
    rows = spark.createDataFrame([("a", i, i, t) for i, t in enumerate([5, 7, 7, 3, 10, 0, 4])], "name string, ts_ms bigint, id bigint, total bigint")
    for split in (False, True):
        got = counters.counter_deltas(rows, split=split).orderBy("ts_ms").collect()
        assert [(r["ts_ms"], r["delta"]) for r in got] == [(1, 2), (3, 3), (4, 7), (6, 4)]


def test_delta_sums(spark):
    rows = spark.createDataFrame([
        ("hits", 2.0, 5, "s", {"a": "1", "b": "2"}), ("∆hits", 3.0, 59_999, "s", {"b": "2", "a": "1"}), ("hits", -4.0, 6, "s", {"a": "1", "b": "2"}),
        ("hits", 1.0, 60_000, "s", {"a": "1", "b": "2"}), ("hits", 7.0, 5, "other", {"a": "1", "b": "2"}), ("Δhits", 1.0, 5, "s", {}),
    ], "name string, value double, ts_ms bigint, source string, tags map<string,string>")
    got = sorted((r["name"], r["source"], r["minute_ms"], r["total"]) for r in counters.delta_sums(rows).collect())
    assert got == sorted([("∆hits", "s", 0, 5.0), ("∆hits", "s", 60_000, 1.0), ("∆hits", "other", 0, 7.0), ("Δhits", "s", 0, 1.0)])


def test_heartbeats(spark):
    rows = spark.createDataFrame([
        (0, "app", "svc", None, "s1", "web", {"env": "p", "component": "x"}, None),
        (299_999, "app", "svc", None, "s1", "web", {"env": "p"}, {"k": "1", "j": "2"}),
        (10, "app", "svc", None, "s1", "db", None, {"j": "2", "k": "1"}),
        (300_000, "app", "svc", "c", "s1", "web", {"env": "p"}, None),
        (300_001, None, None, None, None, None, None, {"j": "3"}),
    ], "ts_ms bigint, application string, service string, cluster string, shard string, component string, custom map<string,string>, "
       "reported_tags map<string,string>").withColumn("source", F.when(F.col("component").isNull(), "s1").otherwise("s0"))
    beats = counters.heartbeats(rows).withColumn("text", tags_text(F.col("tags"))).collect()
    assert {(r["name"], r["value"]) for r in beats} == {("~component.heartbeat", 1.0)}
    base = "application=app,cluster={},component={}{},service=svc,shard=s1".format
    assert sorted((r["window_ms"], r["kind"], r["text"]) for r in beats) == [
        (0, "component", base("none", "db", "")), (0, "component", base("none", "web", ",env=p")), (0, "custom", "j=2,k=1"),
        (300_000, "component", base("c", "web", ",env=p")), (300_000, "custom", "j=3")]
    assert {(r["source"], r["text"]) for r in beats if r["kind"] == "custom"} == {("s0", "j=2,k=1"), ("s1", "j=3")}
