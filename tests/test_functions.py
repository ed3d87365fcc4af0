"""Golden values of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsemill.functions import tags, text, time
from pulsemill.operators.enrich import distinct_tag_sets


@pytest.mark.parametrize("raw, name", [
    ("hello", "hello"),
    ("hello world", "hello-world"),
    ("hello.world", "hello.world"),
    ('hello"world"', "hello-world-"),
    ("hello'world", "hello-world"),
    ("hello/world", "hello-world"),
    ("~component.heartbeat", "~component.heartbeat"),
    ("!component.heartbeat", "-component.heartbeat"),
    ("Δcomponent.heartbeat", "Δcomponent.heartbeat"),
    ("∆component.heartbeat", "∆component.heartbeat"),
    ("~∆component.heartbeat", "~-component.heartbeat"),
    ("∆~component.heartbeat", "∆~component.heartbeat"),
    ("Δ~~x", "Δ~-x"),
    ("a,b-c_d9", "a,b-c_d9"),
    ("a😀b", "a--b"),
    ("é\nz", "--z"),
])
def test_sanitize_name(apply, raw, name):
    assert apply(text.sanitize_name, [raw]) == [f'"{name}"']


def test_sanitize_tag_value(apply):
    raw = ["hello", "hello world", "hello.world", 'hello"world"', "hello'world", "  pad\t", " 　x ", "a\\b", " inner  kept "]
    assert apply(text.sanitize_tag_value, raw) == [
        '"hello"', '"hello world"', '"hello.world"', '"hello\\"world\\""', '"hello\'world"', '"pad"', '"x"', '"a\\b"', '"inner  kept"']


def test_blank(apply):
    assert apply(text.blank, [None, "", " ", "\t\n", "  ", "x", " x ", "​"]) == [True] * 5 + [False] * 3


def test_number_text(apply):
    values = [42422.0, 5.1, 12.0, 0.0, -0.0, -3.25, 1e7, 12345678.5, 999999999999999.0, 1e15, 1.5e22, 0.001, 0.0001, 0.00012, 1e-5,
              -1.25e-7, 1e100, 4.75752e21, 0.1 + 0.2, 5e-324, 123456789012345680.0]
    assert apply(text.number_text, values, "double") == [
        "42422", "5.1", "12", "0", "0", "-3.25", "10000000", "12345678.5", "999999999999999", "1E+15", "1.5E+22", "0.001", "0.0001",
        "0.00012", "1E-05", "-1.25E-07", "1E+100", "4.75752E+21", "0.30000000000000004", "4.9E-324", "1.2345678901234568E+17"]


def test_number_text_names_the_same_number(apply):
    import random

    rng = random.Random(7)
    values = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-30, 30) for _ in range(2000)]
    assert [float(t) for t in apply(text.number_text, values, "double")] == values


def test_semver(apply):
    versions = ["", None, "1.1.0", "1.1.0-SNAPSHOT", "1.1.1", "1.10.1", "1.1.10", "1.0.1", "1.0.10", "1.10.10", "v2.3.4", "1.2", "1.123.4"]
    assert apply(text.semver_number, versions) == [
        0.0, 0.0, 1.01, 1.01, 1.0101, 1.1001, 1.011, 1.0001, 1.001, 1.101, 2.0304, 0.0, 1.12304]


def test_delta_and_source(apply):
    assert apply(text.delta_name, ["a", "∆a", "Δa", "~a"]) == ["∆a", "∆a", "Δa", "∆~a"]
    assert apply(lambda c: text.with_default_source(c, "host"), [None, " ", "s"]) == ["host", "host", "s"]
    assert apply(text.with_default_source, [None]) == ["unknown"]


def test_epoch_columns(spark):
    at = dt.datetime(2019, 1, 1, 23, 59, 59, 999000)
    fine = dt.datetime(2019, 1, 1, 0, 0, 1, 234567)
    rows = spark.createDataFrame([(at, fine)], "a timestamp_ntz, b timestamp_ntz").select(
        time.epoch_ms(F.col("a")), time.epoch_us(F.col("a")), time.epoch_ms(F.col("b")), time.epoch_us(F.col("b")),
        time.duration_us(F.col("b"), F.col("a"))).first()
    assert tuple(rows) == (1546387199999, 1546387199999000, 1546300801234, 1546300801234567, 86398764433)


def test_bin_start(apply):
    assert apply(time.bin_start, [0, 59_999, 60_000, 119_999], "bigint") == [0, 0, 60_000, 60_000]
    assert apply(lambda c: time.bin_start(c, 3_600_000), [3_599_999, 7_200_001], "bigint") == [0, 7_200_000]


APP = ["application", "service", "cluster", "shard", "custom"]
APP_SCHEMA = "application string, service string, cluster string, shard string, custom map<string,string>"


def test_app_point_tags(spark):
    rows = spark.createDataFrame([
        ("app1", "service1", "us-west", "db1", {"env": "production", "location": "SF"}),
        ("app1", "service1", None, None, {"service": "other", "shard": "x"}),
        ("app1", "service1", None, None, None),
    ], APP_SCHEMA)
    got = [r[0] for r in rows.select(tags.app_point_tags(*[F.col(c) for c in APP])).collect()]
    assert got[0] == {"application": "app1", "service": "service1", "cluster": "us-west", "shard": "db1", "env": "production", "location": "SF"}
    assert got[1] == got[2] == {"application": "app1", "service": "service1", "cluster": "none", "shard": "none"}


def test_tags_from_properties(apply):
    props = {"my_var1": "var_value1", "my_var2": "var_value2", "not_my_var3": "var_value3", "VERSION": "1.0", "MY_blank": " "}
    kind = "map<string,string>"
    assert apply(lambda c: tags.tags_by_pattern(c, "^MY.*$"), [props], kind) == [{"my_var1": "var_value1", "my_var2": "var_value2"}]
    assert apply(lambda c: tags.tag_from_property(c, "VERSION", "ver"), [props], kind) == [{"ver": "1.0"}]
    assert apply(lambda c: tags.tag_from_property(c, "MY_blank", "b"), [props], kind) == [{}]
    assert apply(lambda c: tags.tag_from_property(c, "absent", "b"), [props], kind) == [{}]


SETS = [
    {"application": "myApp", "service": "myService", "customId": "123"},
    {"service": "myService", "application": "myApp", "customId": "123"},
    {"application": "myApp", "service": "myService", "customId": "456"},
    {"application": "myApp", "service": "myService"},
]


def test_tag_sets_compare_by_content(spark, apply):
    one, two, three, four = apply(tags.canonical_tags, SETS, "map<string,string>")
    assert one == two and len({one, three, four}) == 3
    rows = spark.createDataFrame([(s,) for s in SETS], "tags map<string,string>")
    assert sorted(r["n_rows"] for r in distinct_tag_sets(rows).collect()) == [1, 1, 2]


def test_canonical_tags_keep_marks_apart(apply):
    a, b = apply(tags.canonical_tags, [{"a": "b=c"}, {"a=b": "c"}], "map<string,string>")
    assert a != b


def test_tag_set_operations(spark):
    row = spark.createDataFrame([(SETS[0], SETS[2])], "a map<string,string>, b map<string,string>").select(
        tags.tag_difference(F.col("a"), F.col("b")).alias("d"), tags.first_wins(F.col("a"), F.col("b")).alias("f"),
        tags.last_wins(F.col("a"), F.col("b")).alias("l")).first()
    assert [(e["key"], e["value"]) for e in row["d"]] == [("customId", "123")]
    assert row["f"] == SETS[0] and row["l"] == SETS[2]
