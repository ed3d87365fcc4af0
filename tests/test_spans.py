"""Joins of spans and logs carry short rows."""

import datetime

import pytest

from pulsemill import model
from pulsemill.operators import ranges, spans
from pulsemill.plans import spans as plans
from pulsemill.plans import views

USUAL = "0123abcd-0000-1111-2222-0123456789ab"


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two orders with three lines, one of which has a discount and one an order whose logs name unknown spans."""
    path, day = str(tmp_path_factory.mktemp("tables")), datetime.date(2024, 1, 2)
    lines = [(1, 2, 3, 1, 5.0, 10.0, 0.1, 0.0, "A", "F", day), (1, 2, 3, 2, 5.0, 10.0, 0.0, 0.0, "N", "O", day), (50, 2, 3, 1, 5.0, 10.0, None, 0.0, "R", None, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(1, 7, "1-URGENT", 99.5, "O", day), (50, 7, "2-HIGH", 5.0, "F", day)], "o_orderkey long, o_custkey long, o_orderpriority string, "
                          "o_totalprice double, o_orderstatus string, o_orderdate date").write.parquet(f"{path}/orders.parquet")
    return path


def test_flagged_spans_are_joined_by_packed_ids(spark):
    ids = [(USUAL, USUAL), (USUAL, USUAL.upper()), ("t" * 16, "s" * 15), ("", "s"), (None, "s"), (USUAL, None), ("t", "s\x00")]
    rows = spark.createDataFrame([("n", 1, 2, "s", t, i, [USUAL, None, "p" * 16], [], [("k", "1")]) for t, i in ids], model.SPANS)
    logs = spark.createDataFrame([(t, i, 5, {"a": "b"}) for t, i in [*ids[1:6:2], *ids[2:5:2], ids[1], ("t", "s")]], model.SPAN_LOGS)
    flagged = spans.flag_spans(rows, logs)
    assert sorted(flagged.columns) == sorted([*rows.columns, "has_logs"]) and "unhex" in plan(flagged)
    got = {(r["trace_id"], r["span_id"]): r for r in flagged.collect()}
    assert {k: r["has_logs"] for k, r in got.items()} == dict(zip(ids, [False, True, True, True, False, False, False]))
    assert all(r["parents"] == [USUAL, None, "p" * 16] and r["follows_from"] == [] for r in got.values())


def test_envelopes_of_a_query_carry_spans_and_not_their_lines(spark, folder):
    rows = plans.encode_span_logs_json(spark, folder)
    assert "unhex" in plan(rows)
    got = [r["line"] for r in rows.collect()]
    assert len(got) == 3 and sum(line.endswith('"span":null}') for line in got) == 1
    assert sum('_spanLogs' in line for line in got) == 2 and sum(line.count('"timestamp"') for line in got) == 4


def test_ids_of_logs_read_no_entries(spark, folder):
    logs = views.logs(spark, folder)
    assert "l_extendedprice" not in logs.select(*spans.SPAN_KEY)._jdf.queryExecution().executedPlan().toString()
    day = 1_704_153_600_000_000
    assert sorted((r["ts_us"] or 0, sorted(r["fields"].items())) for r in logs.collect()) == [
        (0, [("event", None), ("flag", "R\n")]), (day + 1, [("event", 'status "F"'), ("flag", "A\n")]),
        (day + 2, [("event", 'status "O"'), ("flag", "N\n")]), (day + 1000, [("price", "10")])]


def test_hot_keys_are_named_in_the_pass_that_counts(spark, monkeypatch):
    rows = spark.range(0, 300, 1, 3).selectExpr("CASE WHEN id < 250 THEN 'hot' ELSE CAST(id AS STRING) END AS key")
    hot = rows.selectExpr("xxhash64(key) AS h").first()["h"]

    def counted(df):
        raise AssertionError("a pass of its own")

    monkeypatch.setattr(type(rows), "count", counted)
    assert ranges.hot_keys(rows, ["key"], 200) == [hot] and ranges.hot_keys(rows, ["key"], 300) == [] and ranges.hot_keys(rows.limit(0), ["key"], 5) == []
