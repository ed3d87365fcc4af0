"""Golden lines and input checks."""

import json

from pyspark.sql import functions as F

from pulsemill import model
from pulsemill.operators import encode, spans, validate

TRACE, SPAN = "7b3bf470-9456-11e8-9eb6-529269fb1459", "0313bafe-9457-11e8-9eb6-529269fb1459"
PARENT, BEFORE = "2f64e538-9457-11e8-9eb6-529269fb1459", "5f64e538-9457-11e8-9eb6-529269fb1459"


def lines(df):
    return [r["line"] for r in df.collect()]


def test_metric_lines(spark):
    rows = [
        ("new-york.power.usage", 42422.0, 1493773500, "localhost", {"datacenter": "dc1"}),
        ("new-york.power.usage", 42422.0, None, "localhost", {"datacenter": "dc1"}),
        ("new-york.power.usage", 42422.0, 1493773500, "localhost", None),
        ("new-york.power.usage", 42422.0, None, " ", None),
        ("new~york.power.usage", 42422.0, 1493773500, "localhost:50050", {" key name~1": " val name 1 ", "Z": 'q"'}),
    ]
    assert lines(encode.encode_metric_lines(spark.createDataFrame(rows, model.POINTS), "fallback")) == [
        '"new-york.power.usage" 42422 1493773500 source="localhost" "datacenter"="dc1"',
        '"new-york.power.usage" 42422 source="localhost" "datacenter"="dc1"',
        '"new-york.power.usage" 42422 1493773500 source="localhost"',
        '"new-york.power.usage" 42422 source="fallback"',
        '"new-york.power.usage" 42422 1493773500 source="localhost:50050" "-key-name-1"="val name 1" "Z"="q\\""',
    ]


def test_delta_lines_have_no_timestamp(spark):
    rows = [("hits", 2.0, 5, "s", None), ("∆hits", 1.5, 5, "s", None), ("hits", 0.0, 5, "s", None), ("hits", -1.0, 5, "s", None)]
    assert lines(encode.encode_delta_lines(spark.createDataFrame(rows, model.POINTS))) == [
        '"∆hits" 2 source="s"', '"∆hits" 1.5 source="s"']


CENTROIDS = [(5.1, 10), (5.1, 2), (12.0, 1), (30.0, 20), (30.0, 25)]


def test_histogram_lines(spark):
    rows = [
        ("request.latency", CENTROIDS, ["!M"], 1493773500, "appServer1", {"region": "us-west"}),
        ("request.latency", CENTROIDS, ["!M"], None, "appServer1", None),
        ("request.latency", [], ["!M"], 1493773500, "appServer1", None),
        ("request.latency", CENTROIDS, [], 1493773500, "appServer1", None),
        ("request.latency", CENTROIDS, ["!M", None], 1493773500, "appServer1", None),
        ("request.latency", [(1.0, 1), (2.0, 1), (1.0, 3)], ["!D", "!M", "!H"], 7, "appServer1", None),
    ]
    dists = spark.createDataFrame(rows, model.DISTRIBUTIONS)
    assert lines(encode.encode_histogram_lines(dists)) == [
        '!M 1493773500 #12 5.1 #1 12 #45 30 "request.latency" source="appServer1" "region"="us-west"',
        '!M #12 5.1 #1 12 #45 30 "request.latency" source="appServer1"',
        *[f'{g} 7 #1 1 #1 2 #3 1 "request.latency" source="appServer1"' for g in ("!M", "!H", "!D")],
    ]
    reasons = [r[0] for r in validate.validate_distributions(dists).select("reject_reason").collect()]
    assert reasons == [None, None, "no_centroids", "no_granularity", "null_granularity", None]


def span(**changes):
    base = {"name": "getAllUsers", "start_ms": 1493773500, "duration_ms": 343500, "source": "localhost", "trace_id": TRACE,
            "span_id": SPAN, "parents": None, "follows_from": None, "tags": None}
    return tuple({**base, **changes}.values())


TAGS = [("application", "Demo"), ("http.method", "GET")]
HEAD = f'"getAllUsers" source="localhost" traceId={TRACE} spanId={SPAN}'


def test_span_lines(spark):
    rows = [
        span(parents=[PARENT], follows_from=[BEFORE], tags=TAGS), span(parents=[PARENT], tags=TAGS), span(tags=TAGS), span(),
        span(parents=[PARENT, BEFORE], tags=[("k", "1"), ("k", "2")]),
    ]
    assert lines(encode.encode_span_lines(spark.createDataFrame(rows, model.SPANS))) == [
        f'{HEAD} parent={PARENT} followsFrom={BEFORE} "application"="Demo" "http.method"="GET" 1493773500 343500',
        f'{HEAD} parent={PARENT} "application"="Demo" "http.method"="GET" 1493773500 343500',
        f'{HEAD} "application"="Demo" "http.method"="GET" 1493773500 343500',
        f"{HEAD} 1493773500 343500",
        f'{HEAD} parent={PARENT} parent={BEFORE} "k"="1" "k"="2" 1493773500 343500',
    ]


LOGS = [
    (TRACE, SPAN, 1493773500139, {"info": "newline:\n"}),
    (TRACE, SPAN, 1493773500123, {"event.kind": '"exception"', "event": "error"}),
    (TRACE, "unknown", 5, {"a/b": "c"}),
]


def test_span_logs(spark):
    logs = spark.createDataFrame(LOGS, model.SPAN_LOGS)
    flagged = spans.flag_spans(spark.createDataFrame([span(), span(span_id=PARENT)], model.SPANS), logs)
    encoded = encode.encode_span_lines(flagged)
    assert sorted(lines(encoded)) == sorted([
        f'{HEAD} "_spanLogs"="true" 1493773500 343500', f"{HEAD.replace(SPAN, PARENT)} 1493773500 343500"])

    joined = encode.encode_span_lines(spans.attach_span_logs(flagged.drop("has_logs"), logs))
    assert {r["span_id"]: r["n_logs"] for r in joined.collect()} == {SPAN: 2, PARENT: 0}
    assert sorted(lines(joined)) == sorted(lines(encoded))
    envelopes = joined.join(spans.group_span_logs(logs), spans.SPAN_KEY).withColumn("span", F.col("line"))
    (line,) = lines(encode.encode_span_logs_json(envelopes))
    assert line.startswith(f'{{"traceId":"{TRACE}","spanId":"{SPAN}","logs":[{{"timestamp":1493773500123,"fields":{{"event":"error",')
    assert json.loads(line)["logs"][1] == {"timestamp": 1493773500139, "fields": {"info": "newline:\n"}}
    assert json.loads(line)["span"] == f'{HEAD} "_spanLogs"="true" 1493773500 343500\n'

    lone = spans.group_span_logs(logs).filter(F.col("span_id") == "unknown").withColumn("span", F.lit(None).cast("string"))
    assert lines(encode.encode_span_logs_json(lone)) == [
        f'{{"traceId":"{TRACE}","spanId":"unknown","logs":[{{"timestamp":5,"fields":{{"a/b":"c"}}}}],"span":null}}']


def test_hot_span_gets_several_complete_envelopes(spark):
    """Every log stays, in order, whether or not a span has more logs than fit in one envelope."""
    rows = [("t", "hot" if i % 3 else "cold", i // 2, {"n": str(i)}) for i in range(300)]
    logs = spark.createDataFrame(rows, model.SPAN_LOGS)
    whole = {r["span_id"]: r["logs"] for r in spans.group_span_logs(logs).collect()}
    chunks = sorted(spans.group_span_logs(logs, max_logs=30).collect(), key=lambda r: (r["span_id"], r["chunk"]))
    assert max(len(r["logs"]) for r in chunks) == 30
    for name in ("hot", "cold"):
        assert [e for r in chunks if r["span_id"] == name for e in r["logs"]] == whole[name]
    sent = spans.attach_span_logs(spark.createDataFrame([span(trace_id="t", span_id="hot")], model.SPANS), logs)
    assert [r["n_logs"] for r in encode.encode_span_lines(sent).collect()] == [200]  # one line, however many envelopes
    parted = spans.group_span_logs(logs, max_logs=30, split=True).collect()
    assert sorted(parted, key=lambda r: (r["span_id"], r["chunk"])) == chunks


def test_admitted_logs_and_edges(spark):
    logs = spark.createDataFrame(LOGS, model.SPAN_LOGS)
    sent = spark.createDataFrame([span(parents=[PARENT], follows_from=[BEFORE, PARENT]), span(span_id="root")], model.SPANS)
    assert spans.admitted_span_logs(logs, sent).count() == 2
    assert spans.admitted_span_logs(logs, sent, kept=False).count() == 1
    edges = sorted((r["span_id"], r["kind"], r["target_id"] or "") for r in spans.span_edges(sent).collect())
    assert edges == sorted([(SPAN, "parent", PARENT), (SPAN, "followsFrom", BEFORE), (SPAN, "followsFrom", PARENT), ("root", "root", "")])


def test_validate_points(spark):
    rows = [
        ("a", 1.0, None, None, {"k": "v"}), (" ", 1.0, None, "s", None), (None, 1.0, None, "s", None), ("∆", 1.0, None, "s", None),
        ("a", float("nan"), None, "s", None), ("a", float("inf"), None, "s", None), ("a", 1.0, None, "s", {" ": "v"}),
        ("a", 1.0, None, "s", {"k": "\t"}), ("a", 1.0, None, "s", {"k": "x\ny"}), ("a", 1.0, None, "s\r", None), ("∆a", 1.0, None, "s", {}),
    ]
    checked = validate.validate_points(spark.createDataFrame(rows, model.POINTS))
    assert [r["reject_reason"] for r in checked.collect()] == [
        None, "blank_name", "blank_name", "bare_delta", "non_finite", "non_finite", "blank_tag_key", "blank_tag_value", "newline",
        "newline", None]
    assert validate.valid(checked).count() + validate.rejected(checked).count() == len(rows)


def test_validate_spans_first_bad_pair_decides(spark):
    rows = [span(tags=[("a", "b"), ("c", ""), ("", "d")]), span(tags=[("", ""), ("c", "")]), span(name=""), span(tags=[("a", "b")])]
    checked = validate.validate_spans(spark.createDataFrame(rows, model.SPANS))
    assert [r["reject_reason"] for r in checked.collect()] == ["blank_tag_value", "blank_tag_key", "blank_name", None]


def test_validate_digest_input(spark):
    rows = [("a", [1.0, 2.0, 3.0], [1, -1]), ("b", [1.0, float("nan")], [0, 1, 5]), ("c", [], [1])]
    checked = validate.validate_digest_input(spark.createDataFrame(rows, "series string, means array<double>, counts array<int>"))
    got = [(r["series"], r["mean"], r["count"], r["reject_reason"]) for r in checked.orderBy("series", "pos").collect()]
    assert [(g[0], g[2], g[3]) for g in got] == [
        ("a", 1, None), ("a", -1, "weight_not_positive"), ("b", 0, "weight_not_positive"), ("b", 1, "non_finite")]


def test_incomplete_spans_and_distributions_are_rejected(spark):
    rows = [span(), span(trace_id=None), span(span_id=None), span(start_ms=None), span(duration_ms=None)]
    got = [r["reject_reason"] for r in validate.validate_spans(spark.createDataFrame(rows, model.SPANS)).collect()]
    assert got == [None, "missing_id", "missing_id", "missing_time", "missing_time"]
    dists = [("a", c, g, 1, "s", None) for c, g in (
        ([(1.0, 2)], ["!M"]), ([(1.0, 2)], ["!M", "!X"]), ([(1.0, None)], ["!M"]), ([(1.0, 1), None], ["!M"]))]
    got = [r["reject_reason"] for r in validate.validate_distributions(spark.createDataFrame(dists, model.DISTRIBUTIONS)).collect()]
    assert got == [None, "unknown_granularity", "null_count", "null_count"]


def test_packed_ids_tell_all_texts_apart(spark):
    from pulsemill.operators import spans

    usual = "0123abcd-4567-89ab-cdef-0123456789ab"
    texts = [None, "", "a", usual, usual.upper(), usual[:-1], usual + "0", usual.replace("-", ""), "x" * 15, "x" * 16, "x" * 17, "x" * 15 + "\0", "x" * 16 + "\0", "é" * 8, "漢字"]
    texts.append(bytes.fromhex(usual.replace("-", "")).decode("latin-1"))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(2)
    packed = rows.withColumn("p", spans.packed_id(F.col("t"))).withColumn("back", spans.unpacked_id(F.col("p"))).collect()
    assert all(r.t == r.back for r in packed) and len({r.p and bytes(r.p) for r in packed if r.t is not None}) == len(texts) - 1
    assert [len(r.p) for r in packed if r.t == usual] == [16]


def test_span_and_log_lines_by_one_join(spark):
    """The same lines as by two joins, and spans and logs go through one exchange each, with packed ids."""
    from pulsemill.operators import spans

    ids = [f"{i:08x}-0000-4000-8000-{i:012x}" for i in range(6)] + ["short"]
    rows = [(" " if i == 3 else f"n {i}", 5, 1, None, s, s, [ids[0], "p"] if i else None, [], [("k", "v")]) for i, s in enumerate(ids)]
    table = spark.createDataFrame(rows, "name string, start_ms long, duration_ms long, source string, trace_id string, span_id string, parents array<string>, "
                                        "follows_from array<string>, tags array<struct<key:string,value:string>>")
    logs = spark.createDataFrame(
        [(s, s, t, {"e": str(t)}) for i, s in enumerate([*ids, "unknown"]) if i != 2 for t in range(i + 1)], "trace_id string, span_id string, ts_us long, fields map<string,string>")
    got = encode.span_and_log_lines(table, logs)
    lines = encode.encode_span_lines(spans.flag_spans(table, logs))
    envelopes = spans.group_span_logs(logs).join(lines.select(*spans.SPAN_KEY, F.col("line").alias("span")), spans.SPAN_KEY)
    want = [("trace", r.line) for r in lines.collect()] + [("spanLogs", r.line) for r in encode.encode_span_logs_json(envelopes).collect()]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) == 6 + 5
    every = encode.encode_span_envelopes(table, logs, "right").collect()
    assert len(every) == 7 and sum(r.span is None for r in every) == 2 and all(r.line for r in every)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "unhex" in plan
