"""Streams: closed windows exactly once, across restarts, and equal to the batch result."""

import datetime as dt
import glob
import gzip

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import delivery, encode
from pulsemill.sources.sinks import FileTransport, key_numbers
from pulsemill.streaming import streams

START = dt.datetime(2024, 1, 1)
SCHEMA = "event_time timestamp, series string, value double, id bigint"


def at(minutes, seconds=0):
    return START + dt.timedelta(minutes=minutes, seconds=seconds)


class Feed:
    """A folder that tests add one file at a time to."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0

    def add(self, rows):
        self.n += 1
        stage = f"{self.folder}/stage-{self.n}"
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(stage)
        (part,) = glob.glob(f"{stage}/*.parquet")
        (self.folder / "in").mkdir(exist_ok=True)
        (self.folder / "in" / f"data-{self.n}.parquet").write_bytes(open(part, "rb").read())

    def stream(self, **options):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return streams.read_stream(self.spark, str(self.folder / "in"), "data*.parquet", schema, **options)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_closed_minutes_are_emitted_once_across_restarts(feed, tmp_path):
    bins, checkpoint = str(tmp_path / "bins"), str(tmp_path / "cp")

    def run():
        rows = streams.stream_histogram_bins(feed.stream(), bins, checkpoint).collect()
        return sorted(((r["minute_ms"] - 1704067200000) // 60_000, r["mean"], r["weight"]) for r in rows)

    feed.add([(at(0, 1), "s", 5.0, 1), (at(0, 2), "s", 5.0, 2), (at(1), "s", 7.0, 3)])
    assert run() == []
    feed.add([(at(11, 30), "s", 1.0, 4)])
    assert run() == [(0, 5.0, 2)]
    feed.add([(at(30), "s", 2.0, 5)])
    assert run() == [(0, 5.0, 2), (1, 7.0, 1), (11, 1.0, 1)]
    assert run() == [(0, 5.0, 2), (1, 7.0, 1), (11, 1.0, 1)]


def test_stream_digest_equals_batch_digest(spark, feed, tmp_path):
    from pulsemill.operators.histograms import histogram_bins

    rows = [(at(0, i % 60), "s", float(i * i % 997), i) for i in range(500)] + [(at(60), "s", 0.0, 999)]
    feed.add(rows)
    live = streams.stream_histogram_bins(feed.stream(), str(tmp_path / "bins"), str(tmp_path / "cp"))
    batch = histogram_bins(spark.createDataFrame(rows[:-1], SCHEMA).withColumn("ts_ms", F.unix_millis("event_time")))

    def shown(df):
        return sorted((r["minute_ms"], round(r["mean"], 9), r["weight"], r["lo"], r["hi"]) for r in df.collect())

    assert shown(live) == shown(batch) and len(shown(live)) > 64


def test_delta_sums_and_tag_sets(feed, tmp_path):
    feed.add([(at(0), "hits", 2.0, 1), (at(0, 30), "hits", 3.0, 2), (at(0, 31), "hits", -9.0, 3), (at(1), "hits", 1.0, 4), (at(20), "hits", 1.0, 5)])
    tagged = feed.stream().withColumns({
        "name": F.col("series"), "source": F.lit("s"), "tags": F.create_map(F.lit("k"), F.col("series"))})
    sums = streams.run_to_table(streams.stream_delta_sums(tagged), "deltas").collect()
    assert sorted((r["name"], r["total"]) for r in sums) == [("∆hits", 1.0), ("∆hits", 5.0)]
    sets = streams.run_to_table(streams.stream_tag_dedup(tagged), "tags").collect()
    assert [(r["canonical"], r["n_rows"]) for r in sets] == [("k\u001ehits", 4)]


def observed(feed):
    """Series ``kind:name``; a value below zero counts down, 1000 clears."""
    kinds = F.split("series", ":")
    return feed.stream().withColumns({
        "kind": kinds[0], "name": kinds[1], "op": F.when(F.col("value") == 1000, "clear").when(F.col("value") < 0, "dec").otherwise("inc"),
        "n": F.abs("value").cast("bigint"), "source": F.lit("s"), "tags": F.create_map(F.lit("k"), kinds[1])})


def reported(feed, tmp_path, **options):
    rows = streams.stream_registry(observed(feed), str(tmp_path / "r"), str(tmp_path / "rcp"), **options).collect()
    return sorted(((r["report_ms"] - 1704067200000) // 60_000, r["name"], r["value"]) for r in rows)


def test_registry_reports_changed_series_once_across_restarts(feed, tmp_path):
    feed.add([(at(0), "counter:c", 2.0, 1), (at(0, 1), "counter:c", -1.0, 2), (at(0, 2), "gauge:g", 4.5, 3), (at(0, 3), "delta:d", 3.0, 4), (at(1), "delta:d", -3.0, 5)])
    assert reported(feed, tmp_path) == []
    # The clear comes late, but its interval is open, so what was counted before it is gone.
    feed.add([(at(1, 30), "counter:c", 5.0, 6), (at(1, 10), "counter:c", 7.0, 7), (at(0, 1), "gauge:g", 9.0, 8), (at(11, 30), "gauge:g", 1.0, 9)])
    assert reported(feed, tmp_path) == [(1, "c.count", 1.0), (1, "g", 4.5), (1, "∆d.count", 3.0)]
    feed.add([(at(1, 20), "counter:c", 1000.0, 10), (at(5), "counter:c", 1.0, 11), (at(0), "counter:c", 50.0, 12)])
    feed.add([(at(30), "delta:other", 1.0, 13)])
    first = [(1, "c.count", 1.0), (1, "g", 4.5), (1, "∆d.count", 3.0)]
    # Minute 2 is cleared at 1:20 and counts 5 after it; the idle minutes 3 to 5 report nothing; the row of minute 0 is too late.
    assert reported(feed, tmp_path) == sorted([*first, (2, "c.count", 5.0), (6, "c.count", 6.0), (12, "g", 1.0)])
    feed.add([(at(70), "delta:other", 1.0, 14)])
    assert (31, "∆other.count", 1.0) in reported(feed, tmp_path)


def test_clear_comes_first_in_its_millisecond(feed, tmp_path):
    feed.add([(at(0), "counter:c", 3.0, 1), (at(0, 5), "counter:c", 4.0, 2), (at(0, 5), "counter:c", 1000.0, 3), (at(0, 6), "counter:c", 2.0, 4), (at(40), "gauge:x", 0.0, 5)])
    assert reported(feed, tmp_path) == [(1, "c.count", 6.0)]


def test_idle_series_are_forgotten(feed, tmp_path):
    feed.add([(at(0), "counter:c", 3.0, 1), (at(0), "counter:kept", 3.0, 2)])
    for minute in (10, 30, 50, 70):
        feed.add([(at(minute), "counter:kept", 1.0, minute), (at(minute), "gauge:clock", 0.0, minute)])
        reported(feed, tmp_path, idle_ms=1_800_000)
    feed.add([(at(75), "counter:c", 2.0, 100), (at(120), "gauge:clock", 0.0, 101)])
    got = reported(feed, tmp_path, idle_ms=1_800_000)
    assert (76, "c.count", 2.0) in got and (71, "kept.count", 7.0) in got


def test_registry_of_many_intervals_in_one_batch(feed, tmp_path):
    """Work per series follows its rows; once every closing interval read all open ones."""
    import time

    n = 8000
    feed.add([(at(m), f"{kind}:x", float(m % 7 + 1) if m % 100 else 1000.0, m) for m in range(n) for kind in ("counter", "delta", "gauge")] + [(at(n + 20), "gauge:clock", 0.0, n)])
    begin = time.perf_counter()
    got, want, total = reported(feed, tmp_path), [], 0
    for m in range(n):
        change = m % 7 + 1 if m % 100 else 0
        total = total + change if m % 100 else 0
        want += [(m + 1, "x.count", float(total)), (m + 1, "x", m % 7 + 1.0 if m % 100 else 1000.0)] + ([(m + 1, "∆x.count", float(change))] if change else [])
    assert got == sorted(want) and time.perf_counter() - begin < 60


def test_components_beat_by_the_clock(feed, tmp_path):
    def beat(idle):
        rows = feed.stream().withColumns({
            "source": F.lit("s"), **{c: F.lit("x") for c in ("application", "service", "cluster", "shard")},
            "component": F.when(~F.col("series").startswith("custom"), F.col("series")), "custom": F.lit(None).cast("map<string,string>"),
            "reported_tags": F.when(F.col("series").startswith("custom"), F.create_map(F.lit("k"), F.col("series")))})
        sent = streams.stream_heartbeats(rows, str(tmp_path / f"b{idle}"), str(tmp_path / f"cp{idle}"), idle).collect()
        return sorted(((r["window_ms"] - 1704067200000) // 300_000, r["canonical"].split("\u001e")[-1] if r["kind"] == "custom" else "component") for r in sent)

    feed.add([(at(1), "api", 0.0, 1), (at(2), "api", 0.0, 2), (at(1), "custom-a", 0.0, 3)])
    assert beat(2) == [] == beat(0)
    feed.add([(at(21), "custom-b", 0.0, 4)])
    assert beat(2) == [(0, "component"), (0, "custom-a"), (1, "component")] and beat(0) == [(0, "component"), (0, "custom-a")]
    feed.add([(at(46), "api", 0.0, 5)])
    # Two more cycles after the first, then silence; the reported set beats only where it was reported.
    assert beat(2) == [(0, "component"), (0, "custom-a"), (1, "component"), (2, "component"), (4, "custom-b")]
    assert beat(0) == [(0, "component"), (0, "custom-a"), (4, "custom-b")]
    feed.add([(at(100), "custom-c", 0.0, 6)])
    assert beat(2)[-3:] == [(9, "component"), (10, "component"), (11, "component")]
    assert beat(0)[-1] == (9, "component")


def test_tag_sets_are_reported_when_first_seen(feed, tmp_path):
    def seen():
        tagged = feed.stream().withColumn("tags", F.create_map(F.lit("k"), F.col("series")))
        rows = streams.run_to_table(streams.stream_first_sight(tagged), "sight", str(tmp_path / "s"), str(tmp_path / "scp")).collect()
        return sorted(((r["window_ms"] - 1704067200000) // 300_000, r["canonical"][2:]) for r in rows)

    feed.add([(at(0), "a", 1.0, 1), (at(1), "a", 1.0, 2), (at(2), "b", 1.0, 3)])
    assert seen() == [(0, "a"), (0, "b")]
    feed.add([(at(3), "a", 1.0, 4), (at(6), "a", 1.0, 5)])
    assert seen() == [(0, "a"), (0, "b"), (1, "a")]


def test_state_of_open_minutes_does_not_grow_with_their_values(spark, feed, tmp_path):
    from pulsemill.operators.digest import quantiles
    from pulsemill.streaming import state

    values = list(range(1, 1001))
    bins, checkpoint, sizes = str(tmp_path / "bins"), str(tmp_path / "cp"), []
    for n in range(6):  # a thousand values come in six files, each of one hundred and sixty-odd
        feed.add([(at(0, v % 60), "s", float(v), v) for v in values[n::6]])
        query = state.closed_digests(feed.stream(), streams.TIME, streams.DELAY).writeStream.format("parquet").option("path", bins).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert set(sizes) == {1}
    feed.add([(at(0, 1 + i % 50), "many", i + 0.5, i) for i in range(20_000)])
    feed.add([(at(60), "clock", 0.0, 0)])
    rows = streams.stream_histogram_bins(feed.stream(), bins, checkpoint).cache()
    got = {r["q"]: r["value"] for r in quantiles(rows.where("series = 's'"), ["series"], [0.5, 0.75, 0.95, 0.98, 0.99, 0.999]).collect()}
    bounds = {0.5: (490.5, 510.5), 0.75: (745.5, 755.5), 0.95: (949, 952), 0.98: (980, 981), 0.99: (990, 991), 0.999: (999, 1000)}
    assert all(low <= got[q] <= high for q, (low, high) in bounds.items())
    assert rows.where("series = 'many'").agg(F.sum("weight"), F.min("lo"), F.max("hi")).first()[:] == (20_000, 0.5, 19_999.5)
    assert rows.where("series = 'many'").count() < 300


def test_late_rows_are_reported(feed, tmp_path):
    feed.add([(at(30), "s", 1.0, 1), (at(5), "s", 1.0, 2)])
    feed.add([(at(19), "s", 1.0, 3), (at(20), "s", 1.0, 4), (at(40), "s", 1.0, 5)])
    feed.add([(at(29), "s", 1.0, 6), (at(31), "s", 1.0, 7)])
    rows = streams.stream_late_split(feed.stream(maxFilesPerTrigger="1"), str(tmp_path / "late"), str(tmp_path / "cp"))
    assert {r["id"]: r["late"] for r in rows.collect()} == {1: False, 2: False, 3: True, 4: False, 5: False, 6: True, 7: False}


def metric_lines(batch):
    points = batch.select(F.col("series").alias("name"), "value", F.lit(None).cast("bigint").alias("ts_ms"),
                          F.lit("h").alias("source"), F.create_map().cast("map<string,string>").alias("tags"))
    return delivery.union_lines(encode.encode_metric_lines(points))


def test_stream_sink_delivers_every_line(feed, tmp_path):
    feed.add([(at(0), "a b", 1.0, 1), (at(1), " ", 1.0, 2)])
    feed.add([(at(2), "c", 2.5, 3)])

    bodies = str(tmp_path / "bodies")
    outcomes = streams.stream_sink(
        feed.stream(maxFilesPerTrigger="1"), metric_lines, FileTransport(bodies), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted((r["batch"], r["n"], r["status"]) for r in outcomes.collect()) == [(0, 1, 202), (1, 1, 202)]
    sent = [t for f in glob.glob(f"{bodies}/*/*.gz") for t in gzip.open(f, "rt").read().splitlines()]
    assert sorted(sent) == ['"a-b" 1 source="h"', '"c" 2.5 source="h"']


def answers(*statuses):
    """The status of each attempt; the last one stays."""
    def status(fmt, key):
        return statuses[min(key_numbers(key)[2], len(statuses) - 1)]

    return status


def test_lines_that_come_back_wait_for_the_next_batch(feed, tmp_path):
    feed.add([(at(0), "a", 1.0, 1), (at(0), "b", 1.0, 2)])
    feed.add([(at(1), "c", 1.0, 3), (at(1), "a", 1.0, 4)])
    bodies, out, checkpoint = (str(tmp_path / n) for n in ("bodies", "out", "cp"))

    def run():
        return streams.stream_sink(feed.stream(maxFilesPerTrigger="1"), metric_lines, FileTransport(bodies, answers(503, 503, 202)), out, checkpoint)

    outcomes = run()
    sent = sorted((r["batch"], r["round"], r["attempt"], r["status"], r["n"]) for r in outcomes.groupBy("batch", "round", "attempt", "status").agg(F.sum("n").alias("n")).collect())
    # Batch 1 also sends what batch 0 got back; two more rounds empty the queue.
    assert sent == [(0, 0, 0, 503, 2), (1, 0, 0, 503, 2), (1, 0, 1, 503, 2), (1, 1, 1, 503, 2), (1, 1, 2, 202, 2), (1, 2, 2, 202, 2)]
    stored = sorted(t for f in glob.glob(f"{bodies}/*/*.gz") for t in gzip.open(f, "rt").read().splitlines())
    assert stored == ['"a" 1 source="h"'] * 2 + ['"b" 1 source="h"', '"c" 1 source="h"']
    assert delivery.line_account(outcomes, 5).first()[:] == ("metric", 4, 4, 0, 0)
    # A restart has nothing to send but the new line.
    feed.add([(at(2), "d", 1.0, 5)])
    assert delivery.line_account(run(), 5).first()[:] == ("metric", 5, 5, 0, 0)


def test_lines_are_given_up_after_the_last_attempt(feed, tmp_path):
    feed.add([(at(0), "a", 1.0, 1), (at(0), "b", 1.0, 2)])
    outcomes = streams.stream_sink(feed.stream(), metric_lines, FileTransport(str(tmp_path / "b"), answers(503, -1)), str(tmp_path / "out"), str(tmp_path / "cp"), max_attempts=3)
    assert delivery.line_account(outcomes, 3).first()[:] == ("metric", 2, 0, 2, 0)
    assert sorted({r["attempt"] for r in outcomes.collect()}) == [0, 1, 2]


def test_a_repeated_micro_batch_sends_nothing_again(feed, tmp_path):
    """The receiver dies in the middle of a batch; the restarted stream sends the rest of it."""
    feed.add([(at(0), f"m{i}", 1.0, i) for i in range(40)])
    calls = tmp_path / "calls"
    calls.mkdir()

    def send(fmt, body, key):
        if len(list(calls.iterdir())) == 3 and not (tmp_path / "died").exists():
            (tmp_path / "died").write_text("x")
            raise RuntimeError("gone")
        note = calls / key
        note.write_bytes((note.read_bytes() if note.exists() else b"") + gzip.decompress(body))
        return 202

    def run():
        return streams.stream_sink(feed.stream(), metric_lines, send, str(tmp_path / "out"), str(tmp_path / "cp"), batch_size=5)

    with pytest.raises(Exception, match="gone"):
        run()
    assert sum(r["n"] for r in run().collect()) == 40
    assert sorted(t for f in calls.iterdir() for t in f.read_text().splitlines()) == sorted(f'"m{i}" 1 source="h"' for i in range(40))
