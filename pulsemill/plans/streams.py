"""Streaming queries: the events file as a stream, run until its end. Windows still open stay unreported."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemill.functions.tags import tags_text
from pulsemill.operators import delivery, encode
from pulsemill.plans import histograms as histogram_plans
from pulsemill.plans import sqltext as q
from pulsemill.plans import views
from pulsemill.plans.counters import BEAT_TAGS
from pulsemill.plans.views import with_views
from pulsemill.session import prepare, shared_path
from pulsemill.sources.sinks import FileTransport, key_numbers
from pulsemill.streaming import streams

TIME = streams.TIME


def _events(spark, folder):
    schema = views.table(spark, folder, "events").schema
    return streams.read_stream(spark, folder, "events*.parquet", schema)


def _timed(spark, folder):
    return _events(spark, folder).withColumn(TIME, F.col("ts").cast("timestamp"))


def _tags(canonical):
    return F.translate(canonical, "\u001e\u001f", "=,").alias("tags")


def stream_histogram_bins(spark, folder):
    samples = _timed(spark, folder).select(F.col("event_type").alias("series"), TIME, "value")
    path = shared_path(prepare(spark), "stream-bins")
    bins = streams.stream_histogram_bins(samples, f"{path}/bins", f"{path}/checkpoint")
    return histogram_plans._shown(bins, "series", "minute_ms")


def stream_delta_sums(spark, folder):
    sums = streams.run_to_table(streams.stream_delta_sums(views.deltas_of(_events(spark, folder))), "stream-deltas")
    return sums.select("name", "source", _tags("series_tags"), "minute_ms", F.round("total", 6).alias("total"))


def stream_tag_dedup(spark, folder):
    tagged = _timed(spark, folder).selectExpr(TIME, f"{views.POINT_COLUMNS['tags']} AS tags", "event_id", "event_type", "props")
    sets = streams.run_to_table(streams.stream_tag_dedup(tagged.select(TIME, "tags")), "stream-tags")
    return sets.select("window_ms", _tags("canonical"), "n_rows")


def stream_tag_first_sight(spark, folder):
    """Each tag set of a cycle, reported at once; cycles still open count too."""
    tagged = _timed(spark, folder).selectExpr(TIME, f"{views.POINT_COLUMNS['tags']} AS tags", "event_id", "event_type", "props")
    return streams.run_to_table(streams.stream_first_sight(tagged.select(TIME, "tags")), "first-sight").select("window_ms", _tags("canonical"))


IDLE_CYCLES = 2


def stream_heartbeats(spark, folder):
    """The stream is joined with the table of applications; components beat for two more cycles without an event."""
    beats = views.beats_of(_events(spark, folder), views.apps(spark, folder))
    sent = streams.stream_heartbeats(beats, idle_cycles=IDLE_CYCLES)
    return sent.select("name", "value", "window_ms", "source", "kind", _tags("canonical"))


def stream_registry(spark, folder):
    """Reports of every closed interval: gauges, counters with their clears, delta counters."""
    reports = streams.stream_registry(views.observations_of(_events(spark, folder)), prefix="app")
    return reports.select("report_ms", "kind", "name", "source", _tags("series_tags"), F.round("value", 6).alias("value"))


#: The third in which an event arrives: each spans the whole time, so the later two hold late rows.
ARRIVAL = "event_id % 3"


def stream_late_split(spark, folder):
    """The events arrive in three parts, each as a batch of its own."""
    path = shared_path(prepare(spark), "stream-late")
    events = views.table(spark, folder, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias(TIME))
    for part in range(3):
        events.filter(F.expr(ARRIVAL) == part).write.mode("append").parquet(f"{path}/in")
        arrived = streams.read_stream(spark, f"{path}/in", "*.parquet", events.schema)
        split = streams.stream_late_split(arrived, f"{path}/out", f"{path}/checkpoint")
    return split.select("event_id", "event_type", "late")


def _third_time(fmt, key):
    """A receiver that is down for the first two attempts of every batch."""
    return 503 if key_numbers(key)[2] < 2 else 202


def stream_sink(spark, folder):
    """Encode and deliver the points of the stream to a receiver that puts every line back twice; lines per attempt and status."""
    path = shared_path(prepare(spark), "stream-sink")
    points = views.points_of(_events(spark, folder))
    outcomes = streams.stream_sink(
        points, lambda batch: delivery.union_lines(encode.encode_metric_lines(batch)), FileTransport(f"{path}/bodies", _third_time),
        f"{path}/log", f"{path}/checkpoint")
    return outcomes.groupBy("format", "attempt", "status").agg(F.sum("n").alias("n_lines"))


QUERIES = {f.__name__: f for f in (
    stream_histogram_bins, stream_delta_sums, stream_tag_dedup, stream_tag_first_sight, stream_heartbeats, stream_registry, stream_late_split, stream_sink)}


def _closed(start: str, width: int, source: str, ts: str = "ts_ms") -> str:
    """Windows that end no later than ten minutes before the newest row."""
    return f"{start} + {width} <= (SELECT max({ts}) FROM {source}) - 600000"


SQL = {
    "stream_histogram_bins": f"""
WITH raw AS (SELECT event_type AS series, {q.bin_start('epoch_us(ts) // 1000')} AS minute_ms, value AS mean, 1 AS weight, value AS lo, value AS hi FROM events),
newest AS (SELECT epoch_us(max(ts)) // 1000 AS ts_ms FROM events),
{histogram_plans.compress_sql('bins', 'raw', 'series, minute_ms')}
SELECT series, minute_ms, round(mean, 6) AS mean, weight, lo, hi FROM bins WHERE {_closed('minute_ms', 60000, 'newest')}""",
    "stream_delta_sums": with_views("deltas", then=f""", kept AS (SELECT * FROM deltas WHERE value > 0)
SELECT {q.delta('name')} AS name, source, 'k=' || tag_k || ',type=' || tag_type AS tags, {q.bin_start('ts_ms')} AS minute_ms, round(sum(value), 6) AS total
FROM kept WHERE {_closed(q.bin_start('ts_ms'), 60000, 'kept')} GROUP BY 1, 2, 3, 4"""),
    "stream_tag_dedup": with_views("pts", then=f"""
SELECT {q.bin_start('event_ms', 300_000)} AS window_ms, 'k=' || tag_k || ',type=' || tag_type AS tags, count(*) AS n_rows
FROM pts WHERE {_closed(q.bin_start('event_ms', 300_000), 300_000, 'pts', 'event_ms')} GROUP BY 1, 2"""),
    "stream_tag_first_sight": with_views("pts", then=f"""
SELECT DISTINCT {q.bin_start('event_ms', 300_000)} AS window_ms, 'k=' || tag_k || ',type=' || tag_type AS tags FROM pts"""),
    "stream_heartbeats": with_views("beats", then=f""",
seen AS (SELECT DISTINCT {q.bin_start('ts_ms', 300_000)} AS start_ms, source, 'component' AS kind, {BEAT_TAGS} AS tags FROM beats),
clocked AS (SELECT DISTINCT start_ms + 300000 * k AS window_ms, source, kind, tags FROM seen, range({IDLE_CYCLES + 1}) AS t(k)
  UNION ALL SELECT DISTINCT {q.bin_start('ts_ms', 300_000)}, source, 'custom', 'k=' || reported_k || ',kind=signup' FROM beats WHERE reported_k IS NOT NULL)
SELECT '~component.heartbeat' AS name, CAST(1 AS DOUBLE) AS value, window_ms, source, kind, tags FROM clocked WHERE {_closed('window_ms', 300_000, 'beats')}"""),
    "stream_registry": with_views("observations", then=f""",
signed AS (SELECT *, CASE op WHEN 'inc' THEN n WHEN 'dec' THEN -n ELSE 0 END AS change, {q.bin_start('ts_ms')} + 60000 AS report_ms,
    count(*) FILTER (WHERE op = 'clear') OVER (PARTITION BY kind, name, source, tags ORDER BY ts_ms) AS clears FROM observations),
running AS (SELECT *, sum(change) OVER (PARTITION BY kind, name, source, tags, clears ORDER BY ts_ms) AS total FROM signed),
reports AS (SELECT report_ms, kind, name, source, tags, arg_max(value, (ts_ms, id)) AS last, arg_max(total, ts_ms) AS total, sum(change) AS change FROM running GROUP BY ALL)
SELECT report_ms, kind, CASE kind WHEN 'gauge' THEN 'app.' || name WHEN 'counter' THEN 'app.' || name || '.count' ELSE '∆app.' || name || '.count' END AS name, source, tags,
  round(CAST(CASE kind WHEN 'gauge' THEN last WHEN 'counter' THEN total ELSE change END AS DOUBLE), 6) AS value
FROM reports WHERE (kind <> 'delta' OR change > 0) AND report_ms <= (SELECT max(ts_ms) FROM observations) - 600000"""),
    "stream_late_split": f"""
WITH parts AS (SELECT {ARRIVAL} AS part, max(ts) AS newest FROM events GROUP BY 1)
SELECT event_id, event_type, coalesce(epoch_ms(ts) < (SELECT max(epoch_ms(newest)) FROM parts WHERE part < {ARRIVAL}) - 600000, false) AS late FROM events""",
    "stream_sink": with_views("pts", then=f"""
SELECT 'metric' AS format, CAST(a AS INTEGER) AS attempt, CASE WHEN a < 2 THEN 503 ELSE 202 END AS status, count(*) AS n_lines
FROM pts, range(3) AS t(a) WHERE ({q.POINT_REASON}) IS NULL GROUP BY ALL"""),
}
