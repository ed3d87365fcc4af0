"""Queries over counters, gauges and heartbeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemill.functions.tags import tags_text
from pulsemill.operators import counters
from pulsemill.plans import sqltext as q
from pulsemill.plans import views
from pulsemill.plans.views import with_views


def _tagged(rows):
    return rows.withColumn("tags", F.translate("series_tags", "\u001e\u001f", "=,")).drop("series_tags")


def delta_sums(spark, folder):
    return _tagged(counters.delta_sums(views.deltas(spark, folder))).withColumn("total", F.round("total", 6))


def counter_totals(spark, folder):
    return _tagged(counters.counter_totals(views.observations(spark, folder)))


def counter_deltas(spark, folder):
    return counters.counter_deltas(views.counter_readings(spark, folder)).select("id", "name", "ts_ms", "delta")


def registry_report(spark, folder):
    report = counters.registry_report(views.observations(spark, folder), prefix="app")
    return _tagged(report).withColumn("value", F.round("value", 6))


def heartbeats(spark, folder):
    return counters.heartbeats(views.beats(spark, folder)).withColumn("tags", tags_text(F.col("tags")))


QUERIES = {f.__name__: f for f in (delta_sums, counter_totals, counter_deltas, registry_report, heartbeats)}

_SIGNED = "CASE op WHEN 'inc' THEN n WHEN 'dec' THEN -n ELSE 0 END"
BEAT_TAGS = ("'application=' || application || ',cluster=' || coalesce(cluster, 'none') || ',component=' || component || coalesce(',env=' || custom_env, '')"
             " || ',service=' || service || ',shard=' || coalesce(shard, 'none')")

SQL = {
    "delta_sums": with_views("deltas", then=f"""
SELECT {q.delta('name')} AS name, source, 'k=' || tag_k || ',type=' || tag_type AS tags, {q.bin_start('ts_ms')} AS minute_ms,
  round(sum(value), 6) AS total FROM deltas WHERE value > 0 GROUP BY 1, 2, 3, 4"""),
    "counter_totals": with_views("observations", then=f""", cleared AS (SELECT name, source, tags, max((ts_ms, id)) AS last_clear FROM observations WHERE op = 'clear' GROUP BY ALL)
SELECT name, source, tags, CAST(coalesce(sum({_SIGNED}) FILTER (WHERE last_clear IS NULL OR (ts_ms, id) > last_clear), 0) AS BIGINT) AS total
FROM observations LEFT JOIN cleared USING (name, source, tags) GROUP BY name, source, tags"""),
    "counter_deltas": with_views("counter_readings", then=""", steps AS (SELECT *, total - lag(total) OVER (PARTITION BY name ORDER BY ts_ms, id) AS step FROM counter_readings)
SELECT id, name, ts_ms, CASE WHEN step < 0 THEN total ELSE step END AS delta FROM steps WHERE CASE WHEN step < 0 THEN total ELSE step END > 0"""),
    "registry_report": with_views("observations", then=f""", per AS (SELECT kind, name, source, tags, {q.bin_start('ts_ms')} + 60000 AS report_ms,
    arg_max(value, (ts_ms, id)) AS last, sum({_SIGNED}) AS change FROM observations GROUP BY ALL)
SELECT report_ms, kind, CASE kind WHEN 'gauge' THEN 'app.' || name WHEN 'counter' THEN 'app.' || name || '.count' ELSE '∆app.' || name || '.count' END AS name, source, tags,
  round(CAST(value AS DOUBLE), 6) AS value
FROM (SELECT *, CASE kind WHEN 'gauge' THEN last WHEN 'counter' THEN sum(change) OVER (PARTITION BY kind, name, source, tags ORDER BY report_ms) ELSE change END AS value FROM per)
WHERE kind <> 'delta' OR value > 0"""),
    "heartbeats": with_views("beats", then=f"""
SELECT DISTINCT '~component.heartbeat' AS name, CAST(1 AS DOUBLE) AS value, {q.bin_start('ts_ms', 300_000)} AS window_ms, source, 'component' AS kind, {BEAT_TAGS} AS tags FROM beats
UNION ALL SELECT DISTINCT '~component.heartbeat', CAST(1 AS DOUBLE), {q.bin_start('ts_ms', 300_000)}, source, 'custom', 'k=' || reported_k || ',kind=signup' FROM beats WHERE reported_k IS NOT NULL"""),
}
