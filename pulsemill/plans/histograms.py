"""Queries over raw samples, pre-aggregated values and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemill.model import GRANULARITY_MS
from pulsemill.operators import digest, encode, histograms, validate
from pulsemill.plans import sqltext as q
from pulsemill.plans import views
from pulsemill.plans.views import with_views

QUANTILES = (0.0, 0.1, 0.5, 0.75, 0.95, 0.99, 1.0)
DAY = GRANULARITY_MS["!D"]
KEY = histograms.MINUTE_KEY


def _shown(rows, *keys):
    return rows.select(
        *keys, F.round("mean", 6).alias("mean"), "weight", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


def _minutes(spark, folder):
    return histograms.histogram_bins(views.samples(spark, folder), exact=True)


def _days(spark, folder):
    return histograms.histogram_bins(views.samples(spark, folder), bin_ms=DAY, exact=True)


def histogram_bins(spark, folder):
    return _shown(_minutes(spark, folder), *KEY)


def histogram_bulk(spark, folder):
    return _shown(histograms.histogram_bulk(views.bulk(spark, folder), exact=True), *KEY)


def compress_digest(spark, folder):
    """One digest per series over all time."""
    return _shown(histograms.histogram_bins(views.samples(spark, folder), bin_ms=None, exact=True), "series")


def merge_digests(spark, folder):
    """Four writers per series, each with its own digest, merged per series."""
    events = views.table(spark, folder, "events").selectExpr("event_type AS series", "event_id % 4 AS writer", "value AS mean")
    lines = views.table(spark, folder, "lineitem").selectExpr(
        "l_returnflag AS series", "l_partkey % 4 AS writer", "l_extendedprice AS mean")
    keys = ["series", "writer"]
    values = events.unionByName(lines).withColumn("weight", F.lit(1).cast("bigint"))
    parts = digest.exact_digests(values, keys)
    # Means of a few values with two decimals are often half-way digits; the small extra makes both engines round them up.
    shown = F.floor(F.col("mean") * 1e6 + 0.5001) / 1e6
    return _shown(digest.merge_digests(parts, ["series"], exact=True).withColumn("mean", shown), "series")


def histogram_stats(spark, folder):
    stats = histograms.histogram_stats(_days(spark, folder), KEY)
    return stats.select(*KEY, "count", "size", *[F.round(c, 6).alias(c) for c in ("sum", "mean", "min", "max", "stddev")])


def histogram_quantiles(spark, folder):
    # Half-way digits are common here; the small extra makes both engines round them up.
    shown = F.floor(F.col("value") * 1e6 + 0.5001) / 1e6
    return digest.quantiles(_days(spark, folder), KEY, QUANTILES).withColumn("value", shown)


def histogram_values(spark, folder):
    return histograms.histogram_values(_days(spark, folder), KEY).withColumn("value", F.round("value", 6))


def histogram_rollup(spark, folder):
    return _shown(histograms.histogram_rollup(_minutes(spark, folder)), "series", "granularity", "start_ms")


def retain_recent_bins(spark, folder):
    return _shown(histograms.retain_recent_bins(_minutes(spark, folder)), *KEY)


def flush_order(spark, folder):
    """The clock stands at the newest sample, so only that minute is still open."""
    samples = views.samples(spark, folder)
    now_ms = samples.agg(F.max("ts_ms")).first()[0]
    bins = histograms.histogram_bins(samples, exact=True)
    return _shown(histograms.flush_order(bins, now_ms), *KEY, "pos")


def serialize_bins(spark, folder):
    return histograms.serialize_bins(_minutes(spark, folder))


def deserialize_bins(spark, folder):
    return histograms.deserialize_bins(histograms.serialize_bins(_minutes(spark, folder))).withColumn("mean", F.round("mean", 6))


def compact_centroids(spark, folder):
    runs = F.posexplode(encode.compact_centroids(F.col("centroids"))).alias("pos", "run")
    return views.dists(spark, folder).select("id", runs).select("id", "pos", "run.mean", "run.count")


def encode_histogram_lines(spark, folder):
    return encode.encode_histogram_lines(views.dists(spark, folder)).select("id", "line")


#: Every hundred-and-first order has a fault of its own kind.
FAULT = "CAST(regexp_extract(id, '^l([0-9]+)', 1) AS BIGINT) % 101"


def faulty_dists(dists):
    """Distributions with a fault of each kind that a check knows."""
    centroid = "transform(centroids, c -> named_struct('mean', {}, 'count', {}))".format
    return dists.withColumn("fault", F.expr(FAULT)).withColumns({c: F.expr(e) for c, e in {
        "name": "CASE fault WHEN 1 THEN '∆' ELSE name END",
        "granularities": "CASE fault WHEN 2 THEN NULL WHEN 3 THEN array('!M', NULL) WHEN 4 THEN array('!M', '!Q') ELSE granularities END",
        "centroids": f"CASE fault WHEN 5 THEN NULL WHEN 6 THEN {centroid('c.mean', 'CAST(NULL AS INT)')} "
                     f"WHEN 7 THEN {centroid('double(chr(78) || chr(97) || chr(78))', 'c.count')} "
                     f"WHEN 12 THEN {centroid('CAST(NULL AS DOUBLE)', 'c.count')} ELSE centroids END",
        "source": "CASE fault WHEN 8 THEN concat('a', char(10)) ELSE source END",
        "tags": "CASE fault WHEN 9 THEN map('ship', ' ') WHEN 10 THEN map(' ', 'v') WHEN 11 THEN map('ship', concat('a', char(13))) ELSE tags END",
    }.items()})


def validate_distributions(spark, folder):
    checked = validate.validate_distributions(faulty_dists(views.dists(spark, folder)))
    return checked.groupBy(F.coalesce(validate.REASON, F.lit("valid")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def validate_digest_input(spark, folder):
    bulk = views.table(spark, folder, "lineitem").selectExpr(
        "l_returnflag AS series", "array(l_quantity, l_extendedprice, l_tax) AS means", "array(l_linenumber - 1, 2) AS counts")
    checked = validate.validate_digest_input(bulk)
    return checked.groupBy("series", F.coalesce(validate.REASON, F.lit("valid")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("count").alias("weight"), F.round(F.sum("mean"), 2).alias("mean_sum"))


QUERIES = {f.__name__: f for f in (
    histogram_bins, histogram_bulk, compress_digest, merge_digests, histogram_stats, histogram_quantiles, histogram_values,
    histogram_rollup, retain_recent_bins, flush_order, serialize_bins, deserialize_bins, compact_centroids,
    encode_histogram_lines, validate_distributions, validate_digest_input)}


def compress_sql(name: str, source: str, keys: str) -> str:
    """CTEs that end in ``name``: the digest of ``source`` (keys, mean, weight, lo, hi)."""
    return f"""{name}_d AS (SELECT {keys}, mean, sum(weight) AS weight, min(lo) AS lo, max(hi) AS hi FROM {source} GROUP BY {keys}, mean),
{name}_r AS (SELECT *, sum(weight) OVER (PARTITION BY {keys} ORDER BY mean ROWS UNBOUNDED PRECEDING) AS cum,
  count(*) OVER (PARTITION BY {keys}) AS size, sum(weight) OVER (PARTITION BY {keys}) AS n FROM {name}_d),
{name}_q AS (SELECT *, (CAST(cum AS DOUBLE) - CAST(weight AS DOUBLE) / 2) / CAST(n AS DOUBLE) AS q FROM {name}_r),
{name}_c AS (SELECT *, CASE WHEN size <= 64 THEN CAST(cum AS DOUBLE) ELSE floor(8 * ln(q / (1 - q))) END AS cluster FROM {name}_q),
{name} AS (SELECT {keys}, CASE WHEN count(*) = 1 THEN max(mean) ELSE sum(mean * CAST(weight AS DOUBLE)) / CAST(sum(weight) AS DOUBLE) END AS mean,
  CAST(sum(weight) AS BIGINT) AS weight, min(lo) AS lo, max(hi) AS hi FROM {name}_c GROUP BY {keys}, cluster)"""


_VALUES = "mean, 1 AS weight, mean AS lo, mean AS hi"
_SHOWN = "round(mean, 6) AS mean, weight, round(lo, 6) AS lo, round(hi, 6) AS hi"


def _bins(width: int) -> str:
    return (f", raw AS (SELECT series, {q.bin_start('ts_ms', width)} AS minute_ms, value AS mean, 1 AS weight, value AS lo, value AS hi FROM samples),\n"
            + compress_sql("bins", "raw", "series, minute_ms"))


_MINUTES, _DAYS = _bins(60_000), _bins(DAY)



def _average(m1: str, w1: str, m2: str, w2: str) -> str:
    both = f"(({w1}) + ({w2}))"
    return f"({m1} * ({w1}) / {both} + {m2} * ({w2}) / {both})"


# Quantile cases on ordered centroids; w1/wk are the first and last weights.
_QUANTILES = f""", ranked AS (SELECT *, sum(weight) OVER k AS n, count(*) OVER k AS size, min(lo) OVER k AS least, max(hi) OVER k AS most,
    row_number() OVER o AS i, coalesce(sum(weight) OVER (PARTITION BY series, minute_ms ORDER BY mean ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    lead(mean) OVER o AS m2, lead(weight) OVER o AS c2 FROM bins
    WINDOW k AS (PARTITION BY series, minute_ms), o AS (PARTITION BY series, minute_ms ORDER BY mean)),
ends AS (SELECT series, minute_ms, arg_min(mean, mean) AS m1, arg_min(weight, mean) AS c1, arg_max(mean, mean) AS mk, arg_max(weight, mean) AS ck FROM bins GROUP BY ALL),
asked AS (SELECT r.*, m1, c1, mk, ck, q, q * n AS x, before + weight / 2.0 AS s, (weight + c2) / 2.0 AS dw
    FROM ranked r JOIN ends USING (series, minute_ms), unnest({list(QUANTILES)}) AS t(q)),
heads AS (SELECT *, CASE WHEN size = 1 THEN m1 WHEN x < 1 THEN least WHEN x > n - 1 THEN most
    WHEN c1 = 2 AND x <= 2 THEN 2 * m1 - least WHEN ck = 2 AND x > n - 2 THEN 2 * mk - most
    WHEN x < c1 / 2.0 THEN {_average('least', 'c1 / 2.0 - x', 'm1', 'x - 1')} END AS head FROM asked),
answers AS (
  SELECT series, minute_ms, q, head AS value FROM heads WHERE head IS NOT NULL AND i = 1
  UNION ALL
  SELECT series, minute_ms, q, CASE WHEN i = size THEN {_average('mean', 'n - 1 - x', 'most', 'x - s')}
    WHEN weight = 1 AND x < s + 0.5 THEN mean WHEN c2 = 1 AND x >= s + dw - 0.5 THEN m2
    ELSE {_average('mean', 's + dw - x - CASE WHEN c2 = 1 THEN 0.5 ELSE 0 END', 'm2', 'x - s - CASE WHEN weight = 1 THEN 0.5 ELSE 0 END')} END
  FROM heads WHERE head IS NULL AND x >= s AND (i = size OR x < s + dw))
SELECT series, minute_ms, CAST(q AS DOUBLE) AS q, floor(CAST(value AS DOUBLE) * 1e6 + 0.5001) / 1e6 AS value FROM answers"""

DIST_REASON = f"""CASE WHEN {q.blank('name')} THEN 'blank_name' WHEN name IN ('∆', 'Δ') THEN 'bare_delta'
  WHEN len(granularities) = 0 THEN 'no_granularity' WHEN len(means) = 0 THEN 'no_centroids' END"""

_RUNS = f""", flat AS (SELECT d.id, d.row, i, means[i] AS mean, counts[i] AS count,
    CASE WHEN i > 1 AND means[i] = means[i - 1] THEN 0 ELSE 1 END AS fresh
  FROM (SELECT *, row_number() OVER () AS row FROM dists) d, unnest(range(1, len(means) + 1)) AS t(i)),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY row ORDER BY i) AS run FROM flat),
runs AS (SELECT id, row, run, any_value(mean) AS mean, CAST(sum(count) AS BIGINT) AS count FROM islands GROUP BY id, row, run)"""

HISTOGRAM_LINE = f"""granularity || {q.optional('ts_ms')} || ' ' || body
  || {q.name('name')} || {q.source()} || ' "line-status"=' || {q.tag('tag_status')} || ' "ship"=' || {q.tag('tag_ship')}"""

HISTOGRAM_LINES = f""", valid AS (SELECT * FROM dists WHERE ({DIST_REASON}) IS NULL),
numbered AS (SELECT *, row_number() OVER () AS row FROM valid),
flat AS (SELECT row, i, means[i] AS mean, counts[i] AS count, CASE WHEN i > 1 AND means[i] = means[i - 1] THEN 0 ELSE 1 END AS fresh
  FROM numbered, unnest(range(1, len(means) + 1)) AS t(i)),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY row ORDER BY i) AS run FROM flat),
runs AS (SELECT row, run, any_value(mean) AS mean, sum(count) AS count FROM islands GROUP BY row, run),
bodies AS (SELECT row, string_agg('#' || count || ' ' || {q.number('mean')} || ' ', '' ORDER BY run) AS body FROM runs GROUP BY row),
histogram_lines AS (SELECT id, event_ms, {HISTOGRAM_LINE} AS line FROM numbered JOIN bodies USING (row), unnest(granularities) AS g(granularity))"""

SQL = {
    "histogram_bins": with_views("samples", then=f"{_MINUTES}\nSELECT series, minute_ms, {_SHOWN} FROM bins"),
    "histogram_bulk": with_views("bulk", then=", raw AS (SELECT series, minute_ms, mean, count AS weight, mean AS lo, mean AS hi FROM bulk),\n"
                                 + compress_sql("bins", "raw", "series, minute_ms") + f"\nSELECT series, minute_ms, {_SHOWN} FROM bins"),
    "compress_digest": with_views("samples", then=", raw AS (SELECT series, value AS mean, 1 AS weight, value AS lo, value AS hi FROM samples),\n"
                                  + compress_sql("bins", "raw", "series") + f"\nSELECT series, {_SHOWN} FROM bins"),
    "merge_digests": f"""
WITH vals AS (SELECT event_type AS series, event_id % 4 AS writer, value AS mean FROM events
  UNION ALL SELECT l_returnflag, l_partkey % 4, l_extendedprice FROM lineitem),
raw AS (SELECT series, writer, {_VALUES} FROM vals),
{compress_sql('parts', 'raw', 'series, writer')},
{compress_sql('bins', 'parts', 'series')}
SELECT series, round(floor(mean * 1e6 + 0.5001) / 1e6, 6) AS mean, weight, round(lo, 6) AS lo, round(hi, 6) AS hi FROM bins""",
    "histogram_stats": with_views("samples", then=f"""{_DAYS},
whole AS (SELECT series, minute_ms, sum(mean * weight) AS total, CAST(sum(weight) AS BIGINT) AS n, count(*) AS size, min(lo) AS least, max(hi) AS most FROM bins GROUP BY ALL)
SELECT series, minute_ms, any_value(n) AS count, any_value(size) AS size, round(any_value(total), 6) AS sum, round(any_value(total) / any_value(n), 6) AS mean,
  round(any_value(least), 6) AS min, round(any_value(most), 6) AS max, round(sqrt(sum(weight * pow(mean - total / n, 2)) / any_value(n)), 6) AS stddev
FROM bins JOIN whole USING (series, minute_ms) GROUP BY series, minute_ms"""),
    "histogram_quantiles": with_views("samples", then=f"{_DAYS}{_QUANTILES}"),
    "histogram_values": with_views("samples", then=f"""{_DAYS}
SELECT series, minute_ms, round(mean, 6) AS value FROM bins, unnest(range(weight)) AS t(i)"""),
    "histogram_rollup": with_views("samples", then=f"""{_MINUTES},
spread AS (SELECT series, granularity, minute_ms // width * width AS start_ms, mean, weight, lo, hi
  FROM bins, (VALUES ('!H', 3600000), ('!D', 86400000)) AS g(granularity, width)),
{compress_sql('rolled', 'spread', 'series, granularity, start_ms')}
SELECT series, granularity, start_ms, {_SHOWN} FROM rolled UNION ALL SELECT series, '!M', minute_ms, {_SHOWN} FROM bins"""),
    "retain_recent_bins": with_views("samples", then=f"""{_MINUTES}
SELECT series, minute_ms, {_SHOWN} FROM bins QUALIFY dense_rank() OVER (PARTITION BY series ORDER BY minute_ms DESC) <= 11"""),
    "flush_order": with_views("samples", then=f"""{_MINUTES}
SELECT series, minute_ms, row_number() OVER (PARTITION BY series ORDER BY minute_ms DESC, mean) AS pos, round(mean, 6) AS mean, weight, round(lo, 6) AS lo, round(hi, 6) AS hi
FROM bins WHERE minute_ms < (SELECT {q.bin_start('max(ts_ms)')} FROM samples)"""),
    "serialize_bins": with_views("samples", then=f"""{_MINUTES},
minutes AS (SELECT series, minute_ms, string_agg({q.number('mean')} || ' ' || weight, ',' ORDER BY mean) AS text FROM bins GROUP BY ALL)
SELECT series, {q.bin_start('minute_ms', DAY)} AS period_ms, string_agg(CAST(minute_ms AS VARCHAR), ';' ORDER BY minute_ms) AS timestamps,
  string_agg(text, ';' ORDER BY minute_ms) AS centroids FROM minutes GROUP BY series, period_ms"""),
    "deserialize_bins": with_views("samples", then=f"{_MINUTES}\nSELECT series, minute_ms, round(mean, 6) AS mean, weight FROM bins"),
    "compact_centroids": with_views("dists", then=f"""{_RUNS}
SELECT id, CAST(run - 1 AS INTEGER) AS pos, mean, count FROM runs"""),
    "encode_histogram_lines": with_views("dists", then=f"{HISTOGRAM_LINES}\nSELECT id, line FROM histogram_lines"),
    "validate_distributions": with_views("dists", then=f""",
faults AS (SELECT *, CAST(regexp_extract(id, '^l([0-9]+)', 1) AS BIGINT) % 101 AS fault FROM dists)
SELECT CASE WHEN fault = 1 THEN 'bare_delta' WHEN {q.blank('name')} THEN 'blank_name'
  WHEN fault = 2 OR fault NOT IN (3, 4) AND len(granularities) = 0 THEN 'no_granularity' WHEN fault = 5 OR len(means) = 0 THEN 'no_centroids'
  WHEN fault = 3 THEN 'null_granularity' WHEN fault = 4 THEN 'unknown_granularity' WHEN fault = 6 THEN 'null_count' WHEN fault IN (7, 12) THEN 'non_finite'
  WHEN fault = 9 THEN 'blank_tag_value' WHEN fault = 10 THEN 'blank_tag_key' WHEN fault IN (8, 11) THEN 'newline' ELSE 'valid' END AS verdict, count(*) AS n
FROM faults GROUP BY 1"""),
    "validate_digest_input": """
WITH pairs AS (SELECT l_returnflag AS series, l_quantity AS mean, l_linenumber - 1 AS count FROM lineitem
  UNION ALL SELECT l_returnflag, l_extendedprice, 2 FROM lineitem)
SELECT series, CASE WHEN count <= 0 THEN 'weight_not_positive' ELSE 'valid' END AS verdict, count(*) AS n,
  CAST(sum(count) AS BIGINT) AS weight, round(sum(mean), 2) AS mean_sum FROM pairs GROUP BY 1, 2""",
}
