"""Queries over queues, batches and delivery."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemill.operators import delivery, encode, spans, validate
from pulsemill.plans import histograms as histogram_plans
from pulsemill.plans import points as point_plans
from pulsemill.plans import spans as span_plans
from pulsemill.plans import sqltext as q
from pulsemill.plans import views
from pulsemill.plans.views import with_views
from pulsemill.session import prepare, shared_path
from pulsemill.sources import sinks

DAY = 86_400_000
CAPACITY = 30
BATCH = 100
TAKEN = 5_000


def _lines(spark, folder):
    """All encoded lines of all four kinds."""
    return delivery.union_lines(
        point_plans.encode_metric_lines(spark, folder), histogram_plans.encode_histogram_lines(spark, folder)).unionByName(
        span_plans.admitted_lines(spark, folder))


def _records(spark, folder):
    """What was sent: every point, distribution and span with its verdict."""
    none = F.lit(False).alias("has_logs")
    points = validate.validate_points(views.pts(spark, folder)).select(
        F.lit("points").alias("entity"), F.col("event_ms").alias("ts_ms"), F.col("id").cast("string").alias("id"), validate.REASON, none)
    dists = validate.validate_distributions(views.dists(spark, folder)).select(
        F.lit("histograms").alias("entity"), F.col("event_ms").alias("ts_ms"), "id", validate.REASON, none)
    flagged = spans.flag_spans(views.spans(spark, folder), views.logs(spark, folder))
    traces = validate.validate_spans(flagged).select(
        F.lit("spans").alias("entity"), F.col("start_ms").alias("ts_ms"), F.col("span_id").alias("id"), validate.REASON, "has_logs")
    return points.unionByName(dists).unionByName(traces)


def _arrivals(spark, folder):
    """Arrivals of events and order lines, with an id that is unique per entity."""
    events = views.table(spark, folder, "events").selectExpr("'points' AS entity", f"{views.ms('ts')} AS ts_ms", "CAST(event_id AS STRING) AS id")
    lines = views.table(spark, folder, "lineitem").selectExpr(
        "'spans' AS entity", f"{views.ms('l_shipdate')} AS ts_ms", f"{views.LINE_SPAN} AS id")
    return events.unionByName(lines)


def rate_limit(spark, folder):
    return delivery.rate_limit(_arrivals(spark, folder), CAPACITY, DAY)


def assign_batches(spark, folder):
    """Batches per entity and day, with how many lines each holds and its first and last arrival."""
    batched = delivery.assign_batches(_arrivals(spark, folder), 20)
    return batched.groupBy("entity", "day_ms", "batch").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("ts_ms", "id"))["id"].alias("first_id"), F.max(F.struct("ts_ms", "id"))["id"].alias("last_id"))


def take_batch(spark, folder):
    return delivery.take_batch(_arrivals(spark, folder), TAKEN)


def union_lines(spark, folder):
    return _lines(spark, folder)


def sink_lines(spark, folder):
    """Write every line, read the files back, count per format."""
    path = shared_path(prepare(spark), "lines")
    sinks.sink_lines(_lines(spark, folder), path)
    stored = spark.read.schema("value string, format string").text(path)
    return stored.groupBy("format").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value").cast("bigint")).alias("n_chars"))


#: What the receiver answers: the batches of one format are put back, those of another are lost.
ANSWERS = {"histogram": 503, "trace": 401}


def sink_batches(spark, folder):
    """Deliver every line to files, keep the outcomes, and hold the stored bodies and the requeued lines against them."""
    path = shared_path(prepare(spark), "delivered")
    outcomes = sinks.sink_batches(_lines(spark, folder), sinks.FileTransport(f"{path}/bodies", ANSWERS), 10_000, log=f"{path}/log")
    stored = spark.read.schema("line string, format string").text(f"{path}/bodies")
    sent = outcomes.select("format", F.lit("sent").alias("part"), F.col("n").cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("chars"))
    kept = [rows.select("format", F.lit(part).alias("part"), F.lit(1).cast("bigint").alias("n"), F.length("line").cast("bigint").alias("chars"))
            for part, rows in (("stored", stored), ("requeued", sinks.requeued_lines(outcomes)))]
    return sent.unionByName(kept[0]).unionByName(kept[1]).groupBy("format", "part").agg(F.sum("n").alias("n_lines"), F.sum("chars").alias("n_chars"))


def entity_ledger(spark, folder):
    return delivery.entity_ledger(_records(spark, folder), views.routes(spark), CAPACITY, DAY)


#: A receiver that answers by the bucket of a batch, and how the lines are dealt to it.
STATUSES = (200, 202, 401, 403, 406, 429, 500, 503, -1, 600)
LINES_A_BATCH = 1_000


def _by_bucket(fmt, key):
    return STATUSES[sinks.key_numbers(key)[0] % len(STATUSES)]


def _delivery_log(spark, folder):
    """The outcomes of a delivery of every line, as the audit reads them."""
    path = shared_path(prepare(spark), "audited")
    outcomes = sinks.sink_batches(
        _lines(spark, folder), sinks.FileTransport(f"{path}/bodies", _by_bucket), LINES_A_BATCH, log=f"{path}/log", buckets=len(STATUSES))
    return delivery.outcome_log(outcomes)


def delivery_outcomes(spark, folder):
    return delivery.delivery_outcomes(_delivery_log(spark, folder))


def failure_counts(spark, folder):
    return delivery.failure_counts(_delivery_log(spark, folder)).withColumn("entity", F.coalesce("entity", F.lit("total")))


def delivery_account(spark, folder):
    """Points, distributions and spans checked, encoded and delivered in one run. Valid and invalid records are counted on the way to the
    receiver, which loses the lines of spans; what became of the lines comes from the delivery's log."""
    path, checks = shared_path(prepare(spark), "account"), {
        "points": (validate.validate_points(views.pts(spark, folder)), encode.encode_metric_lines),
        "histograms": (validate.validate_distributions(views.dists(spark, folder)), encode.encode_histogram_lines),
        "spans": (validate.validate_spans(views.spans(spark, folder).withColumn("has_logs", F.lit(False))), encode.encode_span_lines)}
    counts, lines = {}, []
    for entity, (checked, encoder) in checks.items():
        rows, counts[entity] = delivery.observed(checked, f"{entity}-{path[-8:]}")
        lines.append(encoder(rows))
    outcomes = sinks.sink_batches(
        delivery.union_lines(*lines), sinks.FileTransport(f"{path}/bodies", {"trace": 401}), LINES_A_BATCH, log=f"{path}/log")
    verdicts = spark.createDataFrame([(e, c.get["valid"], c.get["invalid"]) for e, c in counts.items()], "entity string, valid bigint, invalid bigint")
    account = delivery.line_account(outcomes).withColumn("entity", F.expr("CASE format WHEN 'metric' THEN 'points' WHEN 'trace' THEN 'spans' ELSE 'histograms' END"))
    return verdicts.join(account.drop("format"), "entity")


QUERIES = {f.__name__: f for f in (
    rate_limit, assign_batches, take_batch, union_lines, sink_lines, sink_batches, entity_ledger, delivery_outcomes, failure_counts, delivery_account)}

_ARRIVALS = f"""
WITH arrivals AS (SELECT 'points' AS entity, epoch_us(ts) // 1000 AS ts_ms, CAST(event_id AS VARCHAR) AS id FROM events
  UNION ALL SELECT 'spans', epoch_us(l_shipdate) // 1000, {views.for_duck(views.LINE_SPAN)} FROM lineitem)"""

_LINES = (
    f", metric_lines AS (SELECT {q.METRIC_LINE} AS line FROM pts WHERE ({q.POINT_REASON}) IS NULL)"
    + histogram_plans.HISTOGRAM_LINES + span_plans.SPAN_LINES + span_plans.SPAN_LOG_LINES + """,
lines AS (SELECT 'metric' AS format, line FROM metric_lines UNION ALL SELECT 'histogram', line FROM histogram_lines
  UNION ALL SELECT 'trace', line FROM span_lines UNION ALL SELECT 'spanLogs', line FROM span_log_lines WHERE admitted)""")
_ALL = ("pts", "dists", "spans", "logs")
#: Batches and lines of each bucket, with the answer that they got.
_LOG = f""",
parts AS (SELECT format, line, n, unnest(range((n - 1) // {LINES_A_BATCH} + 1)) AS part FROM (SELECT format, line, count(*) AS n FROM lines GROUP BY ALL)),
dealt AS (SELECT format, least({LINES_A_BATCH}, n - part * {LINES_A_BATCH}) AS copies,
    CAST('0x' || substr(md5(part || ' ' || line), 1, 15) AS BIGINT) % {len(STATUSES)} AS bucket FROM parts),
delivery_log AS (SELECT CASE format WHEN 'metric' THEN 'points' WHEN 'histogram' THEN 'histograms' WHEN 'trace' THEN 'spans' ELSE 'span_logs' END AS entity,
    [{', '.join(map(str, STATUSES))}][bucket + 1] AS status, CAST(sum(copies) AS BIGINT) AS lines, (CAST(sum(copies) AS BIGINT) + {LINES_A_BATCH - 1}) // {LINES_A_BATCH} AS batches
  FROM dealt GROUP BY format, bucket)"""

SQL = {
    "rate_limit": f"""{_ARRIVALS}
SELECT entity, ts_ms, id, {q.bin_start('ts_ms', DAY)} AS interval_ms,
  row_number() OVER (PARTITION BY entity, {q.bin_start('ts_ms', DAY)} ORDER BY ts_ms, id) <= {CAPACITY} AS admitted FROM arrivals""",
    "assign_batches": f"""{_ARRIVALS},
ranked AS (SELECT *, {q.bin_start('ts_ms', DAY)} AS day_ms, (row_number() OVER (PARTITION BY entity, {q.bin_start('ts_ms', DAY)} ORDER BY ts_ms, id) - 1) // 20 AS batch FROM arrivals)
SELECT entity, day_ms, batch, count(*) AS n, arg_min(id, (ts_ms, id)) AS first_id, arg_max(id, (ts_ms, id)) AS last_id FROM ranked GROUP BY ALL""",
    "take_batch": f"{_ARRIVALS}\nSELECT entity, ts_ms, id FROM arrivals QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts_ms, id) <= {TAKEN}",
    "union_lines": with_views(*_ALL, then=f"{_LINES}\nSELECT format, line FROM lines"),
    "sink_lines": with_views(*_ALL, then=f"{_LINES}\nSELECT format, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM lines GROUP BY format"),
    "sink_batches": with_views(*_ALL, then=f"""{_LINES}
SELECT format, 'sent' AS part, count(*) AS n_lines, CAST(NULL AS BIGINT) AS n_chars FROM lines GROUP BY format
UNION ALL SELECT format, CASE format WHEN 'histogram' THEN 'requeued' ELSE 'stored' END, count(*), CAST(sum(length(line)) AS BIGINT)
FROM lines WHERE format <> 'trace' GROUP BY format"""),
    "entity_ledger": with_views(*_ALL, then=f""",
logged AS (SELECT DISTINCT trace_id, span_id FROM logs),
records AS (SELECT 'points' AS entity, event_ms AS ts_ms, CAST(id AS VARCHAR) AS id, ({q.POINT_REASON}) IS NULL AS ok, false AS has_logs FROM pts
  UNION ALL SELECT 'histograms', event_ms, id, ({histogram_plans.DIST_REASON}) IS NULL, false FROM dists
  UNION ALL SELECT 'spans', start_ms, span_id, ({span_plans.SPAN_REASON}) IS NULL, (trace_id, span_id) IN (SELECT (trace_id, span_id) FROM logged) FROM spans),
queued AS (SELECT *, row_number() OVER (PARTITION BY entity, {q.bin_start('ts_ms', DAY)} ORDER BY ts_ms, id) <= {CAPACITY} AS admitted
  FROM records WHERE ok AND entity <> 'histograms'),
log_queue AS (SELECT *, row_number() OVER (PARTITION BY {q.bin_start('ts_ms', DAY)} ORDER BY ts_ms, id) <= {CAPACITY} AS taken
  FROM queued WHERE entity = 'spans' AND admitted AND has_logs),
parts AS (SELECT entity, 0 AS valid, count(*) FILTER (WHERE entity <> 'histograms' AND NOT ok) AS invalid, 0 AS dropped,
    count(*) FILTER (WHERE entity = 'histograms') AS discarded FROM records GROUP BY entity
  UNION ALL SELECT entity, count(*), 0, count(*) FILTER (WHERE NOT admitted), 0 FROM queued GROUP BY entity
  UNION ALL SELECT 'span_logs', 0, 0, count(*), 0 FROM queued WHERE entity = 'spans' AND has_logs AND NOT admitted
  UNION ALL SELECT 'span_logs', count(*), 0, count(*) FILTER (WHERE NOT taken), 0 FROM log_queue)
SELECT entity, CAST(sum(valid) AS BIGINT) AS valid, CAST(sum(invalid) AS BIGINT) AS invalid, CAST(sum(dropped) AS BIGINT) AS dropped,
  CAST(sum(discarded) AS BIGINT) AS discarded FROM parts GROUP BY entity"""),
    "delivery_outcomes": with_views(*_ALL, then=f"""{_LINES}{_LOG}
SELECT entity, status, CASE WHEN status IN (401, 403) THEN 'discarded' WHEN status BETWEEN 400 AND 599 OR status = -1 THEN 'requeued' ELSE 'delivered' END AS outcome,
  CAST(sum(batches) AS BIGINT) AS batches, CAST(sum(lines) AS BIGINT) AS lines FROM delivery_log GROUP BY ALL"""),
    "failure_counts": with_views(*_ALL, then=f"""{_LINES}{_LOG}
SELECT coalesce(entity, 'total') AS entity, CAST(coalesce(sum(batches) FILTER (WHERE status = -1), 0) AS BIGINT) AS failures FROM delivery_log GROUP BY ROLLUP (entity)"""),
    "delivery_account": with_views(*_ALL, then=f"""{_LINES},
verdicts AS (SELECT 'points' AS entity, 'metric' AS format, count(*) FILTER (WHERE ({q.POINT_REASON}) IS NULL) AS valid, count(*) AS n FROM pts
  UNION ALL SELECT 'histograms', 'histogram', count(*) FILTER (WHERE ({histogram_plans.DIST_REASON}) IS NULL), count(*) FROM dists
  UNION ALL SELECT 'spans', 'trace', count(*) FILTER (WHERE ({span_plans.SPAN_REASON}) IS NULL), count(*) FROM spans)
SELECT entity, valid, n - valid AS invalid, sent, CASE format WHEN 'trace' THEN 0 ELSE sent END AS delivered, CASE format WHEN 'trace' THEN sent ELSE 0 END AS discarded,
  CAST(0 AS BIGINT) AS waiting
FROM verdicts JOIN (SELECT format, count(*) AS sent FROM lines GROUP BY format) USING (format)"""),
}
