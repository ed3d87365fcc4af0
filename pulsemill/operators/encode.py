"""Encoders: telemetry tables to text lines (without the trailing line break, which the text writer adds)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.tags import pairs_suffix, tags_suffix
from pulsemill.functions.text import delta_name, number_text, sanitize_name, sanitize_tag_value, with_default_source
from pulsemill.model import GRANULARITY_MS, SPAN_FORMAT, SPAN_LOGS_FORMAT, SPAN_LOGS_TAG, UNKNOWN_SOURCE
from pulsemill.operators.spans import with_envelopes
from pulsemill.operators.validate import (
    REASON, positive_deltas, valid, validate_distributions, validate_points, validate_spans,
)


def _optional(text: Column) -> Column:
    return F.coalesce(F.concat(F.lit(" "), text.cast("string")), F.lit(""))


def _source_part(default_source: str) -> Column:
    return F.concat(F.lit(" source="), sanitize_tag_value(with_default_source(F.col("source"), default_source)))


def _repeat(label: str, ids: str) -> Column:
    known = F.array_compact(ids)
    return F.when(F.size(known) > 0, F.concat(F.lit(f" {label}="), F.array_join(known, f" {label}="))).otherwise("")


def _accepted(records: DataFrame, check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The valid ones of ``records``; records that come with a verdict are not checked again."""
    return valid(records if REASON in records.columns else check(records))


def encode_metric_lines(points: DataFrame, default_source: str = UNKNOWN_SOURCE) -> DataFrame:
    """``"name" value [ts] source="s" "k"="v"...`` for every valid point, as column ``line``."""
    line = F.concat(
        sanitize_name(F.col("name")), F.lit(" "), number_text(F.col("value")), _optional(F.col("ts_ms")),
        _source_part(default_source), tags_suffix(F.col("tags")),
    )
    return _accepted(points, validate_points).withColumn("line", line)


def encode_delta_lines(deltas: DataFrame, default_source: str = UNKNOWN_SOURCE) -> DataFrame:
    """Metric lines of positive deltas: marked name, never a timestamp."""
    named = positive_deltas(deltas).withColumns({"name": delta_name(F.col("name")), "ts_ms": F.lit(None).cast("bigint")})
    return encode_metric_lines(named, default_source)


def compact_centroids(centroids: Column) -> Column:
    """Merge adjacent centroids of equal mean and sum their counts; no sorting, so later repeats stay apart.

    Works inside the row: run starts are found first, then each run's slice is summed once.
    """
    size = F.size(centroids)
    starts = F.filter(
        F.transform(centroids, lambda c, i: F.when(
            (i == 0) | (c["mean"] != F.try_element_at(centroids, F.greatest(i, F.lit(1)))["mean"]), i)),
        lambda i: i.isNotNull(),
    )
    return F.transform(starts, lambda s, j: F.struct(
        F.element_at(centroids, s + 1)["mean"].alias("mean"),
        F.aggregate(
            F.slice(centroids, s + 1, F.coalesce(F.try_element_at(starts, j + 2), size) - s),
            F.lit(0).cast("bigint"),
            lambda total, c: total + c["count"],
        ).alias("count"),
    ))


def encode_histogram_lines(dists: DataFrame, default_source: str = UNKNOWN_SOURCE) -> DataFrame:
    """One line per granularity of every valid distribution: ``!M [ts] #count mean ... "name" source=... tags``."""
    order = F.array(*[F.lit(g) for g in GRANULARITY_MS])
    body = F.concat(
        _optional(F.col("ts_ms")), F.lit(" "),
        F.array_join(F.transform(
            compact_centroids(F.col("centroids")),
            lambda c: F.concat(F.lit("#"), c["count"].cast("string"), F.lit(" "), number_text(c["mean"]), F.lit(" ")),
        ), ""),
        sanitize_name(F.col("name")), _source_part(default_source), tags_suffix(F.col("tags")),
    )
    bodies = _accepted(dists, validate_distributions).withColumn("_body", body)
    wanted = F.filter(order, lambda g: F.array_contains("granularities", g))
    exploded = bodies.select("*", F.explode(wanted).alias("granularity"))
    return exploded.withColumn("line", F.concat("granularity", "_body")).drop("_body")


def _span_line(has_logs: Column, default_source: str) -> Column:
    flag = F.when(has_logs, f' "{SPAN_LOGS_TAG}"="true"').otherwise("")
    return F.concat(
        sanitize_name(F.col("name")), _source_part(default_source),
        F.lit(" traceId="), "trace_id", F.lit(" spanId="), "span_id",
        _repeat("parent", "parents"), _repeat("followsFrom", "follows_from"),
        F.coalesce(pairs_suffix(F.col("tags")), F.lit("")), flag,
        F.lit(" "), F.col("start_ms").cast("string"), F.lit(" "), F.col("duration_ms").cast("string"),
    )


def encode_span_lines(spans: DataFrame, default_source: str = UNKNOWN_SOURCE) -> DataFrame:
    """Span lines of valid spans. ``has_logs`` (boolean, optional) adds the span-logs flag."""
    has_logs = F.col("has_logs") if "has_logs" in spans.columns else F.lit(False)
    return _accepted(spans, validate_spans).withColumn("line", _span_line(has_logs, default_source))


def encode_span_envelopes(spans: DataFrame, logs: DataFrame, how: str = "left", default_source: str = UNKNOWN_SOURCE) -> DataFrame:
    """The envelopes of valid spans: ``span`` (the span's line, null where no valid span is known) and ``line`` (the envelope, null for a span
    without logs), one row per ``chunk`` as in ``with_envelopes``. The spans are encoded behind the join, as their lines are longer than they are."""
    joined = with_envelopes(_accepted(spans, validate_spans), logs, how)
    # A valid span has a name, and without one there is no line.
    encoded = encode_span_logs_json(joined.withColumn("span", _span_line(F.col("chunk").isNotNull(), default_source)))
    return encoded.withColumn("line", F.when(F.col("chunk").isNotNull(), F.col("line")))


def span_and_log_lines(spans: DataFrame, logs: DataFrame, default_source: str = UNKNOWN_SOURCE) -> DataFrame:
    """(format, line) of valid spans and of the envelopes of their logs, by one join of both."""
    both = encode_span_envelopes(spans, logs, "left", default_source)
    first = F.coalesce(F.col("chunk"), F.lit(0)) == 0
    pair = lambda label, line, when: F.when(when, F.struct(F.lit(label).alias("format"), F.col(line).alias("line")))
    return both.select(F.inline(F.array_compact(F.array(
        pair(SPAN_FORMAT, "span", first), pair(SPAN_LOGS_FORMAT, "line", F.col("chunk").isNotNull())))))


def encode_span_logs_json(envelopes: DataFrame) -> DataFrame:
    """One JSON object per envelope (trace_id, span_id, logs, span); ``span`` is the encoded span line or null.

    The embedded span line keeps its line break. Field maps are written in key order.
    """
    logs = F.transform("logs", lambda log: F.struct(
        log["ts_us"].alias("timestamp"),
        F.map_from_entries(F.sort_array(F.map_entries(log["fields"]))).alias("fields"),
    ))
    envelope = F.struct(
        F.col("trace_id").alias("traceId"), F.col("span_id").alias("spanId"), logs.alias("logs"),
        F.concat("span", F.lit("\n")).alias("span"),
    )
    return envelopes.withColumn("line", F.to_json(envelope, {"ignoreNullFields": "false"}))
