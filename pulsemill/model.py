"""Schemas and fixed values of the telemetry data model."""

from __future__ import annotations

from pyspark.sql import types as T

TAGS = T.MapType(T.StringType(), T.StringType())

POINTS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("tags", TAGS),
])

CENTROID = T.StructType([
    T.StructField("mean", T.DoubleType()),
    T.StructField("count", T.IntegerType()),
])

DISTRIBUTIONS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("centroids", T.ArrayType(CENTROID)),
    T.StructField("granularities", T.ArrayType(T.StringType())),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("tags", TAGS),
])

TAG_PAIR = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

SPANS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("start_ms", T.LongType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("trace_id", T.StringType()),
    T.StructField("span_id", T.StringType()),
    T.StructField("parents", T.ArrayType(T.StringType())),
    T.StructField("follows_from", T.ArrayType(T.StringType())),
    T.StructField("tags", T.ArrayType(TAG_PAIR)),
])

SPAN_LOGS = T.StructType([
    T.StructField("trace_id", T.StringType()),
    T.StructField("span_id", T.StringType()),
    T.StructField("ts_us", T.LongType()),
    T.StructField("fields", TAGS),
])

# Wire text that receivers expect.
MINUTE, HOUR, DAY = "!M", "!H", "!D"
GRANULARITY_MS = {MINUTE: 60_000, HOUR: 3_600_000, DAY: 86_400_000}
DELTA_PREFIX = "∆"
DELTA_PREFIX_ALT = "Δ"
HEARTBEAT_NAME = "~component.heartbeat"
NO_VALUE = "none"
UNKNOWN_SOURCE = "unknown"
SPAN_LOGS_TAG = "_spanLogs"
NO_RESPONSE = -1

# Labels of the line formats. The metric label is this library's own; a transport maps it to whatever its
# receiver calls plain metric lines.
METRIC_FORMAT = "metric"
HISTOGRAM_FORMAT = "histogram"
SPAN_FORMAT = "trace"
SPAN_LOGS_FORMAT = "spanLogs"

# Settings of the histogram, the queue and the reporters.
ACCURACY = 1.0 / 32.0
MAX_CENTROIDS = 64
RETAINED_BINS = 11
QUEUE_CAPACITY = 50_000
BATCH_SIZE = 10_000
REPORT_INTERVAL_S = 60
HEARTBEAT_INTERVAL_S = 300
