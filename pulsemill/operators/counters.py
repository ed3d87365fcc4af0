"""Counters, gauges, the metrics registry and heartbeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.functions.tags import app_point_tags, canonical_tags, empty_tags, first_wins, from_canonical
from pulsemill.functions.text import delta_name
from pulsemill.functions.time import bin_start
from pulsemill.model import HEARTBEAT_INTERVAL_S, HEARTBEAT_NAME, REPORT_INTERVAL_S
from pulsemill.operators.ranges import previous_value
from pulsemill.operators.validate import positive_deltas


def delta_sums(deltas: DataFrame, ts: str = "ts_ms") -> DataFrame:
    """Positive deltas summed per series (marked name, source, tag content) and minute."""
    named = positive_deltas(deltas).select(
        delta_name(F.col("name")).alias("name"), "source", canonical_tags(F.col("tags")).alias("series_tags"),
        bin_start(F.col(ts)).alias("minute_ms"), "value")
    return named.groupBy("name", "source", "series_tags", "minute_ms").agg(F.sum("value").alias("total"))


def signed_count(op: str = "op", n: str = "n") -> Column:
    """inc counts up, dec counts down, clear counts nothing."""
    return F.when(F.col(op) == "inc", F.col(n)).when(F.col(op) == "dec", -F.col(n)).otherwise(F.lit(0)).cast("bigint")


SERIES = ["name", "source", "series_tags"]


def with_series(rows: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``SERIES``: counters of different sources or tags are different counters. Null tags are none."""
    return rows.withColumn("series_tags", canonical_tags(F.coalesce(F.col("tags"), empty_tags()))).drop("tags")


def counter_totals(ops: DataFrame, ts: str = "ts_ms", tie: str = "id") -> DataFrame:
    """Value of each counter (name, source, tag content): signed counts after its last clear.

    Two aggregations without any ordering of the rows: the last clear per series, then the sum behind it. The clears are
    one row per series, so adaptive execution broadcasts them or splits a hot counter.
    """
    when = F.struct(ts, tie)
    rows = with_series(ops)
    clears = rows.filter(F.col("op") == "clear").groupBy(*[F.col(c).alias(f"_{c}") for c in SERIES]).agg(F.max(when).alias("_cleared"))
    same = F.lit(True)
    for c in SERIES:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    live = F.col("_cleared").isNull() | (when > F.col("_cleared"))
    return rows.join(clears, same, "left").groupBy(*SERIES).agg(
        F.coalesce(F.sum(F.when(live, signed_count())), F.lit(0)).cast("bigint").alias("total"))


def counter_deltas(
    readings: DataFrame, keys: Sequence[str] = ("name",), ts: str = "ts_ms", tie: str = "id", split: bool | None = None
) -> DataFrame:
    """Cumulative readings to changes: a drop is a reset and counts from zero; changes of zero or less are left out.

    The first reading of a counter has no change.
    """
    lagged = previous_value(readings, keys, [F.col(ts), F.col(tie)], "total", "_before", split)
    step = F.col("total") - F.col("_before")
    return lagged.withColumn("delta", F.when(step < 0, F.col("total")).otherwise(step)).filter(F.col("delta") > 0).drop("_before")


def registry_report(
    observations: DataFrame,
    prefix: str = "",
    interval_s: int = REPORT_INTERVAL_S,
    gauge_value: Column | None = None,
    fill_idle: bool = False,
) -> DataFrame:
    """What a metrics registry reports per interval: (report_ms, kind, name, source, series_tags, value), stamped at its end.

    Gauge: last value. Counter: running total as ``name.count``. Delta counter: change within the interval as the
    marked ``name.count``, only when positive. ``observations`` has (name, source, tags, kind, op, n, value, ts_ms, id).
    Intervals without activity are left out unless ``fill_idle``, which repeats gauges and counters up to the last
    interval of the table.
    """
    width = interval_s * 1000
    value = F.col("value") if gauge_value is None else gauge_value
    # One shuffle of partial aggregates for all three kinds.
    per = with_series(observations.withColumn("report_ms", bin_start(F.col("ts_ms"), width) + width)).groupBy(
        "kind", *SERIES, "report_ms").agg(
        F.max_by(value, F.struct("ts_ms", "id")).alias("_last"),
        F.sum(signed_count()).alias("_change"),
    )
    so_far = Window.partitionBy("kind", *SERIES).orderBy("report_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = per.withColumn("_running", F.sum("_change").over(so_far))
    kind = F.col("kind")
    report = rows.select(
        "report_ms", "kind", report_name(prefix).alias("name"), "source", "series_tags",
        F.when(kind == "gauge", F.col("_last")).when(kind == "counter", F.col("_running"))
        .otherwise(F.col("_change")).cast("double").alias("value"),
    ).filter((kind != "delta") | (F.col("value") > 0))
    return _repeat_idle(report, width) if fill_idle else report


def report_name(prefix: str = "") -> Column:
    """The name under which a registry reports ``name`` of ``kind``."""
    head = f"{prefix.strip()}." if prefix and prefix.strip() else ""
    full, kind = F.concat(F.lit(head), F.col("name")), F.col("kind")
    counted = F.concat(full, F.lit(".count"))
    return F.when(kind == "gauge", full).when(kind == "counter", counted).otherwise(delta_name(counted))


def _repeat_idle(report: DataFrame, width: int) -> DataFrame:
    end = report.agg(F.max("report_ms").alias("end_ms")).first()["end_ms"]
    if end is None:
        return report
    later = Window.partitionBy("kind", *SERIES).orderBy("report_ms")
    until = F.coalesce(F.lead("report_ms").over(later) - width, F.lit(end))
    until = F.when(F.col("kind") == "delta", F.col("report_ms")).otherwise(until)
    stretched = report.withColumn("_until", until)
    return stretched.withColumn("report_ms", F.explode(F.sequence("report_ms", "_until", F.lit(width)))).drop("_until")


def component_tags() -> Column:
    """Heartbeat tags of a component: application tags and the component, then custom tags under free keys."""
    standard = app_point_tags(*[F.col(c) for c in ("application", "service", "cluster", "shard")], empty_tags())
    with_component = F.map_concat(standard, F.create_map(F.lit("component"), F.col("component")))
    return first_wins(with_component, F.coalesce(F.col("custom"), empty_tags()))


def beat_sets(beats: DataFrame) -> DataFrame:
    """``beats`` with one row per tag set that is to beat: ``kind`` (component or custom) and its ``canonical`` content."""
    def tag_set(kind: str, present: str, tags: Column) -> Column:
        return F.when(F.col(present).isNotNull(), F.struct(F.lit(kind).alias("kind"), canonical_tags(tags).alias("canonical")))

    sets = [tag_set("component", "component", component_tags())]
    if "reported_tags" in beats.columns:
        sets.append(tag_set("custom", "reported_tags", F.col("reported_tags")))
    found = beats.withColumn("_set", F.explode(F.array_compact(F.array(*sets))))
    return found.withColumns({"kind": F.col("_set.kind"), "canonical": F.col("_set.canonical")}).drop("_set")


def heartbeats(beats: DataFrame, interval_s: int = HEARTBEAT_INTERVAL_S) -> DataFrame:
    """One beat of 1.0 per interval and source for each active component tag set and each distinct reported custom tag set.

    ``beats`` has (ts_ms, source, application, service, cluster, shard, component, custom) and optionally ``reported_tags``.
    """
    window = bin_start(F.col("ts_ms"), interval_s * 1000).alias("window_ms")
    sets = beat_sets(beats).select(window, "source", "kind", "canonical").distinct()
    return sets.select(
        F.lit(HEARTBEAT_NAME).alias("name"), F.lit(1.0).alias("value"), "window_ms", "source", "kind", from_canonical(F.col("canonical")).alias("tags"))
