"""Input checks. Each adds ``reject_reason`` (null for valid rows); the first failing check names the reason.

Checks beyond the blank tests guard the line format itself: a name that is only a delta sign, a number that is
not finite, and a line break inside a source or tag value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.text import SPACES, bare_delta, blank
from pulsemill.model import GRANULARITY_MS
from pulsemill.operators.ranges import broadcast_if_small

REASON = "reject_reason"


def not_finite(value: Column) -> Column:
    return value.isNull() | F.isnan(value) | F.abs(value).isin(float("inf"))


def _has_break(text: Column) -> Column:
    return F.coalesce(text.contains("\n") | text.contains("\r"), F.lit(False))


def _name_reason(name: Column) -> Column:
    return F.when(blank(name), "blank_name").when(bare_delta(name), "bare_delta")


#: Between joined keys or values; where one of them holds it itself, the exact look behind it decides.
_MARK = "\u0001"
_BLANK_OR_BREAK = f"(?:\\A|{_MARK})[{SPACES}]*(?:{_MARK}|\\z)|[\n\r]"


def _tag_reason(reason: Column, pairs: Column, keys: Column, values: Column, source: Column) -> Column:
    """Continue a ``when`` chain: the first bad pair of the list decides between key and value.

    Good rows pay for one match over all keys and one over all values; the pairs are only looked at behind it.
    """
    def bad_pair(e: Column) -> Column:
        return blank(e["key"]) | blank(e["value"])

    def doubtful(texts: Column) -> Column:
        return F.array_join(texts, _MARK, "").rlike(_BLANK_OR_BREAK)

    bad = F.try_element_at(F.filter(pairs, bad_pair), F.lit(1))
    broken = F.exists(pairs, lambda e: _has_break(e["value"]))
    detail = F.when(blank(bad["key"]) & bad.isNotNull(), "blank_tag_key").when(bad.isNotNull(), "blank_tag_value").when(broken, "newline")
    found = F.when((F.size(keys) > 0) & (doubtful(keys) | doubtful(values)), detail)
    return F.coalesce(reason, found, F.when(_has_break(source), "newline"))


def validate_points(points: DataFrame) -> DataFrame:
    reason = _name_reason(F.col("name")).when(not_finite(F.col("value")), "non_finite")
    return points.withColumn(REASON, _tag_reason(reason, F.map_entries("tags"), F.map_keys("tags"), F.map_values("tags"), F.col("source")))


def validate_distributions(dists: DataFrame) -> DataFrame:
    centroids, granularities = F.col("centroids"), F.col("granularities")
    reason = (
        _name_reason(F.col("name"))
        .when(granularities.isNull() | (F.size(granularities) == 0), "no_granularity")
        .when(centroids.isNull() | (F.size(centroids) == 0), "no_centroids")
        .when(F.exists(granularities, lambda g: g.isNull()), "null_granularity")
        .when(F.exists(granularities, lambda g: ~g.isin(*GRANULARITY_MS)), "unknown_granularity")
        .when(F.exists(centroids, lambda c: c["count"].isNull()), "null_count")
        .when(F.exists(centroids, lambda c: not_finite(c["mean"])), "non_finite")
    )
    return dists.withColumn(REASON, _tag_reason(reason, F.map_entries("tags"), F.map_keys("tags"), F.map_values("tags"), F.col("source")))


def validate_spans(spans: DataFrame) -> DataFrame:
    reason = (
        _name_reason(F.col("name"))
        .when(F.col("trace_id").isNull() | F.col("span_id").isNull(), "missing_id")
        .when(F.col("start_ms").isNull() | F.col("duration_ms").isNull(), "missing_time")
    )
    return spans.withColumn(REASON, _tag_reason(reason, F.col("tags"), F.col("tags.key"), F.col("tags.value"), F.col("source")))


def validate_digest_input(bulk: DataFrame, means: str = "means", counts: str = "counts") -> DataFrame:
    """Explode parallel arrays of means and counts, cut to the shorter, into checked rows."""
    length = F.least(F.size(means), F.size(counts))
    pairs = F.arrays_zip(
        F.slice(means, F.lit(1), length).alias("mean"), F.slice(counts, F.lit(1), length).alias("count")
    )
    rows = bulk.filter(length > 0).select(
        *[c for c in bulk.columns if c not in (means, counts)], F.posexplode(pairs).alias("pos", "_pair")
    )
    rows = rows.select("*", F.col("_pair.mean").alias("mean"), F.col("_pair.count").alias("count")).drop("_pair")
    return rows.withColumn(REASON, digest_reason(F.col("mean"), F.col("count")))


def digest_reason(mean: Column, count: Column) -> Column:
    """Why a weighted value may not enter a digest, or null."""
    return F.when(not_finite(mean), "non_finite").when(count.isNull() | (count <= 0), "weight_not_positive")


def valid(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


def rejected_samples(samples: DataFrame, value: str = "value") -> DataFrame:
    """The samples that ``histogram_bins`` leaves out, with their reason."""
    return samples.filter(not_finite(F.col(value))).withColumn(REASON, F.lit("non_finite"))


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())


def positive_deltas(deltas: DataFrame, value: str = "value") -> DataFrame:
    """Deltas above zero; others are dropped silently and count as neither valid nor invalid."""
    return deltas.filter(F.col(value) > 0)


def route_entities(df: DataFrame, routes: DataFrame, routed: bool = True) -> DataFrame:
    """Rows whose ``entity`` has a destination (``routed``), or the discarded rest."""
    return df.join(broadcast_if_small(routes.select("entity").distinct()), "entity", "left_semi" if routed else "left_anti")
