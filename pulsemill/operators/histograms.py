"""Histograms: raw values or pre-aggregated centroids to time bins, statistics, roll-ups and text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.functions.text import number_text
from pulsemill.functions.time import bin_start
from pulsemill.model import GRANULARITY_MS, RETAINED_BINS
from pulsemill.operators.digest import DIGEST, as_digest, compress_digest, exact_digests, merge_digests, reduce_digests
from pulsemill.operators.ranges import row_rank, shuffle_partitions
from pulsemill.operators.validate import digest_reason, not_finite
from pulsemill.session import materialise

MINUTE_KEY = ["series", "minute_ms"]
REPEAT_BLOCK = 10_000


def histogram_bins(
    samples: DataFrame, ts: str = "ts_ms", value: str = "value", bin_ms: int | None = 60_000, split: bool | None = None, exact: bool = False
) -> DataFrame:
    """Raw values to digest rows per (series, minute), or per series when ``bin_ms`` is None.

    Every task makes a digest of its own rows, and only these digests, a few hundred rows per key and task, are shuffled and
    merged. ``split`` forces a way without partial digests: distinct values are counted and clustered by a window, plain or split.
    ``exact`` counts distinct values too and spreads hot keys only: the digests do not depend on how tasks are cut (see ``exact_digests``).
    Values that are not finite are left out; ``rejected_samples`` gives them.
    """
    finite = samples.filter(~not_finite(F.col(value)))
    keys = ["series"] if bin_ms is None else MINUTE_KEY
    binned = finite if bin_ms is None else finite.withColumn("minute_ms", bin_start(F.col(ts), bin_ms))
    values = binned.select(*keys, F.col(value).cast("double").alias("mean"))
    return _digest_of(values.withColumn("weight", F.lit(1).cast("bigint")) if split is not None else values, keys, split, exact)


def _digest_of(rows: DataFrame, keys: Sequence[str], split: bool | None, exact: bool) -> DataFrame:
    if exact:
        return exact_digests(rows, keys)
    return reduce_digests(rows, keys) if split is None else compress_digest(as_digest(rows, keys), keys, split)


def histogram_bulk(bulk: DataFrame, keys: Sequence[str] = tuple(MINUTE_KEY), split: bool | None = None, exact: bool = False) -> DataFrame:
    """Pre-aggregated (keys, mean, count) rows to digest rows. Rows that ``digest_reason`` names are left out, as
    ``validate_digest_input`` reports them."""
    bulk = bulk.filter(digest_reason(F.col("mean"), F.col("count")).isNull())
    return _digest_of(bulk.select(*keys, "mean", F.col("count").cast("bigint").alias("weight")), keys, split, exact)


def histogram_rollup(minute_bins: DataFrame) -> DataFrame:
    """Minute digests to minute, hour and day digests in one pass over the (small) minute digests.

    Minutes are final and pass through; hours and days are clustered. A day merges at most 1440 digests of a few hundred
    rows, which bounds every group.
    """
    minutes = minute_bins.select("series", F.lit("!M").alias("granularity"), F.col("minute_ms").alias("start_ms"), *DIGEST)
    spread = minute_bins.withColumn("granularity", F.explode(F.array(*[F.lit(g) for g in GRANULARITY_MS if g != "!M"])))
    width = F.create_map(*[F.lit(x) for g, ms in GRANULARITY_MS.items() for x in (g, ms)])[F.col("granularity")]
    starts = spread.withColumn("start_ms", bin_start(F.col("minute_ms"), width.cast("bigint")))
    return minutes.unionByName(merge_digests(starts, ["series", "granularity", "start_ms"], split=False))


def histogram_stats(digest: DataFrame, keys: Sequence[str], all_keys: DataFrame | None = None) -> DataFrame:
    """count, sum, mean, min, max, population standard deviation and number of centroids per key.

    The deviation is taken around the weighted mean in a second pass, as the one-pass form cancels badly. Keys only
    found in ``all_keys`` are empty histograms: count 0, mean NaN, deviation 0.
    """
    whole = Window.partitionBy(*keys)
    total = F.sum(F.col("mean") * F.col("weight")).over(whole)
    rows = digest.withColumns({"_sum": total, "_n": F.sum("weight").over(whole)})
    spread = F.sum(F.col("weight") * F.pow(F.col("mean") - F.col("_sum") / F.col("_n"), F.lit(2)))
    stats = rows.groupBy(*keys).agg(
        F.sum("weight").cast("bigint").alias("count"),
        F.sum(F.col("mean") * F.col("weight")).alias("sum"),
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
        F.sqrt(spread / F.sum("weight")).alias("stddev"),
        F.count(F.lit(1)).alias("size"),
    ).withColumn("mean", F.col("sum") / F.col("count"))
    if all_keys is None:
        return stats
    return all_keys.select(*keys).distinct().join(stats, list(keys), "left").fillna(
        {"count": 0, "sum": 0.0, "mean": float("nan"), "stddev": 0.0, "size": 0})


def histogram_values(digest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Centroids back to repeated values, one row per value.

    A heavy centroid is first cut into blocks that are spread over tasks, so it is never one huge array.
    """
    per_row = F.lit(REPEAT_BLOCK)
    per_task = F.lit(REPEAT_BLOCK * REPEAT_BLOCK)

    def blocks(rows: DataFrame, name: str, size: Column) -> DataFrame:
        starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_left") - 1) / size)))
        cut = rows.withColumn(name, starts)
        return cut.withColumn("_left", F.least(F.col("_left") - F.col(name) * size, size))

    rows = digest.filter(F.col("weight") > 0).select(*keys, F.col("mean").alias("value"), F.col("weight").alias("_left"))
    # A fixed number of partitions: what is shuffled is tiny, what comes out of it is not.
    coarse = blocks(rows, "_task", per_task).repartition(shuffle_partitions(digest), *keys, "value", "_task")
    fine = blocks(coarse, "_block", per_row)
    return fine.select(*keys, F.explode(F.array_repeat("value", F.col("_left").cast("int"))).alias("value"))


def retain_recent_bins(bins: DataFrame, keep: int = RETAINED_BINS) -> DataFrame:
    """Rows of the newest ``keep`` bins of each series.

    The ranking only sees distinct minutes. Its result is one cut-off per series, which is joined back.
    """
    minutes = bins.select(*MINUTE_KEY).distinct()
    newest = Window.partitionBy("series").orderBy(F.col("minute_ms").desc())
    cutoffs = (
        minutes.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= keep)
        .groupBy("series").agg(F.min("minute_ms").alias("_from"))
    )
    return bins.join(cutoffs, "series").filter(F.col("minute_ms") >= F.col("_from")).select(*bins.columns)


def closed_bins(bins: DataFrame, now_ms: int) -> DataFrame:
    """Bins before the minute that holds ``now_ms``."""
    return bins.filter(F.col("minute_ms") < now_ms // 60_000 * 60_000)


def flush_order(bins: DataFrame, now_ms: int, split: bool | None = None) -> DataFrame:
    """Closed bins with their place in the flush, per series: newest bin first, centroids ascending."""
    closed = closed_bins(bins, now_ms)
    if split is None:
        closed = materialise(closed, "flush")
    return row_rank(closed, ["series"], [F.col("minute_ms").desc(), F.col("mean")], "pos", split)


def serialize_bins(bins: DataFrame, period_ms: int = GRANULARITY_MS["!D"]) -> DataFrame:
    """Digest rows to a pair of strings per series and period.

    ``timestamps`` joins the minutes with ``;``. ``centroids`` joins ``mean weight`` with ``,`` inside a minute and
    ``;`` between minutes. A period bounds the text: a day has at most 1440 minutes of a few hundred centroids.
    """
    minute = F.transform(F.sort_array(F.collect_list(F.struct("mean", "weight"))), lambda c: F.concat(
        number_text(c["mean"]), F.lit(" "), c["weight"].cast("string")))
    minutes = bins.groupBy("series", "minute_ms").agg(F.array_join(minute, ",").alias("_text"))
    ordered = F.sort_array(F.collect_list(F.struct("minute_ms", "_text")))
    return (
        minutes.withColumn("period_ms", bin_start(F.col("minute_ms"), period_ms))
        .groupBy("series", "period_ms").agg(ordered.alias("_bins"))
        .select(
            "series", "period_ms",
            F.array_join(F.transform("_bins", lambda b: b["minute_ms"].cast("string")), ";").alias("timestamps"),
            F.array_join(F.transform("_bins", lambda b: b["_text"]), ";").alias("centroids"),
        )
    )


def deserialize_bins(pairs: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Pairs of strings to (keys, minute_ms, mean, weight); the longer list is cut to the shorter."""
    rows = pairs.withColumns({"_times": F.split("timestamps", ";"), "_bins": F.split("centroids", ";")})
    shared = F.least(F.size("_times"), F.size("_bins"))
    zipped = F.arrays_zip(
        F.slice("_times", F.lit(1), shared).alias("time"), F.slice("_bins", F.lit(1), shared).alias("text"))
    minutes = rows.select(*keys, F.explode(zipped).alias("_bin"))
    centroids = minutes.select(
        *keys, F.col("_bin.time").cast("bigint").alias("minute_ms"),
        F.explode(F.split("_bin.text", ",")).alias("_centroid"))
    parts = F.split("_centroid", " ")
    return centroids.select(
        *keys, "minute_ms", parts[0].cast("double").alias("mean"), parts[1].cast("bigint").alias("weight"))
