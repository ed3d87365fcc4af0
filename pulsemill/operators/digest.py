"""Mergeable quantile digests as plain rows: (keys..., mean, weight, lo, hi).

Every step is deterministic. Values are first counted per distinct value, so a key with at most 64 distinct
values stays exact. Above that, a value at quantile q joins cluster floor(8 ln(q / (1 - q))): steps of one on
that scale hold about N q(1-q) / 8 values, the size bound of accuracy 1/32, so clusters are small in the
tails and a digest never has more than a few hundred rows whatever N is (scale functions of the published
t-digest work by Dunning and Ertl). ``lo`` and ``hi`` carry the exact extremes of each cluster.

``reduce_digests`` clusters inside each task before anything is shuffled, at twice that accuracy. The middle of a cluster lies in
the step of its members, and steps of the finer scale nest in those of the coarser one, so clustering again changes nothing: a key
whose rows lie in one task gets the same digest as without partial digests. The digest of a key in several tasks depends on how they are
cut; ``exact_digests`` counts the distinct values of a key before it clusters them, so its digests depend on the values alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.model import ACCURACY, MAX_CENTROIDS
from pulsemill.operators.ranges import HOT_ROWS, SALTS, hot_keys, running_sum
from pulsemill.session import materialise

DIGEST = ["mean", "weight", "lo", "hi"]
#: A task keeps so many distinct values of a key as they are, and clusters more of them twice as finely as the result.
PARTIAL_CENTROIDS = 4 * MAX_CENTROIDS
PARTIAL_ACCURACY = ACCURACY / 2
#: Rows that a task holds before it clusters them.
HELD_ROWS = 1 << 19
#: Rows with distinct values that the windows of one task see, on average.
TASK_ROWS = 500_000
#: Rows that the counts of one task see, on average.
COUNT_ROWS = 1_500_000
_DIGEST_SCHEMA = [T.StructField("mean", T.DoubleType()), T.StructField("weight", T.LongType()), T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType())]


def as_digest(weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct (keys, mean) rows from rows of (keys, mean, weight[, lo, hi])."""
    lo, hi = ("lo", "hi") if "lo" in weights.columns else ("mean", "mean")
    return weights.groupBy(*keys, "mean").agg(
        F.sum("weight").cast("bigint").alias("weight"), F.min(lo).alias("lo"), F.max(hi).alias("hi"))


def count_values(weights: DataFrame, keys: Sequence[str], task_rows: int = COUNT_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """What ``as_digest`` gives, where no task counts more than ``task_rows`` rows on average, however few tasks scan the table.

    A task that counts as it scans holds every distinct value of its split, which may be one huge row group. So rows of a larger table are dealt
    by value before they are counted. Only values with over ``hot_rows`` rows are counted where they are scanned, as there are few of these.
    """
    n_rows = weights.count()
    if n_rows <= task_rows:
        return as_digest(weights, keys)
    tasks = max(weights.sparkSession.sparkContext.defaultParallelism, -(-n_rows // task_rows))
    value = [*keys, "mean"]
    hot = hot_keys(weights, value, hot_rows, n_rows)
    if not hot:
        return as_digest(weights.repartition(tasks, *value), keys)
    is_hot = F.xxhash64(*value).isin(hot)
    return as_digest(weights.filter(~is_hot).repartition(tasks, *value), keys).unionByName(as_digest(weights.filter(is_hot), keys))


def compress_digest(
    digest: DataFrame,
    keys: Sequence[str],
    split: bool | None = None,
    max_centroids: int = MAX_CENTROIDS,
    accuracy: float = ACCURACY,
) -> DataFrame:
    """Cluster every key that has more than ``max_centroids`` rows.

    By default through partial digests. ``split`` forces a way without them, for rows with distinct means per key: one window per key,
    or a key spread over many tasks (see ``ranges``).
    """
    if split is None:
        return reduce_digests(digest, keys, max_centroids, accuracy)
    ranked = running_sum(digest, keys, [F.col("mean")], F.col("weight"), "_cum", split, total="_n", size="_size")
    return _cluster(ranked, keys, max_centroids, accuracy)


def _cluster(ranked: DataFrame, keys: Sequence[str], max_centroids: int, accuracy: float) -> DataFrame:
    q = (F.col("_cum") - F.col("weight") / 2) / F.col("_n")
    step = F.floor(F.lit(1.0 / (4.0 * accuracy)) * F.log(q / (1 - q)))
    # Running weights are distinct per row, so they number the rows of a key that stays as it is.
    cluster = F.when(F.col("_size") <= max_centroids, F.col("_cum")).otherwise(step)
    mean = F.when(F.count(F.lit(1)) == 1, F.max("mean")).otherwise(F.sum(F.col("mean") * F.col("weight")) / F.sum("weight"))
    return (
        ranked.withColumn("_cluster", cluster)
        .groupBy(*keys, "_cluster")
        .agg(mean.alias("mean"), F.sum("weight").alias("weight"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .drop("_cluster")
    )


def merge_digests(parts: DataFrame, keys: Sequence[str], split: bool | None = None, exact: bool = False) -> DataFrame:
    """Partial digests (one per writer) to one digest per key.

    By default writers that a task reads are merged there first. A digest has a few hundred rows, so ``split=False``, which merges
    all writers of a key at once, is right for up to some thousand of them. ``exact`` gives the same for any number.
    """
    parts = parts.select(*keys, *DIGEST)
    if exact:
        return _exact(as_digest(parts, keys), keys)
    return reduce_digests(parts, keys) if split is None else compress_digest(as_digest(parts, keys), keys, split)


def reduce_digests(rows: DataFrame, keys: Sequence[str], max_centroids: int = MAX_CENTROIDS, accuracy: float = ACCURACY) -> DataFrame:
    """Rows of (keys, mean[, weight][, lo, hi]) to one digest per key, whatever the number of rows and distinct values of a key.

    Each task sends its own digest of a key, some hundred rows. These are merged in two rounds, so that no round sees
    more than a fraction of the tasks' digests of one key: every shuffle is bounded by keys and tasks, and nothing has to be known about hot keys.
    """
    parts = partial_digests(rows, keys)
    fine = _merge_round(parts, [*keys, "_task"], PARTIAL_CENTROIDS, min(PARTIAL_ACCURACY, accuracy / 2))
    return _merge_round(fine, keys, max_centroids, accuracy)


def _merge_round(parts: DataFrame, keys: Sequence[str], max_centroids: int, accuracy: float) -> DataFrame:
    """One shuffle: equal means, the order and the clusters of a key all use the same partitioning."""
    return compress_digest(as_digest(parts.repartition(*keys), keys), keys, False, max_centroids, accuracy)


def exact_digests(rows: DataFrame, keys: Sequence[str], max_centroids: int = MAX_CENTROIDS, accuracy: float = ACCURACY) -> DataFrame:
    """Rows of (keys, mean[, weight][, lo, hi]) to one digest per key that does not depend on how tasks are cut.

    Equal values are counted in tasks of ``COUNT_ROWS`` rows and written once; hot keys are ranked over many
    tasks (see ``ranges``), the others in windows that share ``TASK_ROWS`` rows a task.
    """
    weights = rows if "weight" in rows.columns else rows.withColumn("weight", F.lit(1).cast("bigint"))
    return _exact(count_values(weights, keys), keys, max_centroids, accuracy)


def _exact(counted: DataFrame, keys: Sequence[str], max_centroids: int = MAX_CENTROIDS, accuracy: float = ACCURACY) -> DataFrame:
    counted = materialise(counted, "weights")
    tasks = max(counted.sparkSession.sparkContext.defaultParallelism, -(-counted.count() // TASK_ROWS))
    ranked = running_sum(counted, keys, [F.col("mean")], F.col("weight"), "_cum", total="_n", size="_size", tasks=tasks)
    return _cluster(ranked, keys, max_centroids, accuracy)


def partial_digests(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, digest columns, _task): the digest of each task's own rows, without a shuffle.

    A task holds ``HELD_ROWS`` rows and the digests so far; if there are so many keys that their digests alone fill half of
    that, they are sent on and the task starts afresh. Rows without a weight count once. Means are finite.
    """
    names = [c for c in DIGEST if c in rows.columns]
    if "lo" not in names:
        names = [c for c in names if c != "hi"]
    schema = T.StructType([*[rows.schema[k] for k in keys], *_DIGEST_SCHEMA, T.StructField("_task", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, n = TaskContext.get().partitionId() % SALTS, [], 0

        def sent(digest: pa.Table) -> list[pa.RecordBatch]:
            return digest.append_column("_task", pa.array(np.full(len(digest), task, np.int32))).to_batches()

        for batch in batches:
            held.append(digest_columns(batch, keys))
            n += batch.num_rows
            if n >= HELD_ROWS:
                digest = cluster_rows(pa.Table.from_batches(held), keys)
                if len(digest) > HELD_ROWS // 2:
                    yield from sent(digest)
                    digest = digest.slice(0, 0)
                held, n = digest.to_batches(), len(digest)
        if held:
            yield from sent(cluster_rows(pa.Table.from_batches(held), keys))

    return rows.select(*keys, *names).mapInArrow(run, schema)


def digest_columns(batch: pa.RecordBatch, keys: Sequence[str]) -> pa.RecordBatch:
    """``batch`` with all columns of a digest."""
    mean = batch.column("mean").cast(pa.float64())
    weight = batch.column("weight").cast(pa.int64()) if "weight" in batch.schema.names else pa.array(np.ones(len(mean), np.int64))
    ends = [batch.column(c).cast(pa.float64()) for c in ("lo", "hi")] if "lo" in batch.schema.names else [mean, mean]
    return pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], mean, weight, *ends], names=[*keys, *DIGEST])


def cluster_rows(rows: pa.Table, keys: Sequence[str], max_centroids: int = PARTIAL_CENTROIDS, accuracy: float = PARTIAL_ACCURACY) -> pa.Table:
    """The digest of each key of ``rows``, all keys at once: what ``compress_digest`` does, for the rows of one task."""
    if not len(rows):
        return rows
    rows = rows.combine_chunks()
    group = np.zeros(len(rows), np.int64)
    for k in keys:
        codes = pc.fill_null(rows.column(k).chunk(0).dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.unique(group * (codes.max() + 2) + codes + 1, return_inverse=True)[1]
    first, *columns = cluster(group, *(rows.column(c).to_numpy() for c in DIGEST), max_centroids, accuracy)
    kept = rows.select(list(keys)).take(pa.array(first))
    for name, column in zip(DIGEST, columns):
        kept = kept.append_column(name, pa.array(column))
    return kept


def cluster(group: np.ndarray, mean: np.ndarray, weight: np.ndarray, lo: np.ndarray, hi: np.ndarray, max_centroids: int,
            accuracy: float) -> tuple[np.ndarray, ...]:
    """(a row of the group, mean, weight, lo, hi) of the clusters of every group, groups and means ascending."""
    order = np.lexsort((mean, group))
    group, mean, weight, lo, hi = group[order], mean[order] + 0.0, weight[order], lo[order], hi[order]

    def starts(*columns: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.append(True, np.any([np.diff(c) != 0 for c in columns], axis=0)))

    at = starts(group, mean)
    first, group, mean = order[at], group[at], mean[at]
    weight, lo, hi = np.add.reduceat(weight, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)

    heads = starts(group)
    size = np.diff(np.append(heads, len(group)))
    upto = np.cumsum(weight)
    upto = upto - np.repeat(upto[heads] - weight[heads], size)
    q = (upto - weight / 2) / np.repeat(np.add.reduceat(weight, heads), size)
    step = np.floor(1.0 / (4.0 * accuracy) * np.log(q / (1 - q)))
    at = starts(group, np.where(np.repeat(size, size) <= max_centroids, upto, step))
    members = np.diff(np.append(at, len(group)))
    total = np.add.reduceat(weight, at)
    centre = np.where(members == 1, mean[at], np.add.reduceat(mean * weight, at) / total)
    return first[at], centre, total, np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)


def quantiles(digest: DataFrame, keys: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """Interpolated quantiles, one row per key and q. Digests are small, so one window per key serves all q.

    Each centroid row carries the weight before it and its successor; q's answer is read from the one row whose
    bracket holds it. A centroid of weight one or two at a known extreme gives its samples exactly.
    """
    if any(not 0 <= q <= 1 for q in qs):
        raise ValueError("quantiles must be between 0 and 1")
    ordered = Window.partitionBy(*keys).orderBy("mean")
    ends = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = digest.withColumns({
        "_n": F.sum("weight").over(ends),
        "_k": F.count(F.lit(1)).over(ends),
        "_min": F.min("lo").over(ends),
        "_max": F.max("hi").over(ends),
        "_first_weight": F.first("weight").over(ends),
        "_last_mean": F.last("mean").over(ends),
        "_last_weight": F.last("weight").over(ends),
        "_before": F.coalesce(
            F.sum("weight").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_rank": F.row_number().over(ordered),
        "_next_mean": F.lead("mean").over(ordered),
        "_next_weight": F.lead("weight").over(ordered),
    })
    asked = rows.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    return asked.filter(_answers()).select(*keys, "q", _bracket_value().alias("value"))


def _average(m1: Column, w1: Column, m2: Column, w2: Column) -> Column:
    return m1 * w1 / (w1 + w2) + m2 * w2 / (w1 + w2)


def _index() -> Column:
    return F.col("q") * F.col("_n")


def _near_the_ends() -> Column:
    """Whether q is answered from the key's extremes; told by facts of the whole key, so every row can see it."""
    index, n = _index(), F.col("_n")
    return (
        (F.col("_k") == 1) | (index < 1) | (index > n - 1)
        | ((F.col("_first_weight") == 2) & (index <= 2)) | ((F.col("_last_weight") == 2) & (index > n - 2))
        | (index < F.col("_first_weight") / 2)
    )


def _start() -> Column:
    """Index at the middle of this row's centroid."""
    return F.col("_before") + F.col("weight") / 2


def _gap() -> Column:
    """Distance to the middle of the next centroid."""
    return (F.col("weight") + F.col("_next_weight")) / 2


def _answers() -> Column:
    """True on exactly one row per key and q: the first row near the ends, else the row whose bracket holds q."""
    index = _index()
    is_last = F.col("_rank") == F.col("_k")
    bracket = (index >= _start()) & (is_last | (index < _start() + _gap()))
    return F.when(_near_the_ends(), F.col("_rank") == 1).otherwise(bracket)


def _bracket_value() -> Column:
    c = F.col
    mean, weight, index, start, gap = c("mean"), c("weight"), _index(), _start(), _gap()
    left = F.when(weight == 1, 0.5).otherwise(0.0)
    right = F.when(c("_next_weight") == 1, 0.5).otherwise(0.0)
    ends = (
        F.when(c("_k") == 1, mean)
        .when(index < 1, c("_min"))
        .when(index > c("_n") - 1, c("_max"))
        .when((weight == 2) & (index <= 2), 2 * mean - c("_min"))
        .when((c("_last_weight") == 2) & (index > c("_n") - 2), 2 * c("_last_mean") - c("_max"))
        .otherwise(_average(c("_min"), weight / 2 - index, mean, index - 1))
    )
    inside = (
        F.when((weight == 1) & (index < start + 0.5), mean)
        .when((c("_next_weight") == 1) & (index >= start + gap - 0.5), c("_next_mean"))
        .otherwise(_average(mean, start + gap - index - right, c("_next_mean"), index - start - left))
    )
    beyond = _average(mean, c("_n") - 1 - index, c("_max"), index - start)
    return F.when(_near_the_ends(), ends).when(c("_rank") == c("_k"), beyond).otherwise(inside)
