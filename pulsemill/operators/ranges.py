"""Ordered calculations and joins per key that no single key can overload.

A window partitioned by a hot key would sort that key's rows in one task. Each ordered helper first names the keys that are that large, with a
frequent-items sketch of some thousand counters per task. Their rows alone are range-partitioned by key *and* order, so a hot key
spreads over many partitions, and small per-partition totals carry the state across the seams; the rows of all other keys take the plain
window: one shuffle, one sort. Both ways give the same rows; ``split`` forces one of them for all keys and saves the question.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.session import materialise

HOT_ROWS = 2_000_000
SALTS = 64
#: Rows of a key that one window may sort to find a place among them.
WINDOW_ROWS = 100_000
#: Digits that a round looks at behind the known ones; so many fit a long.
SEEN_DIGITS = 15
#: Counters of a task's sketch of frequent keys.
TRACKED = 4096


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, n_rows: int | None = None) -> list[int]:
    """The hashes (``xxhash64``) of the groups of ``keys`` that may have more than ``hot_rows`` rows.

    One pass over the key columns: each task keeps ``TRACKED`` counters, sketches are merged in two rounds, and nothing but sketches is
    shuffled. A group with over ``hot_rows`` rows is named unless it has less than 2 / ``TRACKED`` of all rows, so beyond some billion
    rows a group that stays in one task is at most that share of the whole. The rows are counted in the same pass;
    if ``n_rows`` tells that there are no more than ``hot_rows``, none is made.
    """
    if n_rows is not None and n_rows <= hot_rows:
        return []
    sketches = df.select(F.xxhash64(*keys).alias("k")).groupBy((F.spark_partition_id() % SALTS).alias("_round")).agg(
        F.expr(f"approx_top_k_accumulate(k, {TRACKED})").alias("s"), F.count(F.lit(1)).alias("n"))
    # Grouped by a key that is the same for all: a task without sketches cannot combine anything.
    top = sketches.groupBy(F.col("_round") < 0).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {TRACKED}), {TRACKED // 2})").alias("top"), F.sum("n").alias("n")).first()
    return [r["item"] for r in top["top"] if r["count"] > hot_rows] if top and top["n"] > hot_rows else []


def _by_heat(
    df: DataFrame, keys: Sequence[str], split: bool | None, hot_rows: int, plain: Callable[[DataFrame], DataFrame], spread: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``plain`` for the rows of cold keys and ``spread`` for those of hot ones, or one of them for all rows."""
    if split is not None:
        return spread(df) if split else plain(df)
    hot = hot_keys(df, keys, hot_rows)
    if not hot:
        return plain(df)
    is_hot = F.xxhash64(*keys).isin(hot)
    return plain(df.filter(~is_hot)).unionByName(spread(df.filter(is_hot)))


def _range_parts(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows with ``_part``, which grows along (keys, order). Written once: a second evaluation could sample
    other range bounds."""
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return materialise(ranged.withColumn("_part", F.spark_partition_id()), "ranges")


def _join_parts(parts: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    carried = carried.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_k__part"),
                             *[c for c in carried.columns if c not in (*keys, "_part")])
    match = F.col("_part") == F.col("_k__part")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return parts.join(carried, match, "left").drop(*[f"_k_{k}" for k in keys], "_k__part")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    amount: Column,
    out: str,
    split: bool | None = None,
    hot_rows: int = HOT_ROWS,
    total: str | None = None,
    size: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Inclusive running sum of a non-null ``amount`` per key. ``order`` must be unique within a key.

    ``total`` and ``size`` name optional columns for the key's whole sum and number of rows. ``tasks`` is the number of tasks that share
    the plain windows; without it adaptive execution chooses, by the compressed size of the rows.
    """
    upto = (Window.unboundedPreceding, Window.currentRow)
    extra = [c for c in (total, size) if c]

    def plain(rows: DataFrame) -> DataFrame:
        ordered = Window.partitionBy(*keys).orderBy(*order)
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        columns = {out: F.sum(amount).over(ordered.rowsBetween(*upto))}
        if total:
            columns[total] = F.sum(amount).over(whole)
        if size:
            columns[size] = F.count(F.lit(1)).over(whole)
        return (rows.repartition(tasks, *keys) if tasks else rows).withColumns(columns)

    def spread(rows: DataFrame) -> DataFrame:
        parts = _range_parts(rows.withColumn("_amount", amount), keys, order)
        sums = parts.groupBy(*keys, "_part").agg(F.sum("_amount").alias("_sum"), F.count(F.lit(1)).alias("_rows"))
        key = Window.partitionBy(*keys)
        earlier = key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        carried = sums.select(
            *keys, "_part", F.sum("_sum").over(earlier).alias("_carried"),
            *([F.sum("_sum").over(key).alias(total)] if total else []), *([F.sum("_rows").over(key).alias(size)] if size else []))
        within = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(*upto)
        summed = _join_parts(parts.withColumn(out, F.sum("_amount").over(within)), carried, keys)
        return summed.withColumn(out, F.col(out) + F.coalesce(F.col("_carried"), F.lit(0))).select(*df.columns, out, *extra)

    return _by_heat(df, keys, split, hot_rows, plain, spread)


def row_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    out: str,
    split: bool | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """1-based position of each row within its key."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), out, split, hot_rows)


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    out: str,
    split: bool | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``value`` of the row before, per key; null on a key's first row. ``order`` must be unique within a key."""
    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))

    def spread(rows: DataFrame) -> DataFrame:
        parts = _range_parts(rows.withColumns({f"_order{i}": o for i, o in enumerate(order)}), keys, order)
        ordering = [F.col(f"_order{i}") for i in range(len(order))]
        lasts = parts.groupBy(*keys, "_part").agg(F.max_by(F.struct(value), F.struct(*ordering)).alias("_last"))
        seam = Window.partitionBy(*keys).orderBy("_part")
        carried = lasts.select(*keys, "_part", F.lag(f"_last.{value}").over(seam).alias("_carried"))
        within = Window.partitionBy(*keys, "_part").orderBy(*ordering)
        lagged = parts.withColumns({"_first": F.row_number().over(within) == 1, out: F.lag(value).over(within)})
        joined = _join_parts(lagged, carried, keys)
        return joined.withColumn(out, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col(out))).select(*df.columns, out)

    return _by_heat(df, keys, split, hot_rows, plain, spread)


def _hex(order: Column, kind: T.DataType) -> Column:
    """``order`` as hexadecimal text in the same order; null comes first, as in an ordering."""
    if isinstance(kind, T.IntegralType):
        signed = order.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))
        text = F.lpad(F.hex(signed), 16, "0")
    else:
        text = F.hex(F.encode(order.cast("string"), "UTF-8"))
    return F.coalesce(F.concat(F.lit("1"), text), F.lit("0"))


def cutoffs(df: DataFrame, keys: Sequence[str], ts: str, tie: str, n: int, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """(keys, _cut): the ``n``-th row of each key that has more than ``n`` rows, by (``ts``, ``tie``), which ``_cut`` holds.

    No key is sorted. Each round counts the rows of the undecided keys by the next few digits of their order, combined map-side: the
    digits in which the ``n``-th row lies stay, with the number of rows still to take from them. As soon as what is left of
    each key has at most ``window_rows`` rows, a window over just these finds the row.
    """
    kinds = [df.schema[c].dataType for c in (ts, tie)]
    # The time has a fixed width, so the digits of time and tie can stand in one text.
    digits = F.concat(_hex(F.col(ts), kinds[0]), _hex(F.col(tie), kinds[1]))
    rows = df.select(*keys, F.col(ts).alias("_ts"), F.col(tie).alias("_tie"), digits.alias("_digits"))
    whole = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > n)
    left = materialise(whole.select(*keys, F.lit(n).cast("bigint").alias("_need"), "_n", F.lit("").alias("_prefix"), F.lit(True).alias("_open")), "cutoffs")

    def undecided(found: DataFrame) -> DataFrame:
        named = found.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_need", "_prefix")
        match = F.lit(True)
        for k in keys:
            match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return rows.join(broadcast_if_small(named), match).filter(F.col("_digits").startswith(F.col("_prefix"))).drop(*[f"_k_{k}" for k in keys])

    # Numbers, unlike texts, are aggregated without sorting a task's rows.
    number = F.conv(F.rpad(F.expr(f"substring(_digits, length(_prefix) + 1, {SEEN_DIGITS})"), SEEN_DIGITS, "0"), 16, 10).cast("bigint")
    while True:
        if left.filter(F.col("_open") & (F.col("_n") > window_rows)).isEmpty():
            break
        here = [*keys, "_need", "_prefix"]
        counts = undecided(left).groupBy(*here, F.expr("substring(_digits, length(_prefix) + 1, 3)").alias("_next")).agg(
            F.count(F.lit(1)).alias("_n"), F.min(number).alias("_least"), F.max(number).alias("_most"),
            F.min(F.length("_digits")).alias("_short"), F.max(F.length("_digits")).alias("_long")).withColumns({
                f"_{to}": F.lpad(F.hex(f"_{of}"), SEEN_DIGITS, "0") for of, to in (("least", "low"), ("most", "high"))})
        # A key has at most 4096 next digits.
        before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        inside = counts.withColumn("_before", before).filter((F.col("_before") < F.col("_need")) & (F.col("_need") <= F.col("_before") + F.col("_n")))
        # All digits of the shortest row at most, as those behind it are only padding.
        seen = F.col("_short") - F.length("_prefix")
        equal = (F.col("_least") == F.col("_most")) & (F.col("_short") == F.col("_long")) & (seen <= SEEN_DIGITS)
        left = materialise(inside.select(
            *keys, (F.col("_need") - F.col("_before")).alias("_need"), "_n", (~equal).alias("_open"),
            F.concat("_prefix", F.substring(_common("_low", "_high"), F.lit(1), seen)).alias("_prefix")), "cutoffs")
    place, cut = F.row_number().over(Window.partitionBy(*keys).orderBy("_ts", "_tie")), F.struct("_ts", "_tie").alias("_cut")
    found = undecided(left.filter("_open")).withColumn("_place", place).filter(F.col("_place") == F.col("_need")).select(*keys, cut)
    equal = left.filter(~F.col("_open"))  # nothing but equal rows is left, so each of them is the one
    return found if equal.isEmpty() else found.unionByName(undecided(equal).select(*keys, cut).distinct())


def _common(low: str, high: str) -> Column:
    """The digits that all texts from ``low`` to ``high`` start with."""
    same = F.expr(f"try_element_at(filter(sequence(0, length({low})), i -> substring({low}, 1, i) <> substring({high}, 1, i)), 1)")
    return F.substring(F.col(low), F.lit(1), F.coalesce(same - 1, F.length(low)))


def first_rows(df: DataFrame, keys: Sequence[str], ts: str, tie: str, n: int, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """The rows up to each key's ``n``-th by (``ts``, ``tie``). The order must be unique within a key."""
    return flag_first(df, keys, ts, tie, n, "_within", window_rows).filter("_within").drop("_within")


def flag_first(df: DataFrame, keys: Sequence[str], ts: str, tie: str, n: int, out: str, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``df`` with ``out``: whether a row is among its key's first ``n`` by (``ts``, ``tie``).

    Groups are counted first. If none has more than ``window_rows`` rows, a plain window ranks them; else the large ones'
    cutoffs are found by counting, and one comparison per row tells.
    """
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > window_rows)
    if large.isEmpty():
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(ts, tie))
        return df.withColumn(out, rank <= n)
    return within_cutoff(df, cutoffs(df, keys, ts, tie, n, window_rows), keys, ts, tie, out)


def within_cutoff(df: DataFrame, cuts: DataFrame, keys: Sequence[str], ts: str, tie: str, out: str) -> DataFrame:
    """``df`` with ``out``: whether a row is one of its key's first. ``cuts`` has a row for each key with more rows."""
    named = materialise(cuts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_cut"), "cuts")
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = df.join(broadcast_if_small(named), match, "left")
    inside = F.col("_cut").isNull() | (F.struct(F.col(ts).alias("_ts"), F.col(tie).alias("_tie")) <= F.col("_cut"))
    return joined.withColumn(out, inside).select(*df.columns, out)


DEALT_ROWS = 200_000
#: So many times the share of a core are too many rows for one task of a scan.
UNEVEN = 1.5
#: Rows of a dealt task, at most.
DEALT_TASK_ROWS = 2_000_000


def dealt(df: DataFrame, least_rows: int = DEALT_ROWS) -> DataFrame:
    """``df``, a scan, dealt to all cores if one of its tasks has far more than a core's share of rows and there are enough to be worth it.

    One large row group is one task however many rows it has, and all work on its rows up to the next shuffle would be that task's. The rows of
    tasks are counted, as a file is cut by its bytes: a split without the middle of a row group is a task without rows. Tables of many files or
    row groups have enough tasks and stay as they are. Columns that nothing reads are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    n_rows, largest = df.groupBy(F.spark_partition_id()).count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.max("count")).first()
    if n_rows < least_rows or largest * cores <= UNEVEN * n_rows:
        return df
    # Rows dealt in turn would first be sorted, in memory, by the task that has them.
    rows = df.withColumn("_row", F.monotonically_increasing_id()).repartition(max(cores, -(-n_rows // DEALT_TASK_ROWS)), "_row")
    # Always true; no later filter, which may check whole rows, is moved below it into the scan's task.
    return rows.filter(F.spark_partition_id() >= 0).drop("_row")


BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows, written as JSON, have at most ``max_bytes``; otherwise unchanged, for the planner
    to join. No column has to be short for this bound."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
