"""Streaming twins: event-time windows with a watermark; a window is emitted once, after it has closed. Keyed state is in ``state``."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.functions.tags import canonical_tags
from pulsemill.functions.text import delta_name
from pulsemill.functions.time import epoch_ms
from pulsemill.operators.validate import positive_deltas
from pulsemill.session import shared_path
from pulsemill.sources.sinks import OUTCOMES, Transport, place, read_log, requeued_lines, sink_batches
from pulsemill.streaming import state

DELAY = "10 minutes"
AVAILABLE_NOW = {"availableNow": True}
TIME = "event_time"


def read_stream(spark: SparkSession, folder: str, glob: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """File stream over the files of ``folder`` that match ``glob``."""
    return spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob).options(**options).load(folder)


def run_to_table(
    stream: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None, trigger: dict | None = None
) -> DataFrame:
    """Run an append stream into parquet and return the table it wrote. The default trigger stops when the input ends.

    Give ``path`` and ``checkpoint`` to continue an earlier run.
    """
    spark = stream.sparkSession
    path = path or shared_path(spark, label)
    query = stream.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint or f"{path}-checkpoint").trigger(**(trigger or AVAILABLE_NOW)).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
) -> None:
    """Run a stream through ``foreachBatch``. ``write`` may see a batch again after a failure: key its output by the id."""
    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        **(trigger or AVAILABLE_NOW)).start().awaitTermination()


def _window(stream: DataFrame, width: str, delay: str) -> tuple[DataFrame, Column]:
    return stream.withWatermark(TIME, delay), F.window(TIME, width).alias("_window")


def _start() -> Column:
    return epoch_ms(F.col("_window.start"))


def stream_histogram_bins(
    samples: DataFrame, path: str, checkpoint: str, delay: str = DELAY, trigger: dict | None = None
) -> DataFrame:
    """Digest rows of each closed minute, never of an open one; the state of an open minute is its digest so far."""
    return run_to_table(state.closed_digests(samples, TIME, delay), "bins", path, checkpoint, trigger)


def stream_delta_sums(deltas: DataFrame, delay: str = DELAY) -> DataFrame:
    """Positive deltas per series and closed minute."""
    named = positive_deltas(deltas).select(
        TIME, delta_name(F.col("name")).alias("name"), "source", canonical_tags(F.col("tags")).alias("series_tags"), "value")
    marked, window = _window(named, "1 minute", delay)
    sums = marked.groupBy(window, "name", "source", "series_tags").agg(F.sum("value").alias("total"))
    return sums.select("name", "source", "series_tags", _start().alias("minute_ms"), "total")


def stream_tag_dedup(tagged: DataFrame, width: str = "5 minutes", delay: str = DELAY) -> DataFrame:
    """Each tag content once per heartbeat cycle."""
    marked, window = _window(tagged.withColumn("canonical", canonical_tags(F.col("tags"))), width, delay)
    return marked.groupBy(window, "canonical").agg(F.count(F.lit(1)).alias("n_rows")).select(
        _start().alias("window_ms"), "canonical", "n_rows")


def stream_first_sight(tagged: DataFrame, width: str = "5 minutes", delay: str = DELAY) -> DataFrame:
    """Each tag content as soon as it is first seen in a heartbeat cycle; what was seen is forgotten when the cycle closes."""
    marked = tagged.withColumn("canonical", canonical_tags(F.col("tags"))).withWatermark(TIME, delay)
    return marked.withColumn("_window", F.window(TIME, width)).dropDuplicates(["_window", "canonical"]).select(_start().alias("window_ms"), "canonical")


def stream_heartbeats(
    beats: DataFrame, path: str | None = None, checkpoint: str | None = None, idle_cycles: int = 0, delay: str = DELAY, trigger: dict | None = None
) -> DataFrame:
    """One beat of 1.0 per closed cycle of five minutes, source and tag set. A component goes on beating by the clock for
    ``idle_cycles`` cycles without an event; a reported tag set beats in the cycles of its reports."""
    with state.rocks_state(beats.sparkSession):
        return run_to_table(state.clocked_heartbeats(beats, idle_cycles, TIME, delay), "beats", path, checkpoint, trigger)


def stream_registry(
    observations: DataFrame, path: str | None = None, checkpoint: str | None = None, prefix: str = "", delay: str = DELAY,
    idle_ms: int | None = None, trigger: dict | None = None
) -> DataFrame:
    """What a registry reports every 60 seconds: the series that changed in the interval, each once when it closes (see ``state``)."""
    with state.rocks_state(observations.sparkSession):
        return run_to_table(state.registry_reports(observations, prefix, TIME, delay, idle_ms=idle_ms), "registry", path, checkpoint, trigger)


def stream_late_split(
    stream: DataFrame, path: str, checkpoint: str, delay_ms: int = 600_000, trigger: dict | None = None
) -> DataFrame:
    """All rows with ``late``: older, at arrival, than the newest earlier row by more than the delay.

    The watermark drops such rows silently; this job reports them. The newest time seen so far is one number, kept
    beside the batches so that a restarted or repeated batch compares with the same value.
    """
    spark = stream.sparkSession
    marks = f"{path}/marks"

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = None
        if batch_id > 0:
            earlier = spark.read.schema("newest bigint").parquet(f"{marks}/batch={batch_id - 1}")
            newest = earlier.first()["newest"]
        times = epoch_ms(F.col(TIME))
        bound = F.lit(newest).cast("bigint")
        late = F.coalesce(times < bound - delay_ms, F.lit(False))
        folder = f"{path}/rows/batch={batch_id}"
        batch.withColumn("late", late).write.mode("overwrite").parquet(folder)
        stored = spark.read.schema(batch.schema).parquet(folder)
        stored.agg(F.greatest(F.max(times), bound).alias("newest")).coalesce(1).write.mode("overwrite").parquet(
            f"{marks}/batch={batch_id}")

    run_batches(stream, write, checkpoint, trigger=trigger)
    return spark.read.schema(stream.schema.add("late", "boolean")).parquet(f"{path}/rows")


def stream_sink(
    stream: DataFrame,
    encode: Callable[[DataFrame], DataFrame],
    transport: Transport,
    path: str,
    checkpoint: str,
    batch_size: int = 10_000,
    trigger: dict | None = None,
    max_attempts: int = 5,
) -> DataFrame:
    """Encode and deliver each micro-batch together with the lines that came back from the one before.

    The queue between micro-batches is the delivery log of the last one, below ``path``: a line whose batch has to be sent again waits there with the number
    of its next attempt, up to ``max_attempts``. A repeat of a micro-batch reads the same queue and sends nothing
    that has an entry in its log. When the stream has ended, the queue is sent in further rounds until it is empty.

    Returns the outcomes (``OUTCOMES`` with ``batch`` and ``round``); ``delivery.line_account`` adds them up. ``encode`` turns a batch
    into (format, line) rows. The usual live trigger is ``{"processingTime": "1 second"}``.
    """
    spark = stream.sparkSession

    def waiting(folder: str) -> DataFrame:
        return requeued_lines(read_log(spark, folder)).filter(F.col("attempt") < max_attempts)

    def deliver(lines: DataFrame, batch_id: int, turn: int) -> None:
        sink_batches(lines, transport, batch_size, run=f"batch{batch_id}.{turn}", log=f"{path}/batch={batch_id}/round={turn}")

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = encode(batch).select("format", "line", F.lit(0).alias("attempt"))
        last = _last_round(path, batch_id - 1)
        deliver(lines if last is None else lines.unionByName(waiting(last[2])), batch_id, 0)

    run_batches(stream, write, checkpoint, trigger=trigger)
    while (last := _last_round(path)) is not None and not (left := waiting(last[2])).isEmpty():
        deliver(left, last[0], last[1] + 1)
    at = [F.regexp_extract("_metadata.file_path", r"batch=(\d+)/round=(\d+)/", n).cast("int").alias(c) for n, c in ((1, "batch"), (2, "round"))]
    return spark.read.schema(OUTCOMES).option("recursiveFileLookup", "true").option("pathGlobFilter", "*-*.{json,json.gz}").json(path).select("*", *at)


def _numbers(folder: str, name: str) -> list[int]:
    """The numbers of the folders ``name=<number>`` in a folder."""
    files, base = place(folder)
    found = [re.fullmatch(rf"{name}=(\d+)", f.base_name) for f in files.get_file_info(fs.FileSelector(base, allow_not_found=True))]
    return sorted(int(m[1]) for m in found if m)


def _last_round(path: str, batch_id: int | None = None) -> tuple[int, int, str] | None:
    """(batch, round, log) of the newest delivery, or of the newest of ``batch_id`` and before."""
    for batch in reversed([n for n in _numbers(path, "batch") if batch_id is None or n <= batch_id]):
        for turn in _numbers(f"{path}/batch={batch}", "round")[-1:]:
            return batch, turn, f"{path}/batch={batch}/round={turn}"
    return None
