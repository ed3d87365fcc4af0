"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Epoch arithmetic assumes UTC, so the session time zone is pinned."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local master (tests) falls back to a temporary folder, remembered in the session. On a cluster a
    missing setting is an error: a machine-local folder would lose data with its executor.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.conf.get("pulsemill.shared.dir", None)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="pulsemill-")
        spark.conf.set("pulsemill.shared.dir", path)
    path, known = path.rstrip("/"), spark.sparkContext.getCheckpointDir()
    if known and not re.match(r"\w+:", path):
        # Spark looks for a path without a scheme in its default file system; where it found the folder, all executors find it.
        path = known.rpartition("/")[0]
    return path


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/pulsemill/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage at a point that survives lost executors, and freezes values that a re-run could
    assign differently (partition ids).
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
