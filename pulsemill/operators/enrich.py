"""Application tags and distinct tag sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.tags import app_point_tags, canonical_tags, empty_tags, first_wins, from_canonical
from pulsemill.operators.ranges import broadcast_if_small


def enrich_points(points: DataFrame, apps: DataFrame, key: str = "app_id") -> DataFrame:
    """Stamp points with the tags of their application; a point's own tags fill keys that are still free.

    The dimension is counted and broadcast when it is small, so that points stay where they are. Beyond that it is
    joined by shuffle, where adaptive execution splits a hot application.
    """
    tags = app_point_tags(*[F.col(c) for c in ("application", "service", "cluster", "shard", "custom")])
    stamped = broadcast_if_small(apps.select(F.col(key), tags.alias("_app_tags")))
    own = F.coalesce(F.col("tags"), empty_tags())
    return (
        points.join(stamped, key, "left")
        .withColumn("tags", first_wins(F.coalesce(F.col("_app_tags"), empty_tags()), own))
        .drop("_app_tags")
    )


def distinct_tag_sets(df: DataFrame, tags: str = "tags") -> DataFrame:
    """One row per tag content with its number of rows; entry order never matters."""
    sets = df.groupBy(canonical_tags(F.col(tags)).alias("canonical")).agg(F.count(F.lit(1)).alias("n_rows"))
    return sets.withColumn(tags, from_canonical(F.col("canonical")))
