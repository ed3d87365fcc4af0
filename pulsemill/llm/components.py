"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.session import materialise


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges(u, v)``; the root is the smallest node that can be reached.

    Large-star and small-star rounds in turn: each links every node to the smallest neighbour it knows, as grouped
    aggregates and joins, so a node with very many links is combined map-side and no group is collected. Each round
    is written to the shared folder, which cuts the plan and survives lost executors. Rows with a null or with u = v
    give no link; an empty table gives no rows.
    """
    links = materialise(
        edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")

    def summary(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    state = summary(links)
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: neighbours above u go to u's smallest neighbour.
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: u and its smaller neighbours go to the smallest of them.
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*").where("u != v").distinct()
        links = materialise(small, "links")
        now = summary(links)
        if now == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
