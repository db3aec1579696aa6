"""Connected components of links, and tables staged in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfproof.session import shared_folder


def staged(df: DataFrame) -> DataFrame:
    """The rows written as Parquet beside the session's checkpoints, and read again."""
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked with the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b): the least node that it reaches.

    Stars alternate until nothing changes; the number of turns grows with the logarithm of
    the longest path. Each turn is a written table, so a lost executor costs one turn.
    """
    edges = staged(links.select("a", "b").filter("a != b").distinct())
    state = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == state or mark[0] == 0:
            break
        state = mark
        edges = staged(_small_star(_large_star(edges)))
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))) \
        .distinct()
