"""Documents in ascending order of a numeric key, dealt out as ranges of about equal row counts."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARD, GUEST = "_shard", "_guest"


def with_shards(df: DataFrame, key: str, shards: int | None = None) -> DataFrame:
    """Adds the number of the key range that a row falls in; rows without a key come first.

    Only the key column is read to find the bounds. Equal keys share a range.
    """
    if shards is None:
        shards = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / shards for i in range(1, shards)]
    bounds = df.select(F.col(key).cast("double").alias("k")).approxQuantile("k", steps, 0.1 / shards)
    splits = [-math.inf, *sorted(set(bounds)), math.inf]
    if len(splits) < 3:  # no keys at all: one range
        return df.withColumn(SHARD, F.lit(0))
    placed = df.withColumn("_key", F.coalesce(F.col(key).cast("double"), F.lit(-math.inf)))
    bucket = Bucketizer(splits=splits, inputCol="_key", outputCol="_at")
    return bucket.transform(placed).withColumn(SHARD, F.col("_at").cast("int")).drop("_key", "_at")


def in_order(df: DataFrame, key: str, *ties: str) -> DataFrame:
    """Each range whole in one partition, its rows in ascending order."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, SHARD).sortWithinPartitions(
        SHARD, *([GUEST] if GUEST in df.columns else []),
        F.col(key).asc_nulls_first(), *ties)


def with_next_heads(df: DataFrame, key: str) -> DataFrame:
    """Rows of with_shards() plus, in each range, guests: the rows that the next range begins with.

    The range after the last is the first. The heads are one key per range; the rows that
    have such a key are copied during the one pass over the data.
    """
    heads = df.groupBy(SHARD).agg(F.min(key).alias("head"),
                                  F.max(F.col(key).isNull()).alias("none"))
    heads = sorted((r[SHARD], None if r["none"] else r["head"]) for r in heads.collect())
    if not heads:
        return df.withColumn(GUEST, F.lit(False))
    rows = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    targets = F.broadcast(df.sparkSession.createDataFrame(  # one row per range
        rows, T.StructType([T.StructField("_head", df.schema[key].dataType),
                            T.StructField("_before", T.IntegerType())])))
    own = F.struct(F.col(SHARD).alias("s"), F.lit(False).alias("g"))
    copy = F.struct(F.col("_before").alias("s"), F.lit(True).alias("g"))
    copies = F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, copy))
    return df.join(targets, F.col(key).eqNullSafe(F.col("_head")), "left") \
        .withColumn("_copy", F.explode(copies)) \
        .withColumns({SHARD: F.col("_copy.s"), GUEST: F.col("_copy.g")}) \
        .drop("_copy", "_head", "_before")
