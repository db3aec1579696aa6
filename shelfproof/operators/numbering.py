"""Numbers and exact samples in hash order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfproof.functions.text import keyed_hash

PREFIX = 4  # hex digits: 65,536 buckets, evenly filled by an md5


def ordinals(df: DataFrame, hex_hash: Column, name: str = "ordinal",
             groups: Sequence[str] = ()) -> DataFrame:
    """Number rows 0, 1, ... in hash order, per group if groups are given.

    A row's number is its place in its hash bucket plus the size of the buckets before it, so
    no task sees more than one bucket of a group, however large the group.
    """
    keys = [*groups, "_bucket"]
    hashed = df.withColumn("_hash", hex_hash).withColumn("_bucket", F.substring("_hash", 1, PREFIX))
    # At most 65,536 rows per group here.
    before = (Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = hashed.groupBy(keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(keys).orderBy("_hash")
    return (hashed.withColumn("_place", F.row_number().over(inside)).join(offsets, keys)
            .withColumn(name, F.col("_offset") + F.col("_place") - 1)
            .select(*df.columns, name))


def exact_sample(pool: DataFrame, key: str, fraction: float, seed: int, tag: str) -> DataFrame:
    """max(1, floor(fraction * rows)) rows, those with the lowest keyed hash.

    A histogram over hash prefixes finds the bucket where the sample ends; only that bucket is
    ordered. The result is a filter on one cutoff value.
    """
    hashed = pool.withColumn("_hash", keyed_hash(seed, tag, F.col(key)))
    bucket = F.substring("_hash", 1, PREFIX)
    everything = Window.partitionBy(F.lit(0))
    histogram = hashed.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    running = histogram.select(
        "_bucket", "_n", F.sum("_n").over(everything.orderBy("_bucket")).alias("_upto"),
        F.sum("_n").over(everything).alias("_rows"))
    wanted = F.greatest(F.lit(1), F.floor(F.col("_rows") * F.lit(float(fraction))))
    last = running.where((F.col("_upto") >= wanted) & (F.col("_upto") - F.col("_n") < wanted)) \
                  .select("_bucket", (wanted - F.col("_upto") + F.col("_n")).alias("_need"))
    # One row, so the broadcast is bounded.
    edge = hashed.withColumn("_bucket", bucket).join(F.broadcast(last), "_bucket")
    cutoff = (edge.withColumn("_place", F.row_number().over(
                  Window.partitionBy("_bucket").orderBy("_hash")))
              .where(F.col("_place") == F.col("_need")).select("_hash"))
    return hashed.where(F.col("_hash") <= cutoff.scalar()).drop("_hash")
