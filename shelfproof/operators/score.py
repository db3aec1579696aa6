"""Worklist against truth log: precision and recall per type and in total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfproof.schema import SCORECARD_SCHEMA, TRUTH_ALIAS, TRUTH_UNIT


def truth_type(error_type: Column) -> Column:
    """The truth log's name of an error type."""
    out = error_type
    for ours, theirs in TRUTH_ALIAS.items():
        out = F.when(error_type == ours, theirs).otherwise(out)
    return out


def found_keys(exceptions: DataFrame, items: DataFrame) -> DataFrame:
    """Exceptions as (error_type, key) in the truth log's names and counting unit.

    Exceptions that say their `unit` need not meet the items again.
    """
    kind = truth_type(F.col("error_type")).alias("error_type")
    if "unit" in exceptions.columns:
        return exceptions.select(kind, F.col("unit").alias("key"))
    lookup = items.select(F.col("promo_item_id").alias("record_id"), "article_id", "promo_id")
    unit = F.col("record_id")
    for name, column in TRUTH_UNIT.items():
        unit = F.when(F.col("error_type") == name, F.coalesce(column, "record_id")).otherwise(unit)
    # One join for all rows: the worklist is then evaluated once.
    return exceptions.select("error_type", "record_id").join(lookup, "record_id", "left") \
        .select(kind, unit.alias("key"))


def compare(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Distinct (error_type, key) of both sides with flags in_found, in_truth."""
    sides = (found.select("error_type", "key", F.lit(1).alias("f"), F.lit(0).alias("t"))
             .unionByName(truth.select("error_type", F.col("record_id").alias("key"),
                                       F.lit(0).alias("f"), F.lit(1).alias("t"))))
    # One aggregation, partial before the shuffle, in place of two distincts and an outer join.
    return sides.groupBy("error_type", "key").agg(
        (F.max("f") == 1).alias("in_found"), (F.max("t") == 1).alias("in_truth"))


def scorecard(exceptions: DataFrame, items: DataFrame, truth: DataFrame) -> DataFrame:
    """Per type: truth, found, TP, FP, FN, precision, recall; sorted by type."""
    keys = compare(found_keys(exceptions, items), truth)
    in_found, in_truth = F.col("in_found"), F.col("in_truth")
    counts = keys.groupBy("error_type").agg(
        F.count_if(in_truth).alias("ground_truth"), F.count_if(in_found).alias("found"),
        F.count_if(in_found & in_truth).alias("TP"), F.count_if(in_found & ~in_truth).alias("FP"),
        F.count_if(in_truth & ~in_found).alias("FN"))
    return (counts
            .withColumn("precision", F.round(F.try_divide("TP", "found"), 3))
            .withColumn("recall", F.round(F.try_divide("TP", "ground_truth"), 3))
            .select(SCORECARD_SCHEMA.names).orderBy("error_type"))


def overall(card: DataFrame) -> DataFrame:
    """One row of totals with precision, recall and f1; null where nothing was counted."""
    sums = card.agg(*[F.sum(c).alias(c) for c in ("TP", "FP", "FN")])
    precision = F.try_divide(F.col("TP"), F.col("TP") + F.col("FP"))
    recall = F.try_divide(F.col("TP"), F.col("TP") + F.col("FN"))
    return (sums.withColumn("precision", precision).withColumn("recall", recall)
            .withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"),
                                           F.col("precision") + F.col("recall"))))
