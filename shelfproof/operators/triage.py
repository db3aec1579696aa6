"""Aggregates and filtered views of the worklist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfproof.schema import SEVERITY_ORDER, TRUTH_ALIAS, rule_dimension, severity_dimension


def _labels(spark) -> DataFrame:
    # Twelve rows.
    return F.broadcast(rule_dimension(spark).select("error_type", "check"))


def labelled(exceptions: DataFrame) -> DataFrame:
    """Add `check`, the readable name of the error type (the type itself if it has none)."""
    return (exceptions.join(_labels(exceptions.sparkSession), "error_type", "left")
            .withColumn("check", F.coalesce("check", "error_type")))


def records_scanned(articles: DataFrame, items: DataFrame) -> DataFrame:
    """Articles plus promotion items."""
    def count(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"))
    return count(articles).unionByName(count(items)).agg(F.sum("n").alias("records_scanned"))


def headline(exceptions: DataFrame) -> DataFrame:
    return exceptions.agg(F.count(F.lit(1)).alias("total_exceptions"),
                          F.count_if(F.col("severity") == "Critical").alias("critical_count"))


def detection_rates(card: DataFrame) -> DataFrame:
    """Overall precision and recall, 0 where nothing was counted."""
    tp, fp, fn = (F.coalesce(F.sum(c), F.lit(0)) for c in ("TP", "FP", "FN"))
    return card.agg(F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
                    F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"))


def severity_counts(exceptions: DataFrame) -> DataFrame:
    """Four rows in order of severity, with 0 for a severity that does not occur."""
    counts = exceptions.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    return (severity_dimension(exceptions.sparkSession).join(counts, "severity", "left")
            .select("severity_rank", "severity", F.coalesce("n", F.lit(0)).alias("n"))
            .orderBy("severity_rank"))


def observed_metrics() -> dict[str, Column]:
    """The headline and the four severities, to be observed while a worklist is written."""
    counts = {f"n_{s.lower()}": F.count_if(F.col("severity") == s) for s in SEVERITY_ORDER}
    return {"total_exceptions": F.count(F.lit(1)), **counts}


def record_sketches(exceptions: DataFrame, log_size: int = 14) -> DataFrame:
    """Per error type a sketch of its distinct records, to be merged over partitions and runs."""
    return exceptions.groupBy("error_type").agg(
        F.hll_sketch_agg("record_id", log_size).alias("sketch"))


def merged_records(sketches: DataFrame) -> DataFrame:
    """Per error type the estimated number of distinct records of all sketches together.

    The relative standard error is 1.04 / sqrt(2^log_size), 0.8 % for 14.
    """
    return sketches.groupBy("error_type").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("records"))


def type_counts(exceptions: DataFrame) -> DataFrame:
    counts = exceptions.groupBy("error_type", "severity").agg(F.count(F.lit(1)).alias("n"))
    return labelled(counts).select("error_type", "severity", "check", "n") \
                           .orderBy(F.desc("n"), "error_type", "severity")


def group_counts(exceptions: DataFrame) -> DataFrame:
    return (exceptions.where(F.col("store_group").isNotNull())
            .groupBy("store_group").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "store_group"))


def group_summary(exceptions: DataFrame) -> DataFrame:
    """Groups with exceptions, the most any holds, and the median cut to an integer."""
    return group_counts(exceptions).agg(
        F.count(F.lit(1)).alias("groups"), F.max("n").alias("worst"),
        F.floor(F.median("n")).cast("long").alias("median"))


def worst_groups(exceptions: DataFrame, top: int = 10) -> DataFrame:
    return group_counts(exceptions).limit(top)


def filtered(exceptions: DataFrame, severities: Sequence[str] = tuple(SEVERITY_ORDER),
             checks: Sequence[str] = (), groups: Sequence[str] = ()) -> DataFrame:
    """Rows of these severities; of these checks and store groups, unless none are named."""
    return labelled(exceptions).where(_chosen(severities, checks, groups))


def _chosen(severities: Sequence[str], checks: Sequence[str], groups: Sequence[str]) -> Column:
    out = F.col("severity").isin(list(severities))
    if checks:
        out = out & F.col("check").isin(list(checks))
    if groups:
        out = out & F.col("store_group").isin(list(groups))
    return out


def in_order(view: DataFrame) -> DataFrame:
    """Most severe first, then by check; the rank is kept as a column."""
    ranks = F.broadcast(severity_dimension(view.sparkSession))  # four rows
    return view.join(ranks, "severity").orderBy("severity_rank", "check", "record_id")


# Columns of the worklist view, in order.
WORKLIST_COLUMNS = ["severity", "check", "table_name", "record_id", "store_group",
                    "downstream_impact", "description"]


def worklist_view(view: DataFrame) -> DataFrame:
    return view.select(WORKLIST_COLUMNS)


def shown_of_total(exceptions: DataFrame, severities: Sequence[str] = tuple(SEVERITY_ORDER),
                   checks: Sequence[str] = (), groups: Sequence[str] = ()) -> DataFrame:
    """How many rows `filtered` shows, of how many."""
    return labelled(exceptions).agg(F.count_if(_chosen(severities, checks, groups)).alias("shown"),
                                    F.count(F.lit(1)).alias("total"))


def scorecard_view(card: DataFrame) -> DataFrame:
    """The scorecard under readable names."""
    ours = {theirs: ours for ours, theirs in TRUTH_ALIAS.items()}
    return (labelled(card.replace(ours, subset=["error_type"]))
            .select("check", "ground_truth", "found", "TP", "FP", "FN", "precision", "recall")
            .withColumnsRenamed({"check": "Check", "ground_truth": "Injected", "found": "Detected",
                                 "precision": "Precision", "recall": "Recall"}))


def filter_options(exceptions: DataFrame) -> DataFrame:
    """Distinct checks and store groups as (filter, option), sorted."""
    def option(name: str) -> Column:
        return F.struct(F.lit(name).alias("filter"), F.col(name).alias("option"))

    return (labelled(exceptions.groupBy("error_type", "store_group").agg(F.count(F.lit(1)).alias("n")))
            .select(F.inline(F.array(option("check"), option("store_group"))))
            .where(F.col("option").isNotNull()).distinct().orderBy("filter", "option"))


def bar_widths(counts: DataFrame, count: str = "n") -> DataFrame:
    """Each count as percent of the largest; for aggregated rows (severities, groups)."""
    largest = F.max(count).over(Window.partitionBy(F.lit(0)))
    return counts.where(F.col(count) > 0).withColumn("width", F.col(count) / largest * 100)


def log_counts(truth: DataFrame) -> DataFrame:
    return truth.groupBy("error_type", "severity").agg(F.count(F.lit(1)).alias("n")) \
                .orderBy("error_type", "severity")
