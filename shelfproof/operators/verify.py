"""Derive every defect again from corrupted tables and compare with the truth log."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfproof.functions import barcode
from shelfproof.operators import fused, gate, rules
from shelfproof.operators.score import compare
from shelfproof.schema import REFERENCE_DATE, Tables


def _keys(df: DataFrame, key: str, kind: str) -> DataFrame:
    return df.select(F.lit(kind).alias("error_type"), F.col(key).alias("key"))


def _item_side(t: Tables, as_of: date) -> DataFrame:
    """The eight types that items show, from one chain of joins."""
    col = F.col
    # Taken before the items meet the articles, so that no header's dates go on with them.
    enriched = fused.enrich(t, {"outside": col("has_header") & gate.outside()})
    floor_breach = (col("tobacco_floor_price").isNotNull()
                    & (col("promo_price") < col("tobacco_floor_price")))
    found = {
        ("referential_integrity", "promo_item_id"): ~col("has_article"),
        ("referential_timing", "article_id"):
            (col("article_status") == "discontinued") & (col("discontinued_date") < col("item_start")),
        ("listing_conflict", "promo_item_id"):
            col("has_header") & col("has_article") & ~col("is_listed"),
        ("header_item_date_mismatch", "promo_item_id"): col("outside"),
        ("uom_pack_mismatch", "article_id"):
            (col("mechanic") == "multibuy") & (col("base_uom") != "EA"),
        ("tobacco_floor_breach", "promo_item_id"): floor_breach,
        ("margin_breach", "promo_item_id"):
            col("mechanic").isin("fixed_price", "multibuy")
            & (col("promo_price") < col("cost_price")),
    }
    rows = F.array(*[F.when(holds, F.struct(F.lit(kind).alias("error_type"), col(key).alias("key")))
                     for (kind, key), holds in found.items()])
    return enriched.select(F.inline(F.filter(rows, lambda x: x.isNotNull())))


def actual_defects(t: Tables, truth: DataFrame, as_of: date = REFERENCE_DATE) -> DataFrame:
    """(error_type, key) of what is wrong in the tables, in the truth log's units.

    Differs from the rules where the log does: every cancelled header counts, a null date is not
    outside a window, tobacco counts below its floor price, and of near-duplicates only the
    existence of the logged records is tested.
    """
    articles, headers = t["article_master"], t["promotion_header"]
    logged_copies = truth.where(F.col("error_type") == "duplicate_near_duplicate") \
                         .select(F.col("record_id").alias("article_id"))
    return reduce(DataFrame.unionByName, [
        _item_side(t, as_of),
        _keys(headers.where(F.col("approval_status") == "cancelled"), "promo_id",
              "orphaned_cancelled_header"),
        _keys(articles.where(~barcode.is_valid(F.col("barcode"))), "article_id",
              "barcode_invalidity"),
        _keys(articles.where(rules.any_null(rules.REQUIRED_ARTICLE)), "article_id", "completeness"),
        _keys(headers.where(F.col("approval_status").isNull()), "promo_id", "completeness"),
        _keys(headers.where((F.col("approval_status") == "live")
                            & (F.col("header_end") < F.lit(as_of))), "promo_id", "stale_status"),
        _keys(articles.join(logged_copies, "article_id", "left_semi"), "article_id",
              "duplicate_near_duplicate"),
    ])


def log_check(t: Tables, truth: DataFrame, as_of: date = REFERENCE_DATE) -> DataFrame:
    """Per type: logged keys, keys logged but not in the data, in the data but not logged."""
    keys = compare(actual_defects(t, truth, as_of), truth)
    counts = keys.groupBy("error_type").agg(
        F.count_if("in_truth").alias("logged"),
        F.count_if(F.col("in_truth") & ~F.col("in_found")).alias("missing"),
        F.count_if(F.col("in_found") & ~F.col("in_truth")).alias("unlogged"))
    return counts.withColumn("status", F.when((F.col("missing") == 0) & (F.col("unlogged") == 0),
                                              "OK").otherwise("MISMATCH")).orderBy("error_type")


class LogMismatch(AssertionError):
    pass


def require_match(t: Tables, truth: DataFrame, as_of: date = REFERENCE_DATE) -> None:
    """Raise if the log and the data differ for any type. Twelve rows at most are read."""
    wrong = [row.error_type for row in log_check(t, truth, as_of).collect() if row.status != "OK"]
    if wrong:
        raise LogMismatch(f"{len(wrong)} types differ: {', '.join(wrong)}")


def log_size(truth: DataFrame) -> DataFrame:
    return truth.agg(F.count(F.lit(1)).alias("log_rows"),
                     F.countDistinct("error_type").alias("error_types"))
