"""The worklist in one pass per table.

Item rules share one chain of joins, article and header rules one scan each. Rows equal those of
`rules.run` plus `rules.with_store_group` when the tables' keys are unique
(`gate.key_uniqueness` tests that).
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfproof.functions import barcode, text
from shelfproof.operators import near_duplicates, rules
from shelfproof.schema import IMPACT, REFERENCE_DATE, SEVERITY, TRUTH_UNIT, Tables


def enrich(tables: Tables, early: Mapping[str, Column] | None = None,
           only: Mapping[str, Column] | None = None) -> DataFrame:
    """Items with what the rules need of article, header and listing; nothing is dropped.

    The store groups that list an article are one row, so the items, by far the most rows, need not
    move again by article and group after they have met the articles. `early`: columns taken from
    item and header before the items move to the articles; `only`: columns that go on with them
    where a condition holds, and are null elsewhere. Both make these rows narrower.
    """
    articles = tables["article_master"].select(
        "article_id", F.lit(True).alias("has_article"),
        F.col("status").alias("article_status"), "discontinued_date", "merch_category",
        "base_uom", "cost_price", "tobacco_floor_price")
    headers = tables["promotion_header"].select(
        "promo_id", F.lit(True).alias("has_header"), "header_start", "header_end",
        "store_group", "approval_status")
    listed = tables["listing"].where(F.col("valid_from").isNotNull()) \
        .groupBy("article_id").agg(F.collect_list("store_group").alias("listed_in")) \
        .withColumn("repeats", F.size(F.array_distinct("listed_in")) < F.size("listed_in"))
    items = tables["promotion_item"].select(
        "promo_item_id", "promo_id", "article_id", "mechanic", "promo_price",
        "item_start", "item_end")
    met = items.join(headers, "promo_id", "left") \
        .withColumn("has_header", F.coalesce("has_header", F.lit(False))).withColumns(early or {}) \
        .withColumns({c: F.when(holds, F.col(c)) for c, holds in (only or {}).items()})
    group = F.col("store_group")
    times = F.when(F.array_contains("listed_in", group), F.when(
        F.col("repeats"), F.size("listed_in") - F.size(F.array_remove("listed_in", group)))
        .otherwise(1)).otherwise(0)
    # A pair that is listed several times gives its items as often, like a join.
    is_listed = F.explode(F.array_repeat(times > 0, F.greatest(times, F.lit(1))))
    return (met.join(articles, "article_id", "left")
            .join(listed, "article_id", "left")
            .withColumn("has_article", F.coalesce("has_article", F.lit(False)))
            .withColumn("is_listed", is_listed).drop("listed_in", "repeats"))


def header_findings(as_of: date) -> dict[str, Column]:
    """Conditions of the item rules that item and header decide."""
    col = F.col
    return {"outside": col("has_header") & rules.outside_window(
                col("item_start"), col("item_end"), col("header_start"), col("header_end")),
            "orphaned": (col("approval_status") == "cancelled") & (col("item_end") >= F.lit(as_of))}


def enriched_for_rules(tables: Tables, as_of: date) -> DataFrame:
    """`enrich` with the header's conditions; what only texts or other mechanics' rules need is null."""
    outside, orphaned = F.col("outside"), F.col("orphaned")
    priced = F.col("mechanic").isin("fixed_price", "multibuy")
    return enrich(tables, header_findings(as_of), {
        "header_start": outside, "header_end": outside, "item_end": outside | orphaned,
        "promo_id": orphaned, "promo_price": priced, "mechanic": priced})


def item_findings(as_of: date) -> list[tuple[str, Column, Column]]:
    """Rule, condition and description over the columns of `enrich` and `header_findings`."""
    col = F.col
    say = rules.sentence
    return [
        ("referential_integrity", ~col("has_article"),
         say("referential_integrity", "promo_item_id", "article_id")),
        ("referential_timing",
         (col("article_status") == "discontinued") & (col("discontinued_date") < col("item_start")),
         say("referential_timing", "promo_item_id", "article_id", "discontinued_date",
             "item_start")),
        ("listing_conflict", col("has_header") & col("has_article") & ~col("is_listed"),
         say("listing_conflict", "promo_item_id", "article_id", "store_group")),
        ("header_item_date_mismatch", col("outside"),
         say("header_item_date_mismatch", "promo_item_id", "item_start", "item_end",
             "header_start", "header_end")),
        ("orphaned_cancelled_header", col("orphaned"),
         say("orphaned_cancelled_header", "promo_item_id", "promo_id", "item_end")),
        ("uom_pack_mismatch", (col("mechanic") == "multibuy") & (col("base_uom") != "EA"),
         say("uom_pack_mismatch", "promo_item_id", "article_id", "base_uom")),
        ("tobacco_on_promotion", col("merch_category") == "TOBACCO",
         say("tobacco_on_promotion", "promo_item_id", "article_id")),
        ("margin_breach",
         col("mechanic").isin("fixed_price", "multibuy") & (col("promo_price") < col("cost_price")),
         say("margin_breach", "promo_item_id", "article_id", text.money(col("promo_price")),
             text.money(col("cost_price")))),
    ]


def emit(df: DataFrame, table: str, key: str, group: Column,
         findings: list[tuple[str, Column, Column]], units: bool = False) -> DataFrame:
    """One output row per condition that holds.

    Only the rules' numbers are exploded; texts are built after that, for the rows that remain.
    `units` adds the key that the truth log counts by.
    """
    hits = F.array_compact(F.array(*[F.when(holds, F.lit(n))
                                     for n, (_, holds, _) in enumerate(findings)]))
    names = [name for name, _, _ in findings]

    def constant(values: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("rule") + 1)

    text_of = F.lit(None).cast("string")
    for n, (_, _, description) in enumerate(findings):
        text_of = F.when(F.col("rule") == n, description).otherwise(text_of)
    unit = F.col(key)
    for n, name in enumerate(names):
        if name in TRUTH_UNIT:
            unit = F.when(F.col("rule") == n, F.coalesce(TRUTH_UNIT[name], key)).otherwise(unit)
    return (df.withColumn("rule", F.explode(hits))
            .select(F.lit(table).alias("table_name"), F.col(key).alias("record_id"),
                    constant(names).alias("error_type"),
                    constant([SEVERITY[name] for name in names]).alias("severity"),
                    constant([IMPACT[name] for name in names]).alias("downstream_impact"),
                    text_of.alias("description"), group.alias("store_group"),
                    *[unit.alias("unit")] * units))


def item_exceptions(enriched: DataFrame, as_of: date = REFERENCE_DATE,
                    units: bool = False) -> DataFrame:
    if "outside" not in enriched.columns:
        enriched = enriched.withColumns(header_findings(as_of))
    return emit(enriched, "promotion_item", "promo_item_id", F.col("store_group"),
                item_findings(as_of), units)


def article_exceptions(articles: DataFrame, units: bool = False) -> DataFrame:
    say = rules.sentence
    return emit(articles, "article_master", "article_id", F.lit(None).cast("string"), [
        ("barcode_invalidity", ~barcode.is_valid(F.col("barcode")),
         say("barcode_invalidity", "article_id", "barcode")),
        ("completeness", rules.any_null(rules.REQUIRED_ARTICLE),
         say("completeness", "article_id", rules.missing_names(rules.REQUIRED_ARTICLE))),
    ], units)


def duplicate_exceptions(articles: DataFrame, threshold: int = 97,
                         units: bool = False) -> DataFrame:
    return emit(near_duplicates.flagged(articles, threshold), "article_master", "record_id",
                F.lit(None).cast("string"),
                [("duplicate_near_duplicate", F.lit(True),
                  rules.sentence("duplicate_near_duplicate", "record_id", "first_match",
                                 text.whole(F.col("score"))))], units)


def header_exceptions(headers: DataFrame, as_of: date = REFERENCE_DATE,
                      units: bool = False) -> DataFrame:
    say = rules.sentence
    return emit(headers, "promotion_header", "promo_id", F.col("store_group"), [
        ("completeness", F.col("approval_status").isNull(), say("completeness_header", "promo_id")),
        ("stale_status",
         (F.col("approval_status") == "live") & (F.col("header_end") < F.lit(as_of)),
         say("stale_status", "promo_id", "header_end")),
    ], units)


def worklist(tables: Tables, as_of: date = REFERENCE_DATE, threshold: int = 97,
             units: bool = False) -> DataFrame:
    """All exceptions of the twelve rules, with store group; with `unit`, for scoring, if asked."""
    return (item_exceptions(enriched_for_rules(tables, as_of), as_of, units)
            .unionByName(article_exceptions(tables["article_master"], units))
            .unionByName(duplicate_exceptions(tables["article_master"], threshold, units))
            .unionByName(header_exceptions(tables["promotion_header"], as_of, units)))
