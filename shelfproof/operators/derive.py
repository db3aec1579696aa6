"""Derived tables: promotion weeks, eligibility, picks, prices, listings, sites, change log.

Every draw is a keyed hash of the row's own keys, so a rerun gives the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfproof.functions import barcode, text
from shelfproof.operators.numbering import ordinals
from shelfproof.schema import CATEGORIES, PROMO_MECHANICS, TABLE_SCHEMAS

SEED = 42
OPEN_END = date(2099, 12, 31)

# Bounds of the price rules.
FIXED_LOW, FIXED_HIGH = "1.02", "0.95"          # of cost, of list price
PERCENT_STEPS, PERCENT_FALLBACK = (10, 15, 20, 25), 10
DOLLAR_LEAST, DOLLAR_MARGIN = "0.50", "0.50"
BUNDLE_LOW, BUNDLE_SPAN = "0.75", "0.15"        # of list price times quantity
PICKS_LEAST, PICKS_SPAN = 2, 5                  # two to six articles per promotion
LATE_START_PERCENT = 15


def _dec(value: str, kind: str = "decimal(6,4)") -> Column:
    return F.lit(value).cast(kind)


def _draw(h: Column, start: int, steps: int) -> Column:
    """0 .. steps-1 from seven hex digits of the hash."""
    return text.hash_slice(h, start) % steps


def _unit(h: Column, start: int) -> Column:
    """0.000 .. 1.000 as a decimal."""
    return (_draw(h, start, 1001) / 1000).cast("decimal(4,3)")


def _cents(amount: Column) -> Column:
    return F.round(amount, 2).cast("decimal(12,2)")


# ---- promotion weeks and status ---------------------------------------------------------

def promotion_weeks(df: DataFrame, day: str, weeks: Column) -> DataFrame:
    """Add a window that starts on the Thursday on or after `day` and ends on a Wednesday."""
    return (df.withColumn("header_start", text.snap_to_thursday(F.col(day).cast("date")))
            .withColumn("header_end", text.weeks_after(F.col("header_start"), weeks)))


def lifecycle_status(start: Column, end: Column, as_of: date, drafted: Column) -> Column:
    return (F.when(end < F.lit(as_of), "expired")
            .when(start > F.lit(as_of), F.when(drafted, "draft").otherwise("approved"))
            .otherwise("live"))


# ---- which articles a promotion may hold ------------------------------------------------

def promotable(articles: DataFrame) -> DataFrame:
    """Active articles of categories that may be promoted."""
    allowed = [name for name, *_, can in CATEGORIES if can]
    return articles.where((F.col("status") == "active") & F.col("merch_category").isin(allowed))


def _eligible(articles: DataFrame, listing: DataFrame) -> DataFrame:
    return (listing.select("store_group", "article_id").distinct()
            .join(promotable(articles).select("article_id"), "article_id", "left_semi"))


def eligible_counts(headers: DataFrame, articles: DataFrame, listing: DataFrame) -> DataFrame:
    """Number of articles each promotion may choose from."""
    per_group = _eligible(articles, listing).groupBy("store_group") \
        .agg(F.count(F.lit(1)).alias("eligible"))
    return headers.join(per_group, "store_group", "left").select(
        "promo_id", "store_group", F.coalesce("eligible", F.lit(0)).alias("eligible"))


def pick_articles(headers: DataFrame, articles: DataFrame, listing: DataFrame,
                  seed: int = SEED) -> DataFrame:
    """Two to six eligible articles per promotion (all, if there are fewer).

    A group's eligible articles are numbered in hash order and a promotion takes consecutive
    numbers from a drawn start, so nothing is built per (promotion, eligible article).
    """
    # Two narrow columns, read three times below.
    eligible = _eligible(articles, listing).persist(StorageLevel.MEMORY_AND_DISK)
    numbered = ordinals(eligible, text.keyed_hash(seed, "eligible", F.col("store_group"),
                                                  F.col("article_id")),
                        groups=["store_group"])
    sizes = eligible.groupBy("store_group").agg(F.count(F.lit(1)).alias("n"))
    h = text.keyed_hash(seed, "pick", F.col("promo_id"))
    k = F.least(F.col("n"), PICKS_LEAST + _draw(h, 1, PICKS_SPAN))
    start = text.hash_slice(h, 8) % F.col("n")
    slots = (headers.select("promo_id", "store_group", "header_start", "header_end")
             .join(sizes, "store_group")
             .withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), k - 1)))
             .withColumn("ordinal", (start + F.col("slot")) % F.col("n")))
    return slots.join(numbered, ["store_group", "ordinal"]).select(
        "promo_id", "store_group", "article_id", "slot", "header_start", "header_end")


def price_items(picks: DataFrame, articles: DataFrame, seed: int = SEED) -> DataFrame:
    """Mechanic, price fields and effective unit price of each picked article."""
    h = text.keyed_hash(seed, "price", F.col("promo_id"), F.col("article_id"))
    drawn = F.element_at(F.array(*[F.lit(m) for m in PROMO_MECHANICS]),
                         (_draw(h, 1, len(PROMO_MECHANICS)) + 1).cast("int"))
    single = F.col("base_uom").eqNullSafe("EA")
    listp, cost = (F.col(c).cast("decimal(12,2)") for c in ("list_price", "cost_price"))
    steps = F.element_at(F.array(*[F.lit(p) for p in PERCENT_STEPS]),
                         (_draw(h, 8, len(PERCENT_STEPS)) + 1).cast("int"))
    percent = F.when(listp * (100 - steps) < cost * 100, PERCENT_FALLBACK).otherwise(steps)
    low, high = cost * _dec(FIXED_LOW), listp * _dec(FIXED_HIGH)
    fixed = _cents(low + (high - low) * _unit(h, 15))
    least_off = _dec(DOLLAR_LEAST, "decimal(12,2)")
    most_off = F.greatest(least_off, listp - cost - _dec(DOLLAR_MARGIN, "decimal(12,2)"))
    dollars = _cents(least_off + (most_off - least_off) * _unit(h, 15))
    quantity = 2 + _draw(h, 22, 2)
    bundle = _cents(listp * quantity.cast("decimal(1,0)")
                    * (_dec(BUNDLE_LOW) + _dec(BUNDLE_SPAN) * _unit(h, 15)))
    mechanic = F.col("mechanic")
    priced = (
        picks.join(articles.select("article_id", "base_uom", "list_price", "cost_price"),
                   "article_id")
        .withColumn("mechanic", F.when((drawn == "multibuy") & ~single, "fixed_price")
                    .otherwise(drawn))
        .withColumn("promo_price", F.when(mechanic == "fixed_price", fixed.cast("double"))
                    .when(mechanic == "multibuy", bundle.cast("double")))
        .withColumn("discount_value", F.when(mechanic == "percent_off", percent.cast("double"))
                    .when(mechanic == "dollar_off", dollars.cast("double")))
        .withColumn("multibuy_qty", F.when(mechanic == "multibuy", quantity.cast("int"))))
    unit = (F.when(mechanic == "percent_off",
                   F.col("list_price") * (1 - F.col("discount_value") / 100))
            .when(mechanic == "dollar_off", F.col("list_price") - F.col("discount_value"))
            .when(mechanic == "multibuy", F.col("promo_price") / F.col("multibuy_qty"))
            .otherwise(F.col("promo_price")))
    return priced.withColumn("effective_unit_price", unit).drop(
        "base_uom", "list_price", "cost_price")


def item_windows(items: DataFrame, seed: int = SEED) -> DataFrame:
    """Item dates: the header's, or for some items of longer promotions a later week's start."""
    h = text.keyed_hash(seed, "window", F.col("promo_id"), F.col("article_id"))
    weeks = F.floor((F.datediff("header_end", "header_start") + 1) / 7)
    late = (weeks > 1) & (_draw(h, 1, 100) < LATE_START_PERCENT)
    later_week = 1 + text.hash_slice(h, 8) % F.greatest(weeks - 1, F.lit(1))
    start = F.when(late, F.date_add("header_start", (7 * later_week).cast("int"))) \
             .otherwise(F.col("header_start"))
    return items.withColumn("item_start", start).withColumn("item_end", F.col("header_end"))


def promotion_items(headers: DataFrame, articles: DataFrame, listing: DataFrame,
                    seed: int = SEED) -> DataFrame:
    """Valid promotion items for the headers, with the effective unit price."""
    # Numbered while still narrow.
    picks = ordinals(pick_articles(headers, articles, listing, seed),
                     text.keyed_hash(seed, "item", F.col("promo_id"), F.col("article_id")))
    return (item_windows(price_items(picks, articles, seed), seed)
            .withColumn("promo_item_id", text.padded("PIT", F.col("ordinal"), 6))
            .select(*TABLE_SCHEMAS["promotion_item"].names, "effective_unit_price"))


# ---- listing, site and change log -------------------------------------------------------

def listing(articles: DataFrame, groups: DataFrame, first_day: date, days: int,
            seed: int = SEED) -> DataFrame:
    """Each non-discontinued article in a drawn run of store groups, a quarter of them at least.

    `groups` is the dimension of store groups with its 0-based `ordinal`. Only the listed
    (article, group) rows are built.
    """
    total = groups.agg(F.count(F.lit(1))).scalar()
    h = text.keyed_hash(seed, "listing", F.col("article_id"))
    least = F.greatest(F.lit(1), F.floor(F.col("total") / 4))
    taken = F.col("least") + text.hash_slice(h, 1) % (F.col("total") - F.col("least") + 1)
    slots = (articles.where(F.col("status") != "discontinued").select("article_id")
             .withColumn("total", total).withColumn("least", least)
             .withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), taken - 1)))
             .withColumn("ordinal", (text.hash_slice(h, 8) + F.col("slot")) % F.col("total")))
    day = text.hash_slice(text.keyed_hash(seed, "since", F.col("article_id"),
                                          F.col("store_group")), 1) % days
    return slots.join(groups.select("store_group", "ordinal"), "ordinal").select(
        "store_group", "article_id",
        F.date_add(F.lit(first_day), day.cast("int")).alias("valid_from"),
        F.lit(OPEN_END).alias("valid_to"))


def article_site(listing: DataFrame, articles: DataFrame, seed: int = SEED) -> DataFrame:
    """Local price (98 to 106 percent of list) and stock of each listed article."""
    h = text.keyed_hash(seed, "site", F.col("article_id"), F.col("store_group"))
    factor = ((98 + _draw(h, 1, 9)) / 100).cast("decimal(4,2)")
    local = _cents(F.col("list_price").cast("decimal(12,2)") * factor).cast("double")
    return listing.join(articles.select("article_id", "list_price"), "article_id").select(
        "article_id", "store_group", local.alias("site_list_price"),
        F.lit(True).alias("listed"),
        F.when(_draw(h, 8, 10) == 0, "out_of_stock").otherwise("in_stock").alias("stock_status"),
        F.date_add("valid_from", _draw(h, 15, 365).cast("int")).alias("last_modified_date"))


def change_log(articles: DataFrame, headers: DataFrame, seed: int = SEED) -> DataFrame:
    """One 'create' row per article and per header, numbered in hash order."""
    nothing = [F.lit(None).cast("string").alias(c)
               for c in ("field_changed", "old_value", "new_value")]
    created_articles = articles.select(
        F.lit("article_master").alias("table_name"), F.col("article_id").alias("record_id"),
        F.lit("create").alias("change_type"), *nothing,
        F.lit("system").alias("changed_by"), F.col("created_date").alias("changed_at"))
    created_headers = headers.select(
        F.lit("promotion_header").alias("table_name"), F.col("promo_id").alias("record_id"),
        F.lit("create").alias("change_type"), *nothing,
        F.col("created_by").alias("changed_by"), F.col("created_date").alias("changed_at"))
    rows = created_articles.unionByName(created_headers)
    h = text.keyed_hash(seed, "change", F.col("table_name"), F.col("record_id"))
    return (ordinals(rows, h).withColumn("change_id", text.padded("CHG", F.col("ordinal"), 7))
            .select(TABLE_SCHEMAS["change_log"].names))


# ---- ids, barcodes, variants ------------------------------------------------------------

def mint_ids(df: DataFrame, key: str, prefix: str, width: int, name: str,
             seed: int = SEED) -> DataFrame:
    """Dense zero-padded ids, in hash order of the key."""
    numbered = ordinals(df, text.keyed_hash(seed, prefix, F.col(key)), "_number")
    return numbered.withColumn(name, text.padded(prefix, F.col("_number"), width)).drop("_number")


def mint_barcodes(df: DataFrame, key: str, prefix: int = 93) -> DataFrame:
    """Thirteen digits: prefix, ten digits of the key, check digit."""
    number = F.col(key)
    return df.withColumn("barcode", barcode.numbered(
        prefix, number, barcode.number_check_digit(prefix, number)))


DEFAULT_SIZES = ("Single", "Twin", "Family", "Bulk")


def variants(articles: DataFrame, sizes: Mapping[str, Sequence[str]] | None = None,
             seed: int = SEED) -> DataFrame:
    """Two to four variants of each generic article, linked to it and named after it."""
    default = F.array(*[F.lit(s) for s in DEFAULT_SIZES])
    names = default
    for category, options in (sizes or {}).items():
        names = F.when(F.col("merch_category") == category,
                       F.array(*[F.lit(s) for s in options])).otherwise(names)
    h = text.keyed_hash(seed, "variants", F.col("article_id"))
    count = F.least(F.size(names).cast("long"), 2 + _draw(h, 1, 3))
    start = text.hash_slice(h, 8)
    slots = F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
    return (articles.where(F.col("article_type") == "generic")
            .withColumn("slot", slots)
            .withColumn("size", F.element_at(
                names, ((start + F.col("slot")) % F.size(names) + 1).cast("int")))
            .select(
                F.concat_ws("-", "article_id", (F.col("slot") + 1).cast("string"))
                .alias("article_id"),
                F.concat(F.col("article_description"), F.lit(" - "), F.col("size"))
                .alias("article_description"),
                F.lit("variant").alias("article_type"),
                F.col("article_id").alias("parent_article_id"),
                "merch_category", "sub_category", "base_uom", "tax_code"))
