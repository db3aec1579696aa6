"""Seeded defects: twelve kinds of corruption of clean tables, each one logged.

An injector picks records with an exact keyed-hash sample and gives `Defects`: the changes it
makes and the log rows. Changes are keyed by the record, so all of them are applied in one join
per table at the end, instead of twelve rewrites. An article or header is given to one injector
only, but for barcodes, which may hit an article that another one changed; items may carry
several defects, as in any real feed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfproof.functions import barcode, text
from shelfproof.operators.numbering import exact_sample
from shelfproof.schema import (
    REFERENCE_DATE,
    TABLE_SCHEMAS,
    TRUTH_IMPACT,
    TRUTH_SCHEMA,
    TRUTH_SEVERITY,
    Tables,
)
from shelfproof.session import cut_lineage

SEED = 7

# Share of the pool each injector corrupts.
RATES = {
    "referential_integrity": 0.06,
    "referential_timing": 0.05,
    "listing_conflict": 0.05,
    "header_item_date_mismatch": 0.06,
    "orphaned_cancelled_header": 0.25,
    "uom_pack_mismatch": 0.30,
    "tobacco_floor_breach": 0.08,
    "margin_breach": 0.05,
    "barcode_invalidity": 0.05,
    "duplicate_near_duplicate": 0.04,
    "completeness": 0.04,
    "completeness_header": 0.03,
    "stale_status": 0.20,
}
# What is appended to the description of a copied article.
COPY_SUFFIXES = [" - NEW", " (Promo Pack)", " V2", ""]


def _log(rows: DataFrame, kind: str, table: str, key: str, source: str, changed: str,
         old: Column, new: Column) -> DataFrame:
    """Truth rows. The id comes from the kind and the sampled record, not from a counter."""
    return rows.select(
        F.concat(F.lit("GT"), F.substring(F.md5(F.concat_ws(":", F.lit(kind), F.col(key),
                                                            F.col(source))), 1, 16)).alias("gt_id"),
        F.lit(table).alias("table_name"), F.col(key).alias("record_id"),
        F.lit(kind).alias("error_type"), F.lit(TRUTH_SEVERITY[kind]).alias("severity"),
        F.lit(TRUTH_IMPACT[kind]).alias("downstream_impact"),
        F.lit(changed).alias("field_changed"), old.cast("string").alias("old_value"),
        new.cast("string").alias("new_value"))


@dataclass
class Injection:
    """Clean tables and what has been decided so far. Each sample is written once and reused."""

    clean: Tables
    seed: int = SEED
    as_of: date = REFERENCE_DATE
    _done: dict[str, DataFrame] = field(default_factory=dict)

    def decide(self, name: str) -> DataFrame:
        """The changes of one injector, with its log columns."""
        if name not in self._done:
            self._done[name] = cut_lineage(DECISIONS[name](self))
        return self._done[name]

    def pick(self, pool: DataFrame, key: str, name: str) -> DataFrame:
        return exact_sample(pool, key, RATES[name], self.seed, name)

    def draw(self, name: str, key: str) -> Column:
        return text.keyed_hash(self.seed, f"{name}-value", F.col(key))


def _without(df: DataFrame, key: str, *taken: DataFrame) -> DataFrame:
    return reduce(lambda left, right: left.join(right.select(key), key, "left_anti"), taken, df)


# ---- decisions: one row per sampled record ----------------------------------------------

def _fake_articles(x: Injection) -> DataFrame:
    items = x.clean["promotion_item"].select("promo_item_id", "article_id")
    return x.pick(items, "promo_item_id", "referential_integrity").withColumn(
        "new_article", F.concat(F.lit("ARTFAKE_"), F.col("promo_item_id")))


def _known_items(x: Injection, items: DataFrame) -> DataFrame:
    """Items that still point at an existing article after the first injector."""
    articles = x.clean["article_master"].select("article_id")
    return _without(items, "promo_item_id", x.decide("referential_integrity")) \
        .join(articles, "article_id", "left_semi")


def _early_ends(x: Injection) -> DataFrame:
    name = "referential_timing"
    items = x.clean["promotion_item"].select("promo_item_id", "article_id", "item_start")
    days = (5 + text.hash_slice(x.draw(name, "promo_item_id"), 1) % 55).cast("int")
    status = x.clean["article_master"].select("article_id", F.col("status").alias("old"))
    return (_known_items(x, x.pick(items, "promo_item_id", name))
            .withColumn("new_date", F.date_sub("item_start", days)).join(status, "article_id"))


def _unlisted_pairs(x: Injection) -> DataFrame:
    """Pairs to delist, with every item that uses the pair."""
    name = "listing_conflict"
    groups = x.clean["promotion_header"].select("promo_id", "store_group")
    items = x.clean["promotion_item"].select("promo_item_id", "promo_id", "article_id")
    picked = _known_items(x, x.pick(items, "promo_item_id", name))
    pairs = (picked.join(groups, "promo_id").select("article_id", "store_group").distinct()
             .join(x.clean["listing"], ["article_id", "store_group"], "left_semi"))
    # The pairs are of known articles, and few items use them: what is asked of each comes after.
    using = items.join(groups, "promo_id").join(pairs, ["article_id", "store_group"], "left_semi") \
                 .select("promo_item_id", "article_id", "store_group")
    return _without(using, "promo_item_id", x.decide("referential_integrity"))


def _late_ends(x: Injection) -> DataFrame:
    name = "header_item_date_mismatch"
    items = x.clean["promotion_item"].select("promo_item_id", "promo_id", "item_end")
    headers = x.clean["promotion_header"].select("promo_id", "header_end")
    days = (2 + text.hash_slice(x.draw(name, "promo_item_id"), 1) % 8).cast("int")
    return x.pick(items, "promo_item_id", name).join(headers, "promo_id") \
            .withColumn("new_end", F.date_add("header_end", days))


def _cancelled(x: Injection) -> DataFrame:
    headers = x.clean["promotion_header"].select("promo_id", "approval_status")
    # Only a header with an item that is still to run can be cancelled wrongly.
    current = x.clean["promotion_item"].where(F.col("item_end") >= F.lit(x.as_of)).select("promo_id")
    pool = headers.where(F.col("approval_status").isin("live", "approved")) \
                  .join(current, "promo_id", "left_semi")
    return x.pick(pool, "promo_id", "orphaned_cancelled_header")


def _packs(x: Injection) -> DataFrame:
    name = "uom_pack_mismatch"
    items = x.clean["promotion_item"].where(F.col("mechanic") == "multibuy") \
                                     .select("promo_item_id", "article_id")
    # An item on a fake article is still in the pool, as its article was not touched.
    fake = x.decide("referential_integrity").select("promo_item_id", F.lit(True).alias("is_fake"))
    timed = x.decide("referential_timing").select("article_id", F.lit(True).alias("is_timed")) \
             .distinct()
    # Written, as a sample reads its pool three times.
    pool = cut_lineage(items.join(fake, "promo_item_id", "left").join(timed, "article_id", "left")
                       .where(F.col("is_fake").isNotNull() | F.col("is_timed").isNull())
                       .select("promo_item_id", "article_id"))
    units = x.clean["article_master"].select("article_id", F.col("base_uom").alias("old"))
    even = text.hash_slice(x.draw(name, "article_id"), 1) % 2 == 0
    return (_known_items(x, x.pick(pool, "promo_item_id", name)).join(units, "article_id")
            .withColumn("new_uom", F.when(even, "CTN").otherwise("PACK")))


def _cheap_tobacco(x: Injection) -> DataFrame:
    name = "tobacco_floor_breach"
    articles = x.clean["article_master"]
    pool = _without(articles.where((F.col("merch_category") == "TOBACCO")
                                   & (F.col("status") == "active")),
                    "article_id", x.decide("referential_timing"))
    left = x.clean["listing"].join(
        x.decide("listing_conflict").select("article_id", "store_group"),
        ["article_id", "store_group"], "left_anti")
    picked = (x.pick(pool.select("article_id", "cost_price", "tobacco_floor_price"),
                     "article_id", name)
              .where(F.col("tobacco_floor_price").isNotNull()))
    group = left.groupBy("article_id").agg(F.min("store_group").alias("store_group"))
    headers = x.clean["promotion_header"].select("promo_id", "store_group", "header_start",
                                                 "header_end")
    first = headers.groupBy("store_group").agg(F.min("promo_id").alias("promo_id"))
    any_first = headers.agg(F.min("promo_id")).scalar()
    low, high = F.col("cost_price") * 1.02, F.col("tobacco_floor_price") * 0.97
    low = F.when(low >= high, F.col("tobacco_floor_price") * 0.90).otherwise(low)
    price = F.round(low + (high - low) * text.hash_unit(x.draw(name, "article_id"), 1), 2)
    return (picked.join(group, "article_id").join(first, "store_group", "left")
            .withColumn("promo_id", F.coalesce(F.col("promo_id"), any_first))
            .join(headers.drop("store_group"), "promo_id")
            .select(F.concat(F.lit("PITTOB_"), F.col("article_id")).alias("promo_item_id"),
                    "promo_id", "article_id", "tobacco_floor_price", price.alias("promo_price"),
                    "header_start", "header_end"))


def _appended_items(x: Injection) -> DataFrame:
    added = x.decide("tobacco_floor_breach").select(
        "promo_item_id", "promo_id", "article_id", F.lit("fixed_price").alias("mechanic"),
        "promo_price", F.lit(None).cast("double").alias("discount_value"),
        F.lit(None).cast("int").alias("multibuy_qty"), F.col("header_start").alias("item_start"),
        F.col("header_end").alias("item_end"))
    return added.select(TABLE_SCHEMAS["promotion_item"].names)


def _loss_prices(x: Injection) -> DataFrame:
    name = "margin_breach"
    pool = (x.clean["promotion_item"].unionByName(_appended_items(x))
            .where(F.col("mechanic").isin("fixed_price", "multibuy"))
            .select("promo_item_id", "article_id", "promo_price"))
    costs = x.clean["article_master"].select("article_id", "cost_price")
    factor = 0.6 + 0.3 * text.hash_unit(x.draw(name, "promo_item_id"), 1)
    return (_known_items(x, x.pick(pool, "promo_item_id", name)).join(costs, "article_id")
            .withColumn("new_price", F.round(F.col("cost_price") * factor, 2)))


def _bad_barcodes(x: Injection) -> DataFrame:
    name = "barcode_invalidity"
    code = F.col("barcode")
    pool = x.clean["article_master"].where(code.rlike("^[0-9]{13}$")).select("article_id", "barcode")
    picked = x.pick(pool, "article_id", name)
    # A digit that is neither the present one nor, where that is wrong, the right one.
    present = F.ascii(F.substring(code, 13, 1)) - ord("0")
    gap = (barcode.check_digit(code) - present + 10) % 10
    draw = text.hash_slice(x.draw(name, "article_id"), 1)
    step = 1 + draw % F.when(gap == 0, 9).otherwise(8)
    step = F.when((gap > 0) & (step >= gap), step + 1).otherwise(step)
    wrong = (present + step) % 10
    return picked.withColumn("new_barcode", F.concat(
        code.substr(F.lit(1), F.length(code) - 1), wrong.cast("string")))


def _untouched_articles(x: Injection) -> DataFrame:
    """Written once: two samples read it three times each."""
    if "untouched" not in x._done:
        taken = (x.decide("referential_timing"), x.decide("uom_pack_mismatch"),
                 x.decide("barcode_invalidity"))
        x._done["untouched"] = cut_lineage(_without(x.clean["article_master"], "article_id", *taken))
    return x._done["untouched"]


def _copies(x: Injection) -> DataFrame:
    name = "duplicate_near_duplicate"
    suffix = F.element_at(F.array(*[F.lit(s) for s in COPY_SUFFIXES]),
                          (text.hash_slice(x.draw(name, "article_id"), 1) % 4 + 1).cast("int"))
    today = F.lit(x.as_of)
    return (x.pick(_untouched_articles(x), "article_id", name)
            .withColumn("source_id", F.col("article_id"))
            .withColumn("article_description", F.concat("article_description", suffix))
            # Sorts after every original id, so the copy is the later record.
            .withColumn("article_id", F.concat(F.lit("ARTDUP_"), F.col("source_id")))
            .withColumn("created_date", today).withColumn("last_modified_date", today))


def _nulled_articles(x: Injection) -> DataFrame:
    name = "completeness"
    pool = _untouched_articles(x).select("article_id", "base_uom", "tax_code")
    even = text.hash_slice(x.draw(name, "article_id"), 1) % 2 == 0
    return (x.pick(pool, "article_id", name)
            .withColumn("nulled", F.when(even, "base_uom").otherwise("tax_code"))
            .withColumn("old", F.when(even, F.col("base_uom")).otherwise(F.col("tax_code"))))


def _nulled_headers(x: Injection) -> DataFrame:
    pool = _without(x.clean["promotion_header"].select("promo_id", "approval_status"),
                    "promo_id", x.decide("orphaned_cancelled_header"))
    return x.pick(pool, "promo_id", "completeness_header")


def _stale(x: Injection) -> DataFrame:
    past = x.clean["promotion_header"].where(F.col("header_end") < F.lit(x.as_of)) \
                                      .select("promo_id", "approval_status")
    pool = _without(past, "promo_id", x.decide("orphaned_cancelled_header"),
                    x.decide("completeness_header"))
    return x.pick(pool, "promo_id", "stale_status") \
            .where(~F.col("approval_status").eqNullSafe("live"))


DECISIONS: dict[str, Callable[[Injection], DataFrame]] = {
    "referential_integrity": _fake_articles,
    "referential_timing": _early_ends,
    "listing_conflict": _unlisted_pairs,
    "header_item_date_mismatch": _late_ends,
    "orphaned_cancelled_header": _cancelled,
    "uom_pack_mismatch": _packs,
    "tobacco_floor_breach": _cheap_tobacco,
    "margin_breach": _loss_prices,
    "barcode_invalidity": _bad_barcodes,
    "duplicate_near_duplicate": _copies,
    "completeness": _nulled_articles,
    "completeness_header": _nulled_headers,
    "stale_status": _stale,
}


# ---- the log ----------------------------------------------------------------------------

def log_of(x: Injection, name: str) -> DataFrame:
    """Truth rows of one injector."""
    d, col = x.decide(name), F.col
    none = F.lit(None)
    item, article, header = ("promotion_item", "promo_item_id"), ("article_master", "article_id"), \
        ("promotion_header", "promo_id")
    kind = "completeness" if name == "completeness_header" else name
    if name == "completeness":  # the field differs from row to row
        return _log(d, kind, *article, "article_id", "", col("old"), none) \
            .drop("field_changed") \
            .join(d.select(col("article_id").alias("record_id"), col("nulled").alias("field_changed")),
                  "record_id").select(TRUTH_SCHEMA.names)
    target, source, changed, old, new = {
        "referential_integrity": (item, "promo_item_id", "article_id", "article_id", "new_article"),
        "referential_timing": (article, "promo_item_id", "status", "old",
                               F.lit("discontinued (after promo item_start)")),
        "listing_conflict": (item, "promo_item_id", "listing_row", F.lit("listed"),
                             F.lit("removed (delisted)")),
        "header_item_date_mismatch": (item, "promo_item_id", "item_end", "item_end", "new_end"),
        "orphaned_cancelled_header": (header, "promo_id", "approval_status", "approval_status",
                                      F.lit("cancelled (items still active)")),
        "uom_pack_mismatch": (article, "promo_item_id", "base_uom", "old", "new_uom"),
        "tobacco_floor_breach": (item, "promo_item_id", "promo_price", "floor", "price"),
        "margin_breach": (item, "promo_item_id", "promo_price", "old_price", "price"),
        "barcode_invalidity": (article, "article_id", "barcode", "barcode", "new_barcode"),
        "duplicate_near_duplicate": (article, "article_id", "article_id", "source_id",
                                     "article_id"),
        "completeness_header": (header, "promo_id", "approval_status", "approval_status", none),
        "stale_status": (header, "promo_id", "approval_status", "approval_status", F.lit("live")),
    }[name]
    if name == "tobacco_floor_breach":
        d = d.withColumn("floor", F.concat(F.lit("floor="), text.money(col("tobacco_floor_price")))) \
             .withColumn("price", text.money(col("promo_price")))
    if name == "margin_breach":
        d = d.withColumn("old_price", text.money(col("promo_price"))) \
             .withColumn("price", text.money(col("new_price")))
    old, new = (col(v) if isinstance(v, str) else v for v in (old, new))
    return _log(d, kind, *target, source, changed, old, new)


def truth_log(x: Injection) -> DataFrame:
    return reduce(DataFrame.unionByName, [log_of(x, name) for name in DECISIONS])


# ---- the corrupted tables ---------------------------------------------------------------

def _last_date(x: Injection) -> DataFrame:
    """One end date per article: that of the sampled item that comes last in hash order."""
    order = text.keyed_hash(x.seed, "referential_timing", F.col("promo_item_id"))
    return x.decide("referential_timing").groupBy("article_id").agg(
        F.max_by("new_date", order).alias("new_date"))


def corrupted_articles(x: Injection) -> DataFrame:
    timed = _last_date(x)
    packed = x.decide("uom_pack_mismatch").groupBy("article_id").agg(
        F.any_value("new_uom").alias("new_uom"))
    coded = x.decide("barcode_invalidity").select("article_id", "new_barcode")
    nulled = x.decide("completeness").select("article_id", "nulled")
    # One row per changed article, so that the article table is joined once.
    parts = [timed, packed, coded, nulled]
    changes = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) \
        .groupBy("article_id").agg(*[F.max(c).alias(c) for c in
                                     ("new_date", "new_uom", "new_barcode", "nulled")])
    keep = F.col
    changed = (x.clean["article_master"].join(changes, "article_id", "left").withColumns({
        "status": F.when(keep("new_date").isNotNull(), "discontinued").otherwise(keep("status")),
        "discontinued_date": F.coalesce("new_date", "discontinued_date"),
        "base_uom": F.when(F.coalesce("nulled", F.lit("")) != "base_uom",
                           F.coalesce("new_uom", "base_uom")),
        "tax_code": F.when(F.coalesce("nulled", F.lit("")) != "tax_code", keep("tax_code")),
        "barcode": F.coalesce("new_barcode", "barcode"),
    }))
    names = TABLE_SCHEMAS["article_master"].names
    return changed.select(names).unionByName(x.decide("duplicate_near_duplicate").select(names))


def _sampled(x: Injection, key: str, *names: str) -> Column:
    """Whether a record may be among the samples: none of them has a higher hash than its last."""
    def reached(name: str) -> Column:
        h = text.keyed_hash(x.seed, name, F.col(key))
        return F.coalesce(h <= x.decide(name).agg(F.max(h)).scalar(), F.lit(False))

    return reduce(Column.__or__, map(reached, names))


def corrupted_items(x: Injection) -> DataFrame:
    parts = [x.decide("referential_integrity").select("promo_item_id", "new_article"),
             x.decide("header_item_date_mismatch").select("promo_item_id", "new_end"),
             x.decide("margin_breach").select("promo_item_id", "new_price")]
    changes = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) \
        .groupBy("promo_item_id").agg(*[F.max(c).alias(c) for c in
                                        ("new_article", "new_end", "new_price")])
    items = x.clean["promotion_item"].unionByName(_appended_items(x))
    # Only the sampled items, about a sixth, are joined with the changes.
    sampled = _sampled(x, "promo_item_id", "referential_integrity", "header_item_date_mismatch",
                       "margin_breach")
    names = TABLE_SCHEMAS["promotion_item"].names
    changed = items.where(sampled).join(changes, "promo_item_id", "left").withColumns({
        "article_id": F.coalesce("new_article", "article_id"),
        "item_end": F.coalesce("new_end", "item_end"),
        "promo_price": F.coalesce("new_price", "promo_price"),
    })
    return changed.select(names).unionByName(items.where(~sampled).select(names))


def corrupted_headers(x: Injection) -> DataFrame:
    def to(name: str, value: Column) -> DataFrame:
        return x.decide(name).select("promo_id", F.struct(value.alias("value")).alias("change"))

    # The three pools are disjoint. A struct tells 'set to null' from 'unchanged'.
    changes = (to("orphaned_cancelled_header", F.lit("cancelled"))
               .unionByName(to("completeness_header", F.lit(None).cast("string")))
               .unionByName(to("stale_status", F.lit("live"))))
    status = F.when(F.col("change").isNotNull(), F.col("change.value")) \
              .otherwise(F.col("approval_status"))
    return (x.clean["promotion_header"].join(changes, "promo_id", "left")
            .withColumn("approval_status", status)
            .select(TABLE_SCHEMAS["promotion_header"].names))


def corrupted_listing(x: Injection) -> DataFrame:
    gone = x.decide("listing_conflict").select("article_id", "store_group")
    return x.clean["listing"].join(gone, ["article_id", "store_group"], "left_anti") \
            .select(TABLE_SCHEMAS["listing"].names)


def inject(clean: Tables, seed: int = SEED,
           as_of: date = REFERENCE_DATE) -> tuple[Tables, DataFrame]:
    """Corrupted tables and truth log. Site and change-log rows stay as they are."""
    x = Injection(clean, seed, as_of)
    dirty = clean.replace(
        article_master=corrupted_articles(x), promotion_item=corrupted_items(x),
        promotion_header=corrupted_headers(x), listing=corrupted_listing(x))
    return dirty, truth_log(x)
