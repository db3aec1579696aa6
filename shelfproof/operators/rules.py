"""The twelve rules, one plan each, and the registry that runs them.

Every rule takes the tables and a reference date and gives `record_id` and `description`.
The registry adds the constant columns. `fused.worklist` gives the same rows in fewer passes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfproof.functions import barcode, text
from shelfproof.operators import near_duplicates
from shelfproof.schema import IMPACT, LABEL, REFERENCE_DATE, RULE_COLUMNS, SEVERITY, Tables


# ---- rule shapes, usable on any tables --------------------------------------------------

def dangling(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of child whose key has no parent. A null key has none."""
    parents = parent.select(F.col(parent_key).alias(key))
    return child.join(parents, key, "left_anti")


def outside_window(start: Column, end: Column, low: Column, high: Column) -> Column:
    """True unless both dates lie in [low, high]; a null date counts as outside."""
    inside = start.between(low, high) & end.between(low, high)
    return ~F.coalesce(inside, F.lit(False))


def missing_names(columns: Sequence[str]) -> Column:
    """Names of the null columns as 'a, b'; empty if none is null."""
    return F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])


def any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


# ---- texts of the worklist, fixed values ------------------------------------------------
# Each is a pattern with one %s per value, in order.

TEXTS = {
    "referential_integrity": "promo_item %s references article_id '%s', "
                             "which does not exist in article_master.",
    "referential_timing": "promo_item %s promotes article '%s', discontinued on %s, "
                          "before the promo item started on %s.",
    "listing_conflict": "promo_item %s promotes article '%s' in store_group '%s', "
                        "but the article isn't listed there.",
    "header_item_date_mismatch": "promo_item %s runs %s to %s, outside header window %s to %s.",
    "orphaned_cancelled_header": "promo_item %s's header (%s) is cancelled, "
                                 "but the item still runs until %s.",
    "uom_pack_mismatch": "promo_item %s uses multibuy on article '%s', sold as %s, not EA.",
    "tobacco_on_promotion": "promo_item %s promotes tobacco article '%s'.",
    "margin_breach": "promo_item %s prices article '%s' at $%s, below cost $%s.",
    "barcode_invalidity": "article '%s' has barcode '%s', invalid check digit.",
    "duplicate_near_duplicate": "article '%s' looks like a near-duplicate of '%s', "
                                "similarity %s%%.",
    "completeness": "article '%s' missing: %s.",
    "completeness_header": "promotion_header '%s' missing approval_status.",
    "stale_status": "promotion_header '%s' marked live but header_end (%s) has passed.",
}


def sentence(name: str, *values: Column | str) -> Column:
    """The rule's text with the values filled in."""
    texts = [part.replace("%%", "%") for part in TEXTS[name].split("%s")]
    columns = [F.col(v) if isinstance(v, str) else v for v in values]
    filled = [F.lit(texts[0])]
    for value, after in zip(columns, texts[1:], strict=True):
        filled += [value.cast("string"), F.lit(after)]
    return F.concat_ws("", *filled)


# ---- the rules --------------------------------------------------------------------------

def referential_integrity(t: Tables, as_of: date) -> DataFrame:
    return dangling(t["promotion_item"], "article_id", t["article_master"], "article_id").select(
        F.col("promo_item_id").alias("record_id"),
        sentence("referential_integrity", "promo_item_id", "article_id").alias("description"))


def referential_timing(t: Tables, as_of: date) -> DataFrame:
    gone = t["article_master"].where(F.col("status") == "discontinued") \
                              .select("article_id", "discontinued_date")
    return (t["promotion_item"].join(gone, "article_id")
            .where(F.col("discontinued_date") < F.col("item_start"))
            .select(F.col("promo_item_id").alias("record_id"),
                    sentence("referential_timing", "promo_item_id", "article_id",
                             "discontinued_date", "item_start").alias("description")))


def listing_conflict(t: Tables, as_of: date, within_window: bool = False) -> DataFrame:
    """Items on an article their store group does not list.

    With within_window, a listing only counts if it covers the item's dates.
    """
    headers = t["promotion_header"].select("promo_id", "store_group")
    known = t["article_master"].select("article_id")
    listed = t["listing"].where(F.col("valid_from").isNotNull())
    items = (t["promotion_item"].join(headers, "promo_id")
             .join(known, "article_id", "left_semi").alias("i"))
    if within_window:
        same = ((F.col("i.article_id") == F.col("l.article_id"))
                & (F.col("i.store_group") == F.col("l.store_group"))
                & (F.col("i.item_start") >= F.col("l.valid_from"))
                & (F.col("i.item_end") <= F.col("l.valid_to")))
        unlisted = items.join(listed.alias("l"), same, "left_anti")
    else:  # the groups of an article are one row, so the items do not move again by group
        groups = listed.groupBy("article_id").agg(F.collect_set("store_group").alias("listed_in"))
        unlisted = items.join(groups, "article_id", "left").where(
            ~F.coalesce(F.array_contains("listed_in", F.col("store_group")), F.lit(False)))
    return unlisted.select(
        F.col("promo_item_id").alias("record_id"),
        sentence("listing_conflict", "promo_item_id", "article_id", "store_group")
        .alias("description"))


def header_item_date_mismatch(t: Tables, as_of: date) -> DataFrame:
    headers = t["promotion_header"].select("promo_id", "header_start", "header_end")
    return (t["promotion_item"].join(headers, "promo_id")
            .where(outside_window(F.col("item_start"), F.col("item_end"),
                                  F.col("header_start"), F.col("header_end")))
            .select(F.col("promo_item_id").alias("record_id"),
                    sentence("header_item_date_mismatch", "promo_item_id", "item_start",
                             "item_end", "header_start", "header_end").alias("description")))


def orphaned_cancelled_header(t: Tables, as_of: date) -> DataFrame:
    cancelled = t["promotion_header"].where(F.col("approval_status") == "cancelled") \
                                     .select("promo_id")
    return (t["promotion_item"].where(F.col("item_end") >= F.lit(as_of))
            .join(cancelled, "promo_id")
            .select(F.col("promo_item_id").alias("record_id"),
                    sentence("orphaned_cancelled_header", "promo_item_id", "promo_id",
                             "item_end").alias("description")))


def uom_pack_mismatch(t: Tables, as_of: date) -> DataFrame:
    packs = t["article_master"].where(F.col("base_uom") != "EA").select("article_id", "base_uom")
    return (t["promotion_item"].where(F.col("mechanic") == "multibuy")
            .join(packs, "article_id")
            .select(F.col("promo_item_id").alias("record_id"),
                    sentence("uom_pack_mismatch", "promo_item_id", "article_id",
                             "base_uom").alias("description")))


def tobacco_on_promotion(t: Tables, as_of: date) -> DataFrame:
    tobacco = t["article_master"].where(F.col("merch_category") == "TOBACCO") \
                                 .select("article_id")
    return t["promotion_item"].join(tobacco, "article_id").select(
        F.col("promo_item_id").alias("record_id"),
        sentence("tobacco_on_promotion", "promo_item_id", "article_id").alias("description"))


def margin_breach(t: Tables, as_of: date, per_unit: bool = False,
                  all_mechanics: bool = False) -> DataFrame:
    """Items priced below cost.

    per_unit divides a multibuy's bundle price by its quantity; all_mechanics also tests the
    price that a percentage or amount off leaves. Both are off by default.
    """
    price = F.col("promo_price")
    if per_unit:
        price = F.when(F.col("mechanic") == "multibuy", price / F.col("multibuy_qty")) \
                 .otherwise(price)
    items = t["promotion_item"]
    if all_mechanics:
        off = F.col("discount_value")
        price = (F.when(F.col("mechanic") == "percent_off", F.col("list_price") * (1 - off / 100))
                 .when(F.col("mechanic") == "dollar_off", F.col("list_price") - off)
                 .otherwise(price))
    else:
        items = items.where(F.col("mechanic").isin("fixed_price", "multibuy"))
    costs = t["article_master"].select("article_id", "cost_price", "list_price")
    return (items.join(costs, "article_id").withColumn("unit_price", price)
            .where(F.col("unit_price") < F.col("cost_price"))
            .select(F.col("promo_item_id").alias("record_id"),
                    sentence("margin_breach", "promo_item_id", "article_id",
                             text.money(F.col("unit_price")), text.money(F.col("cost_price")))
                    .alias("description")))


def barcode_invalidity(t: Tables, as_of: date) -> DataFrame:
    return t["article_master"].where(~barcode.is_valid(F.col("barcode"))).select(
        F.col("article_id").alias("record_id"),
        sentence("barcode_invalidity", "article_id", "barcode").alias("description"))


def duplicate_near_duplicate(t: Tables, as_of: date, threshold: int = 97) -> DataFrame:
    """One row per article that has earlier near-duplicates, naming the earliest of them."""
    return near_duplicates.flagged(t["article_master"], threshold).select(
        "record_id",
        sentence("duplicate_near_duplicate", "record_id", "first_match",
                 text.whole(F.col("score"))).alias("description"))


REQUIRED_ARTICLE = ["base_uom", "tax_code"]


def completeness_article(t: Tables, as_of: date) -> DataFrame:
    return t["article_master"].where(any_null(REQUIRED_ARTICLE)).select(
        F.col("article_id").alias("record_id"),
        sentence("completeness", "article_id", missing_names(REQUIRED_ARTICLE))
        .alias("description"))


def completeness_header(t: Tables, as_of: date) -> DataFrame:
    return t["promotion_header"].where(F.col("approval_status").isNull()).select(
        F.col("promo_id").alias("record_id"),
        sentence("completeness_header", "promo_id").alias("description"))


def stale_status(t: Tables, as_of: date) -> DataFrame:
    return (t["promotion_header"]
            .where((F.col("approval_status") == "live") & (F.col("header_end") < F.lit(as_of)))
            .select(F.col("promo_id").alias("record_id"),
                    sentence("stale_status", "promo_id", "header_end").alias("description")))


# ---- registry ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """One check on one table: `find(tables, as_of)` gives record_id and description."""

    name: str
    table: str
    find: Callable[[Tables, date], DataFrame]
    severity: str
    impact: str
    label: str

    def __call__(self, tables: Tables, as_of: date = REFERENCE_DATE) -> DataFrame:
        return tag(self.find(tables, as_of), self.name, self.table, self.severity, self.impact)


def tag(found: DataFrame, name: str, table: str, severity: str, impact: str) -> DataFrame:
    return (found.withColumn("table_name", F.lit(table)).withColumn("error_type", F.lit(name))
            .withColumn("severity", F.lit(severity))
            .withColumn("downstream_impact", F.lit(impact)).select(RULE_COLUMNS))


def _rule(name: str, table: str, find: Callable[..., DataFrame]) -> Rule:
    return Rule(name, table, find, SEVERITY[name], IMPACT[name], LABEL[name])


RULES: list[Rule] = [
    _rule("referential_integrity", "promotion_item", referential_integrity),
    _rule("referential_timing", "promotion_item", referential_timing),
    _rule("listing_conflict", "promotion_item", listing_conflict),
    _rule("header_item_date_mismatch", "promotion_item", header_item_date_mismatch),
    _rule("orphaned_cancelled_header", "promotion_item", orphaned_cancelled_header),
    _rule("uom_pack_mismatch", "promotion_item", uom_pack_mismatch),
    _rule("tobacco_on_promotion", "promotion_item", tobacco_on_promotion),
    _rule("margin_breach", "promotion_item", margin_breach),
    _rule("barcode_invalidity", "article_master", barcode_invalidity),
    _rule("duplicate_near_duplicate", "article_master", duplicate_near_duplicate),
    _rule("completeness", "article_master", completeness_article),
    _rule("completeness", "promotion_header", completeness_header),
    _rule("stale_status", "promotion_header", stale_status),
]


def run(tables: Tables, as_of: date = REFERENCE_DATE,
        rules: Sequence[Rule] = tuple(RULES)) -> DataFrame:
    """All rules' rows stacked, duplicates kept."""
    return reduce(DataFrame.unionByName, [rule(tables, as_of) for rule in rules])


def run_rule(name: str, tables: Tables, as_of: date = REFERENCE_DATE) -> DataFrame:
    return run(tables, as_of, [rule for rule in RULES if rule.name == name])


def with_store_group(exceptions: DataFrame, tables: Tables) -> DataFrame:
    """Add the promotion's store group; article rows have none."""
    headers = tables["promotion_header"].select("promo_id", "store_group")
    of_item = (tables["promotion_item"].select("promo_item_id", "promo_id")
               .join(headers, "promo_id")
               .select(F.lit("promotion_item").alias("table_name"),
                       F.col("promo_item_id").alias("record_id"), "store_group"))
    of_header = headers.select(F.lit("promotion_header").alias("table_name"),
                               F.col("promo_id").alias("record_id"), "store_group")
    return exceptions.join(of_item.unionByName(of_header), ["table_name", "record_id"], "left") \
                     .select(*RULE_COLUMNS, "store_group")


def totals(exceptions: DataFrame, rules: Sequence[Rule] = tuple(RULES)) -> DataFrame:
    """Number of checks and of exceptions found."""
    return exceptions.agg(F.lit(len({rule.name for rule in rules})).cast("long").alias("checks"),
                          F.count(F.lit(1)).alias("exceptions"))
