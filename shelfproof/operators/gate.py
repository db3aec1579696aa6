"""Baseline gate: ten assertions that must hold before defects are injected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfproof.functions import barcode
from shelfproof.operators import rules
from shelfproof.schema import PRIMARY_KEYS, Tables

# Names of the assertions, in order.
ASSERTIONS = {
    "v01": "promo item -> article exists",
    "v02": "promo item -> header exists",
    "v03": "variant -> generic parent exists",
    "v04": "barcode check-digit valid",
    "v05": "fixed_price >= cost (no margin breach)",
    "v06": "item window inside header window",
    "v07": "promoted article listed in store group",
    "v08": "no tobacco articles on promo",
    "v09": "multibuy only on EA base_uom",
    "v10": "required article fields populated",
}
# Columns of an article that must be filled.
REQUIRED = ["article_id", "article_description", "article_type", "merch_category", "base_uom",
            "barcode", "tax_code", "list_price", "cost_price", "status"]


def outside(item_start: str = "item_start", item_end: str = "item_end") -> Column:
    """Starts before or ends after the header; a null date is not outside."""
    return (F.col(item_start) < F.col("header_start")) | (F.col(item_end) > F.col("header_end"))


def _items(t: Tables) -> DataFrame:
    return t["promotion_item"]


def _unlisted(t: Tables) -> DataFrame:
    headers = t["promotion_header"].select("promo_id", "store_group")
    pairs = t["listing"].select("article_id", "store_group")
    return _items(t).select("promo_id", "article_id").join(headers, "promo_id") \
                    .join(pairs, ["article_id", "store_group"], "left_anti")


def _orphan_variants(t: Tables) -> DataFrame:
    articles = t["article_master"]
    generics = articles.where(F.col("article_type") == "generic")
    variants = articles.where(F.col("article_type") == "variant").select("parent_article_id")
    return rules.dangling(variants, "parent_article_id", generics, "article_id")


def _below_cost(t: Tables) -> DataFrame:
    costs = t["article_master"].select("article_id", "cost_price")
    return (_items(t).where(F.col("mechanic") == "fixed_price").join(costs, "article_id")
            .where(F.col("promo_price") < F.col("cost_price")))


def _outside_header(t: Tables) -> DataFrame:
    headers = t["promotion_header"].select("promo_id", "header_start", "header_end")
    return _items(t).join(headers, "promo_id").where(outside())


def _tobacco(t: Tables) -> DataFrame:
    tobacco = t["article_master"].where(F.col("merch_category") == "TOBACCO")
    return _items(t).join(tobacco.select("article_id"), "article_id", "left_semi")


def _packs(t: Tables) -> DataFrame:
    units = t["article_master"].select("article_id", "base_uom")
    return (_items(t).where(F.col("mechanic") == "multibuy").join(units, "article_id")
            .where(~F.col("base_uom").eqNullSafe("EA")))


VIOLATIONS = {
    "v01": lambda t: rules.dangling(_items(t).select("article_id"), "article_id",
                                    t["article_master"], "article_id"),
    "v02": lambda t: rules.dangling(_items(t).select("promo_id"), "promo_id",
                                    t["promotion_header"], "promo_id"),
    "v03": _orphan_variants,
    "v04": lambda t: t["article_master"].where(~barcode.is_valid(F.col("barcode"))),
    "v05": _below_cost,
    "v06": _outside_header,
    "v07": _unlisted,
    "v08": _tobacco,
    "v09": _packs,
    "v10": lambda t: t["article_master"].where(rules.any_null(REQUIRED)),
}


def assertion(tables: Tables, key: str) -> DataFrame:
    """One row: assertion, bad_count, status."""
    bad = VIOLATIONS[key](tables).agg(F.count(F.lit(1)).alias("bad_count"))
    return bad.select(F.lit(ASSERTIONS[key]).alias("assertion"), "bad_count",
                      F.when(F.col("bad_count") == 0, "OK").otherwise("FAIL").alias("status"))


def _judged(counts: dict[str, Column], rows: DataFrame) -> DataFrame:
    """One row per assertion from one aggregation of the rows."""
    one = rows.agg(*[F.count_if(bad).alias(key) for key, bad in counts.items()])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(ASSERTIONS[key]).alias("assertion"), F.col(key).alias("bad_count"))
        for key in counts])))


def assertions(tables: Tables) -> DataFrame:
    """All ten: the item table is read once, with its joins made once (keys must be unique)."""
    articles = tables["article_master"].select(
        "article_id", F.lit(True).alias("has_article"), "merch_category", "base_uom", "cost_price")
    headers = tables["promotion_header"].select(
        "promo_id", F.lit(True).alias("has_header"), "header_start", "header_end", "store_group")
    listed = tables["listing"].select("article_id", "store_group", F.lit(True).alias("is_listed"))
    items = (_items(tables).join(headers, "promo_id", "left").join(articles, "article_id", "left")
             .join(listed, ["article_id", "store_group"], "left"))
    col = F.col
    per_item = _judged({
        "v01": col("has_article").isNull(),
        "v02": col("has_header").isNull(),
        "v05": (col("mechanic") == "fixed_price") & (col("promo_price") < col("cost_price")),
        "v06": outside(),
        "v07": col("has_header").isNotNull() & col("is_listed").isNull(),
        "v08": col("merch_category") == "TOBACCO",
        "v09": (col("mechanic") == "multibuy") & col("has_article").isNotNull()
        & ~col("base_uom").eqNullSafe("EA"),
    }, items)
    per_article = _judged({"v04": ~barcode.is_valid(col("barcode")), "v10": rules.any_null(REQUIRED)},
                          tables["article_master"])
    orphans = _judged({"v03": F.lit(True)}, _orphan_variants(tables))
    return per_item.unionByName(per_article).unionByName(orphans).withColumn(
        "status", F.when(col("bad_count") == 0, "OK").otherwise("FAIL"))


def summary(results: DataFrame) -> DataFrame:
    """One row: number of assertions, number and names of the failed ones, overall status."""
    failed = F.when(F.col("status") == "FAIL", F.col("assertion"))
    return results.agg(
        F.count(F.lit(1)).alias("assertions"),
        F.count(failed).alias("failed"),
        # Ten names at most.
        F.array_join(F.array_sort(F.collect_list(failed)), "; ").alias("failed_names"),
        F.when(F.count(failed) == 0, "clean").otherwise("not clean").alias("status"))


class NotClean(AssertionError):
    pass


def require_clean(tables: Tables) -> None:
    """Raise if any assertion fails."""
    row = summary(assertions(tables)).first()
    if row.failed:
        raise NotClean(f"{row.failed} assertions failed: {row.failed_names}")


def key_uniqueness(tables: Tables) -> DataFrame:
    """Per table, the number of key values held by more than one row."""
    def repeated(name: str) -> DataFrame:
        return (tables[name].groupBy(PRIMARY_KEYS[name]).agg(F.count(F.lit(1)).alias("n"))
                .agg(F.count_if(F.col("n") > 1).alias("repeated_keys"))
                .select(F.lit(name).alias("table_name"), "repeated_keys"))
    return reduce(DataFrame.unionByName, [repeated(name) for name in tables])
