"""Derive the six tables from order and part tables by integer arithmetic on keys.

Two variants: with defects, and clean. The clean one holds what a valid baseline needs: no
null codes, right check digits, only active and promotable articles on promotions, prices
above cost, item dates inside the header's, status that follows from the dates, descriptions
that differ.
"""

from __future__ import annotations

from datetime import date
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfproof.functions import barcode, text
from shelfproof.operators import derive
from shelfproof.schema import TABLE_SCHEMAS, Tables

AS_OF = date(1998, 7, 1)
OPEN_END = date(2099, 12, 31)


def _ordered(df: DataFrame, table: str) -> DataFrame:
    return df.to(TABLE_SCHEMAS[table])


def _category() -> Column:
    by_type = {"ECONOMY": "TOBACCO", "STANDARD": "FUEL", "SMALL": "CONFECTIONERY",
               "LARGE": "FOOD_TO_GO"}
    out = F.lit("DRINKS_COLD")
    for kind, category in by_type.items():
        out = F.when(F.col("p_type") == kind, category).otherwise(out)
    return out


def _status(k: Column) -> Column:
    return F.when(k % 13 == 3, "discontinued").when(k % 17 == 4, "pending").otherwise("active")


def _uom(k: Column, clean: bool) -> Column:
    uom = (F.when(F.col("p_type") == "STANDARD", "L")
           .when(k % 10 == 3, "PACK").when(k % 10 == 4, "CTN").otherwise("EA"))
    return uom if clean else F.when(k % 41 != 5, uom)


def article_master(part: DataFrame, clean: bool = False) -> DataFrame:
    k = F.col("p_partkey")
    digit = barcode.number_check_digit(93, k)
    if not clean:
        digit = F.when(k % 20 == 7, (digit + 1) % 10).otherwise(digit)
    tax = F.when(F.col("p_type") == "LARGE", "GST_FREE").otherwise("GST")
    tobacco = F.col("p_type") == "ECONOMY"
    parent = F.when((k % 10).isin(1, 2), text.padded("ART", k - k % 10, 8))
    created = F.date_add(F.lit(date(1992, 1, 1)), (k % 1000).cast("int"))
    words = ["p_name", "p_type", F.col("p_size").cast("string")]
    if clean:  # a code that tells descriptions apart
        words.append(F.substring(F.md5(k.cast("string").cast("binary")), 1, 16))
    out = part.select(
        text.padded("ART", k, 8).alias("article_id"),
        F.concat_ws(" ", *words).alias("article_description"),
        F.when(k % 10 == 0, "generic").when((k % 10).isin(1, 2), "variant")
        .when(k % 10 == 3, "prepack").when(k % 10 == 4, "display").otherwise("single")
        .alias("article_type"),
        parent.alias("parent_article_id"),
        _category().alias("merch_category"),
        F.col("p_brand").alias("sub_category"),
        _uom(k, clean).alias("base_uom"),
        barcode.numbered(93, k, digit).alias("barcode"),
        (tax if clean else F.when(k % 43 != 6, tax)).alias("tax_code"),
        F.col("p_retailprice").alias("list_price"),
        (F.col("p_retailprice") * F.lit(0.7)).alias("cost_price"),
        F.when(tobacco, F.col("p_retailprice") * F.lit(0.93)).alias("tobacco_floor_price"),
        _status(k).alias("status"),
        F.when(k % 13 == 3, F.date_add(F.lit(date(1995, 1, 1)), (k * 37 % 2400).cast("int")))
        .alias("discontinued_date"),
        created.alias("created_date"),
        F.date_add(created, (k % 365).cast("int")).alias("last_modified_date"))
    if clean:
        generics = part.where(F.col("p_partkey") % 10 == 0).select(
            text.padded("ART", F.col("p_partkey"), 8).alias("known_parent"))
        out = (out.join(generics, F.col("parent_article_id") == F.col("known_parent"), "left")
               .withColumn("parent_article_id", F.col("known_parent")))
    return _ordered(out, "article_master")


def _keyed_headers(orders: DataFrame, customer: DataFrame, clean: bool) -> DataFrame:
    """Headers with the number of their order, which is narrower than their id in joins."""
    o = F.col("o_orderkey")
    weeks = (F.when(o % 100 < 70, 1).when(o % 100 < 90, 2).when(o % 100 < 96, 3).otherwise(4))
    status = derive.lifecycle_status(F.col("header_start"), F.col("header_end"), AS_OF, o % 5 < 2)
    if not clean:
        status = (F.when(o % 23 == 1, F.lit(None)).when(o % 29 == 2, "cancelled")
                  .when(o % 31 == 3, "live").otherwise(status))
    out = derive.promotion_weeks(
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey")), "o_orderdate", weeks)
    out = (
        out.select(
            "o_orderkey", text.padded("PRM", o, 8).alias("promo_id"),
            F.concat_ws(" ", F.col("o_orderpriority"),
                        F.year("header_start").cast("string")).alias("promo_theme"),
            "header_start", "header_end",
            text.padded("SG_", F.col("c_nationkey"), 2).alias("store_group"),
            status.alias("approval_status"),
            F.col("c_name").alias("created_by"),
            F.date_sub("header_start", (o % 31).cast("int")).alias("created_date")))
    return out


def promotion_header(orders: DataFrame, customer: DataFrame, clean: bool = False) -> DataFrame:
    return _ordered(_keyed_headers(orders, customer, clean), "promotion_header")


def _lines(lineitem: DataFrame, part: DataFrame, header: DataFrame) -> DataFrame:
    """Every line with its part and header."""
    lines = lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"),
                            "l_suppkey", F.col("l_quantity").cast("long").alias("quantity"))
    headers = header.select(F.col("o_orderkey").alias("l_orderkey"), "header_start", "header_end")
    return lines.join(part.select("p_partkey", "p_type", "p_retailprice"), "p_partkey") \
        .join(headers, "l_orderkey").withColumn("promo_id", text.padded("PRM", F.col("l_orderkey"), 8))


def promotion_item(lines: DataFrame, clean: bool = False) -> DataFrame:
    k, o, n = F.col("p_partkey"), F.col("l_orderkey"), F.col("l_linenumber")
    s = o + n
    mechanic = (F.when(n % 4 == 0, "fixed_price").when(n % 4 == 1, "percent_off")
                .when(n % 4 == 2, "dollar_off").otherwise("multibuy"))
    factor = F.lit(0.9)
    article = text.padded("ART", k, 8)
    end = F.col("header_end")
    if clean:
        lines = lines.where((_status(k) == "active") & (F.col("p_type") != "ECONOMY"))
        mechanic = F.when((n % 4 == 3) & (_uom(k, True) != "EA"), "fixed_price").otherwise(mechanic)
    else:
        factor = F.when(s % 19 == 0, F.lit(0.5)).otherwise(factor)
        article = F.when(s % 50 == 0, F.concat(F.lit("ARTFAKE"), k.cast("string"))) \
                   .otherwise(article)
        end = F.when((o * 7 + n) % 17 == 0, F.date_add(end, n + 2)).otherwise(end)
    priced = F.col("mechanic").isin("fixed_price", "multibuy")
    out = lines.withColumn("mechanic", mechanic).select(
        F.concat_ws("_", text.padded("PIT", o, 8), n, k, "l_suppkey", "quantity").alias("promo_item_id"),
        "promo_id",
        article.alias("article_id"),
        "mechanic",
        F.when(priced, F.col("p_retailprice") * factor).alias("promo_price"),
        F.when(F.col("mechanic") == "percent_off", (10 + 5 * (s % 4)).cast("double"))
        .when(F.col("mechanic") == "dollar_off", F.lit(0.5) + F.lit(0.25) * (s % 8))
        .alias("discount_value"),
        F.when(F.col("mechanic") == "multibuy", 2 + s % 2).alias("multibuy_qty"),
        F.col("header_start").alias("item_start"),
        end.alias("item_end"))
    return _ordered(out, "promotion_item")


def listing(lineitem: DataFrame, part: DataFrame, header: DataFrame, clean: bool = False) -> DataFrame:
    """Pairs of group and article that a line has; the groups of a part are one row when they meet it."""
    k, o = F.col("p_partkey"), F.col("l_orderkey")
    if clean:
        kept = _status(k) != "discontinued"
    else:  # lines whose item points at an unknown article list nothing
        kept = (((k + o) % 20 != 0) | (k % 3 != 0)) & ((o + F.col("l_linenumber")) % 50 != 0)
    lines = lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    group = F.struct("store_group")  # a null group is a group, too
    pairs = (lines.where(kept).select("l_orderkey", "p_partkey")
             .join(header.select(F.col("o_orderkey").alias("l_orderkey"), "store_group"), "l_orderkey")
             .where(k.isNotNull()).groupBy("p_partkey").agg(F.collect_set(group).alias("groups")))
    out = pairs.join(part.select("p_partkey"), "p_partkey", "left_semi") \
        .select("p_partkey", F.inline("groups")).select(
            "store_group",
            text.padded("ART", k, 8).alias("article_id"),
            F.date_add(F.lit(date(1994, 1, 1)), (k % 300).cast("int")).alias("valid_from"),
            F.lit(OPEN_END).alias("valid_to"))
    return _ordered(out, "listing")


def tables_from(spark: SparkSession, folder: str, clean: bool = False) -> Tables:
    """The six tables, each built only when asked for."""
    @cache
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    @cache
    def headers() -> DataFrame:
        return _keyed_headers(read("orders"), read("customer"), clean)

    tables = Tables({
        "article_master": lambda: article_master(read("part"), clean),
        "promotion_header": lambda: _ordered(headers(), "promotion_header"),
        "promotion_item": lambda: promotion_item(
            _lines(read("lineitem"), read("part"), headers()), clean),
        "listing": lambda: listing(read("lineitem"), read("part"), headers(), clean),
        "article_site": lambda: derive.article_site(
            tables["listing"], tables["article_master"]),
        "change_log": lambda: derive.change_log(
            tables["article_master"], tables["promotion_header"]),
    })
    return tables
