"""Seeded defects in one pass: every record has one hash, every defect a band of its values.

Bands of a table are disjoint, so an article, a header or an item gets one defect at most, and what
happens to a record is a column of its own row: nothing is ordered, counted, checkpointed or asked
of an earlier decision. `inject.inject` takes samples of an exact size instead, one after the other.

The rate is a share of the records of the table that is changed: of items, headers and pairs of
the listing, and of articles where the article is changed. A record in a band that cannot have the
defect (no item of the article is a multibuy, say) stays as it is, so a band gives its rate
of the eligible records in expectation. Delisted pairs may hit an item that has a defect of its own.

Records with a null key are in no band. Rows that repeat a key get the same defect. Further columns
of the tables are dropped, as by `inject.inject`.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfproof.functions import barcode, text
from shelfproof.operators.inject import COPY_SUFFIXES, RATES, SEED
from shelfproof.schema import (
    REFERENCE_DATE,
    TABLE_SCHEMAS,
    TRUTH_IMPACT,
    TRUTH_SCHEMA,
    TRUTH_SEVERITY,
    Tables,
)
from shelfproof.session import written

BANDS = {
    "promotion_item": ("referential_integrity", "header_item_date_mismatch", "margin_breach"),
    "listing": ("listing_conflict",),
    "article_master": ("referential_timing", "uom_pack_mismatch", "tobacco_floor_breach",
                       "barcode_invalidity", "duplicate_near_duplicate", "completeness"),
    "promotion_header": ("orphaned_cancelled_header", "completeness_header", "stale_status"),
}


def edges(table: str) -> list[tuple[str, int, int]]:
    """Defect, first and last + 1 of its band, among 16^7 values."""
    out, low = [], 0.0
    for name in BANDS[table]:
        out.append((name, round(low * 16 ** 7), round((low + RATES[name]) * 16 ** 7)))
        low += RATES[name]
    return out


def _band(seed: int, table: str, *keys: str) -> tuple[Column, Column]:
    """The defect whose band a record is in, or null, and a number to draw values from."""
    h = text.keyed_hash(seed, f"{table}-band", *[F.col(k) for k in keys])
    at, band = text.hash_slice(h, 1), F.lit(None).cast("string")
    for name, low, high in edges(table):
        band = F.when((at >= low) & (at < high), name).otherwise(band)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return F.when(known, band), text.hash_slice(h, 9)


def _only(name: str, holds: Column, value: Column) -> Column:
    return F.when((F.col("band") == name) & holds, value)


def _entry(kind: str, holds: Column, table: str, key: str, changed: str | Column, old: Column,
           new: Column, source: str | None = None) -> tuple[str, Column]:
    """The kind, and a log row of the record if it has the defect."""
    lit, record = F.lit, F.col(key)
    number = F.substring(F.md5(F.concat_ws(":", lit(kind), record, F.col(source or key))), 1, 16)
    values = (F.concat(lit("GT"), number), lit(table), record, lit(kind), lit(TRUTH_SEVERITY[kind]),
              lit(TRUTH_IMPACT[kind]), lit(changed) if isinstance(changed, str) else changed,
              old.cast("string"), new.cast("string"))
    return kind, F.when(holds, F.struct(*[v.alias(n) for v, n in zip(values, TRUTH_SCHEMA.names)]))


def _logged(rows: DataFrame, *entries: tuple[str, Column]) -> DataFrame:
    """The entries that are there. Who asks for other kinds only is spared the rows by the optimizer."""
    # One comparison a kind: the optimizer sees what contradicts them, as it does not with a list.
    known = reduce(Column.__or__, [F.col("error_type") == kind for kind, _ in entries])
    return rows.select(F.inline(F.filter(F.array(*[e for _, e in entries]), lambda e: e.isNotNull()))).where(known)


def _repeats(df: DataFrame, key: str, name: str) -> DataFrame:
    """Keys that several rows have, with their number. Few, if any, so they are written to be small."""
    return written(df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1))


@dataclass
class Banded:
    """Clean tables with what happens to each record."""

    clean: Tables
    seed: int = SEED
    as_of: date = REFERENCE_DATE

    def _moved(self) -> DataFrame:
        """Items with band, draw and new_article, which take no other table."""
        band, draw = _band(self.seed, "promotion_item", "promo_item_id")
        fake = F.concat(F.lit("ARTFAKE_"), "promo_item_id")
        return self.clean["promotion_item"].withColumns({"band": band, "draw": draw}) \
            .withColumn("new_article", _only("referential_integrity", F.lit(True), fake))

    def _delisted(self) -> DataFrame:
        """Pairs to delist: those of the listing's band that an item of a known article uses."""
        t = self.clean
        pair, _ = _band(self.seed, "listing", "article_id", "store_group")
        return (self._moved().where(F.col("new_article").isNull()).select("promo_id", "article_id")
                .join(t["promotion_header"].select("promo_id", "store_group"), "promo_id")
                .where(pair.isNotNull()).select("article_id", "store_group")
                .join(t["article_master"].select("article_id"), "article_id", "left_semi"))

    def changed_items(self, rows: DataFrame | None = None) -> DataFrame:
        """Items, or these of `_moved`, with new_article, new_end and new_price (null: unchanged)."""
        t, col = self.clean, F.col
        headers = t["promotion_header"].select("promo_id", "store_group", "header_end")
        articles = t["article_master"].select("article_id", "cost_price", F.lit(True).alias("has_article"))
        factor = 0.6 + 0.3 * (col("draw").cast("double") / float(16 ** 7))
        priced = col("mechanic").isin("fixed_price", "multibuy") & col("cost_price").isNotNull()
        late = F.date_add("header_end", (2 + col("draw") % 8).cast("int"))
        rows = self._moved() if rows is None else rows
        return (rows.join(headers, "promo_id", "left").join(articles, "article_id", "left")
                .withColumns({
                    "new_end": _only("header_item_date_mismatch", col("header_end").isNotNull(), late),
                    "new_price": _only("margin_breach", priced, F.round(col("cost_price") * factor, 2))}))

    def new_items(self) -> DataFrame:
        """The items as changed. Only those in a band that asks header or article meet them.

        The others come as often as they would in a join, should keys be repeated there.
        """
        col, t = F.col, self.clean
        asks = F.coalesce(col("band").isin("header_item_date_mismatch", "margin_breach"), F.lit(False))
        changed = self.changed_items(self._moved().where(asks)).withColumns({
            "article_id": F.coalesce("new_article", "article_id"),
            "item_end": F.coalesce("new_end", "item_end"),
            "promo_price": F.coalesce("new_price", "promo_price")})
        times = F.coalesce("_headers", F.lit(1)) * F.coalesce("_articles", F.lit(1))
        names = TABLE_SCHEMAS["promotion_item"].names
        others = (self._moved().where(~asks)
                  .join(_repeats(t["promotion_header"], "promo_id", "_headers"), "promo_id", "left")
                  .join(_repeats(t["article_master"], "article_id", "_articles"), "article_id", "left")
                  .withColumn("_time", F.explode(F.sequence(F.lit(1), times)))
                  .withColumn("article_id", F.coalesce("new_article", "article_id")))
        return changed.select(names).unionByName(others.select(names))

    def items(self) -> DataFrame:
        """`changed_items` with delisted."""
        col = F.col
        listed = self.clean["listing"].select("article_id", "store_group", F.lit(True).alias("is_listed"))
        pair, _ = _band(self.seed, "listing", "article_id", "store_group")
        return (self.changed_items().join(listed, ["article_id", "store_group"], "left")
                .withColumn("pair", pair)
                .withColumn("delisted", col("pair").isNotNull() & col("is_listed").isNotNull()
                            & col("has_article").isNotNull() & col("new_article").isNull()))

    def articles(self) -> DataFrame:
        """Articles with new_date, new_uom, new_barcode, nulled (null: unchanged) and copied."""
        col = F.col
        uses = (self._moved().where(col("new_article").isNull()).groupBy("article_id").agg(
            F.min("item_start").alias("first_start"), F.max(col("mechanic") == "multibuy").alias("packed")))
        band, draw = _band(self.seed, "article_master", "article_id")
        even, code = col("draw") % 2 == 0, col("barcode")
        # A digit that is neither the present one nor, where that is wrong, the right one.
        present = F.ascii(F.substring(code, 13, 1)) - ord("0")
        gap = (barcode.check_digit(code) - present + 10) % 10
        step = 1 + col("draw") % F.when(gap == 0, 9).otherwise(8)
        step = F.when((gap > 0) & (step >= gap), step + 1).otherwise(step)
        wrong = F.concat(F.substring(code, 1, 12), ((present + step) % 10).cast("string"))
        field = F.when(even, "base_uom").otherwise("tax_code")
        return (self.clean["article_master"].join(uses, "article_id", "left")
                .withColumns({"band": band, "draw": draw})
                .withColumns({
                    "new_date": _only("referential_timing", F.lit(True),
                                      F.date_sub("first_start", (5 + col("draw") % 55).cast("int"))),
                    "new_uom": _only("uom_pack_mismatch", col("packed"),
                                     F.when(even, "CTN").otherwise("PACK")),
                    "new_barcode": _only("barcode_invalidity", code.rlike("^[0-9]{13}$"), wrong),
                    "nulled": _only("completeness", F.when(even, col("base_uom")).otherwise(
                        col("tax_code")).isNotNull(), field),
                    "copied": F.coalesce(col("band") == "duplicate_near_duplicate", F.lit(False))}))

    def headers(self) -> DataFrame:
        """Headers with the defect that changes their status, or null."""
        col, today = F.col, F.lit(self.as_of)
        ends = self.clean["promotion_item"].groupBy("promo_id").agg(F.max("item_end").alias("last_end"))
        band, _ = _band(self.seed, "promotion_header", "promo_id")
        status = col("approval_status")
        return (self.clean["promotion_header"].join(ends, "promo_id", "left").withColumn("band", band)
                .withColumn("defect", F.coalesce(
                    _only("orphaned_cancelled_header", status.isin("live", "approved")
                          & (col("last_end") >= today), col("band")),
                    _only("completeness_header", status.isNotNull(), col("band")),
                    _only("stale_status", (col("header_end") < today) & ~status.eqNullSafe("live"),
                          col("band")))))

    def added(self) -> DataFrame:
        """Items below the price floor, one per tobacco article, in a group that lists the article."""
        col, t = F.col, self.clean
        band, draw = _band(self.seed, "article_master", "article_id")
        pair, _ = _band(self.seed, "listing", "article_id", "store_group")
        picked = (t["article_master"].withColumns({"band": band, "draw": draw})
                  .where((col("band") == "tobacco_floor_breach") & (col("merch_category") == "TOBACCO")
                         & (col("status") == "active") & col("tobacco_floor_price").isNotNull())
                  .select("article_id", "cost_price", "tobacco_floor_price", "draw"))
        first = t["promotion_header"].groupBy("store_group").agg(F.min_by(
            F.struct("promo_id", "header_start", "header_end"), "promo_id").alias("header"))
        group = (t["listing"].where(pair.isNull()).join(picked.select("article_id"), "article_id", "left_semi")
                 .join(first.select("store_group"), "store_group", "left_semi")
                 .groupBy("article_id").agg(F.min("store_group").alias("store_group")))
        low, high = col("cost_price") * 1.02, col("tobacco_floor_price") * 0.97
        low = F.when(low >= high, col("tobacco_floor_price") * 0.90).otherwise(low)
        unit = col("draw").cast("double") / float(16 ** 7)
        return (picked.join(group, "article_id").join(first, "store_group")
                .withColumn("promo_price", F.round(low + (high - low) * unit, 2))
                .select(F.concat(F.lit("PITTOB_"), "article_id").alias("promo_item_id"), "article_id",
                        "header.promo_id", "tobacco_floor_price", "promo_price",
                        col("header.header_start").alias("item_start"),
                        col("header.header_end").alias("item_end")))

    def tables(self) -> Tables:
        """The corrupted tables. Site and change-log rows stay as they are."""
        col = F.col
        articles = self.articles()
        hit = F.coalesce(col("nulled"), F.lit(""))
        changed = articles.withColumns({
            "status": F.when(col("new_date").isNotNull(), "discontinued").otherwise(col("status")),
            "discontinued_date": F.coalesce("new_date", "discontinued_date"),
            "base_uom": F.when(hit != "base_uom", F.coalesce("new_uom", "base_uom")),
            "tax_code": F.when(hit != "tax_code", col("tax_code")),
            "barcode": F.coalesce("new_barcode", "barcode")})
        # A copy is a second row of its article, made in the same pass.
        suffix = F.element_at(F.array(*[F.lit(s) for s in COPY_SUFFIXES]), (col("draw") % 4 + 1).cast("int"))
        today = F.lit(self.as_of)
        doubled = changed.withColumn("is_copy", F.explode(F.when(
            col("copied"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))

        def copy(name: str, value: Column) -> Column:
            return F.when(col("is_copy"), value).otherwise(col(name))

        doubled = doubled.withColumns({
            "article_description": copy("article_description", F.concat("article_description", suffix)),
            "article_id": copy("article_id", F.concat(F.lit("ARTDUP_"), "article_id")),
            "created_date": copy("created_date", today),
            "last_modified_date": copy("last_modified_date", today)})
        names = {name: TABLE_SCHEMAS[name].names for name in BANDS}
        more = self.added().withColumns({
            "mechanic": F.lit("fixed_price"), "discount_value": F.lit(None).cast("double"),
            "multibuy_qty": F.lit(None).cast("int")})
        status = (F.when(col("defect") == "orphaned_cancelled_header", "cancelled")
                  .when(col("defect") == "stale_status", "live")
                  .when(col("defect").isNull(), col("approval_status")))
        listing = self.clean["listing"]
        pair, _ = _band(self.seed, "listing", "article_id", "store_group")
        # Only pairs of the band are looked up.
        left = listing.where(pair.isNull()).unionByName(listing.where(pair.isNotNull()).join(
            self._delisted(), ["article_id", "store_group"], "left_anti"))
        return self.clean.replace(
            article_master=doubled.select(names["article_master"]),
            promotion_item=self.new_items().unionByName(more.select(names["promotion_item"])),
            promotion_header=self.headers().withColumn("approval_status", status)
            .select(names["promotion_header"]),
            listing=left.select(names["listing"]))

    def log(self) -> DataFrame:
        """Truth rows: each table's in one scan of it."""
        col, lit, none = F.col, F.lit, F.lit(None)
        item, article, header = "promotion_item", "article_master", "promotion_header"

        def changes(name: str) -> Column:
            return col(name).isNotNull()

        items = _logged(
            self.items(),
            _entry("referential_integrity", changes("new_article"), item, "promo_item_id", "article_id",
                   col("article_id"), col("new_article")),
            _entry("listing_conflict", col("delisted"), item, "promo_item_id", "listing_row",
                   lit("listed"), lit("removed (delisted)")),
            _entry("header_item_date_mismatch", changes("new_end"), item, "promo_item_id", "item_end",
                   col("item_end"), col("new_end")),
            _entry("margin_breach", changes("new_price"), item, "promo_item_id", "promo_price",
                   text.money(col("promo_price")), text.money(col("new_price"))))
        added = _logged(self.added(), _entry(
            "tobacco_floor_breach", lit(True), item, "promo_item_id", "promo_price",
            F.concat(lit("floor="), text.money(col("tobacco_floor_price"))),
            text.money(col("promo_price"))))
        old = F.when(col("nulled") == "base_uom", col("base_uom")).otherwise(col("tax_code"))
        articles = _logged(
            self.articles().withColumn("copy_id", F.concat(lit("ARTDUP_"), "article_id")),
            _entry("referential_timing", changes("new_date"), article, "article_id", "status",
                   col("status"), lit("discontinued (after promo item_start)")),
            _entry("uom_pack_mismatch", changes("new_uom"), article, "article_id", "base_uom",
                   col("base_uom"), col("new_uom")),
            _entry("barcode_invalidity", changes("new_barcode"), article, "article_id", "barcode",
                   col("barcode"), col("new_barcode")),
            _entry("duplicate_near_duplicate", col("copied"), article, "copy_id", "article_id",
                   col("article_id"), col("copy_id")),
            _entry("completeness", changes("nulled"), article, "article_id", col("nulled"), old, none))
        status = col("approval_status")
        headers = _logged(self.headers(), *[
            _entry(kind, col("defect") == name, header, "promo_id", "approval_status", status, new)
            for kind, name, new in (
                ("orphaned_cancelled_header", "orphaned_cancelled_header",
                 lit("cancelled (items still active)")),
                ("completeness", "completeness_header", none), ("stale_status", "stale_status", lit("live")))])
        return reduce(DataFrame.unionByName, [items, added, articles, headers])


def inject(clean: Tables, seed: int = SEED, as_of: date = REFERENCE_DATE) -> tuple[Tables, DataFrame]:
    """Corrupted tables and truth log."""
    x = Banded(clean, seed, as_of)
    return x.tables(), x.log()
