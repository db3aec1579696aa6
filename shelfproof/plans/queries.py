"""Registered queries: name -> function of (spark, folder of the driver tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfproof.functions import barcode, similarity, text
from shelfproof.operators import (
    bands,
    derive,
    fused,
    gate,
    inject,
    near_duplicates,
    rules,
    score,
    triage,
    verify,
)
from shelfproof.schema import EXCEPTION_SCHEMA, TABLE_SCHEMAS, Tables
from shelfproof.session import shared_folder, written
from shelfproof.sources import adapter, runs, tables as sources

AS_OF = adapter.AS_OF
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return add


def _dirty(spark: SparkSession, folder: str) -> Tables:
    return adapter.tables_from(spark, folder)


def _clean(spark: SparkSession, folder: str) -> Tables:
    return adapter.tables_from(spark, folder, clean=True)


# The injection run is a job of its own: it writes its input and samples once per application
# and the queries on its results read those. Each table is written when a query first needs it.
_INJECTIONS: dict[tuple[str, str], inject.Injection] = {}
_CORRUPTED: dict[tuple[str, str], Tables] = {}
_STAGED = ("article_master", "promotion_header", "promotion_item", "listing")


def _injection(spark: SparkSession, folder: str) -> inject.Injection:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _INJECTIONS:
        clean = sources.stage_when_asked(_clean(spark, folder), _STAGED)
        _INJECTIONS[key] = inject.Injection(clean, as_of=AS_OF)
    return _INJECTIONS[key]


def _corrupted(spark: SparkSession, folder: str) -> Tables:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _CORRUPTED:
        x = _injection(spark, folder)
        dirty = x.clean.replace(
            article_master=lambda: inject.corrupted_articles(x),
            listing=lambda: inject.corrupted_listing(x),
            promotion_item=lambda: inject.corrupted_items(x),
            promotion_header=lambda: inject.corrupted_headers(x))
        _CORRUPTED[key] = sources.stage_when_asked(dirty, _STAGED)
    return _CORRUPTED[key]


def _truth(spark: SparkSession, folder: str) -> DataFrame:
    return inject.truth_log(_injection(spark, folder))


# ---- the twelve rules and the worklist --------------------------------------------------

def _rule(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return rules.run_rule(name, _dirty(spark, folder), AS_OF)


for _number, _name in enumerate([
        "referential_integrity", "referential_timing", "listing_conflict",
        "header_item_date_mismatch", "orphaned_cancelled_header", "uom_pack_mismatch",
        "tobacco_on_promotion", "margin_breach", "barcode_invalidity",
        "duplicate_near_duplicate", "completeness", "stale_status"], start=1):
    QUERIES[f"c{_number:02d}_{_name}"] = partial(_rule, name=_name)


@query("c03_listing_conflict_in_window")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rules.listing_conflict(_dirty(spark, folder), AS_OF, within_window=True)


@query("c08_margin_breach_per_unit")
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Keys only: the engines round unit prices that end in half a cent differently.
    found = rules.margin_breach(_dirty(spark, folder), AS_OF, per_unit=True, all_mechanics=True)
    return found.select("record_id")


@query("c10_match_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    articles = _dirty(spark, folder)["article_master"]
    return near_duplicates.match_counts(articles).select(
        "record_id", "first_match", F.round("score", 6).alias("score"), "matches")


def _worklist(spark: SparkSession, folder: str) -> DataFrame:
    return fused.worklist(_dirty(spark, folder), AS_OF)


QUERIES["e02_worklist"] = _worklist


@query("e02_worklist_by_rule")
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Thirteen plans read the tables: each is built once.
    return rules.run(sources.stage(_dirty(spark, folder), _STAGED), AS_OF)


@query("e03_worklist_store_group")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _worklist(spark, folder)


@query("e04_rule_facts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    from shelfproof.schema import rule_dimension

    facts = F.broadcast(rule_dimension(spark))  # twelve rows
    return (_worklist(spark, folder).groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))
            .join(facts, "error_type")
            .select("error_type", "severity", "check", "downstream_impact", "n"))


@query("e08_totals")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rules.totals(_worklist(spark, folder))


# ---- baseline gate ----------------------------------------------------------------------

def _assertion(spark: SparkSession, folder: str, key: str) -> DataFrame:
    return gate.assertion(_dirty(spark, folder), key)


for _key, _label in {
        "v01": "item_article_exists", "v02": "item_header_exists", "v03": "variant_parent_exists",
        "v04": "barcode_valid", "v05": "fixed_price_above_cost", "v06": "item_in_header_window",
        "v07": "promoted_is_listed", "v08": "no_tobacco_items", "v09": "multibuy_on_each",
        "v10": "required_populated"}.items():
    QUERIES[f"{_key}_{_label}"] = partial(_assertion, key=_key)


@query("v11_gate_summary")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return gate.summary(gate.assertions(_dirty(spark, folder)))


@query("v11_gate_summary_clean")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return gate.summary(gate.assertions(_clean(spark, folder)))


@query("v12_key_uniqueness")
def _(spark: SparkSession, folder: str) -> DataFrame:
    t = _dirty(spark, folder)
    return gate.key_uniqueness(Tables({name: t[name] for name in TABLE_SCHEMAS}))


# ---- injected defects -------------------------------------------------------------------

def _log(spark: SparkSession, folder: str, names: tuple[str, ...]) -> DataFrame:
    x = _injection(spark, folder)
    out = inject.log_of(x, names[0])
    for name in names[1:]:
        out = out.unionByName(inject.log_of(x, name))
    return out


for _number, _names in enumerate([
        ("referential_integrity",), ("referential_timing",), ("listing_conflict",),
        ("header_item_date_mismatch",), ("orphaned_cancelled_header",), ("uom_pack_mismatch",),
        ("tobacco_floor_breach",), ("margin_breach",), ("barcode_invalidity",),
        ("duplicate_near_duplicate",), ("completeness", "completeness_header"),
        ("stale_status",)], start=1):
    QUERIES[f"j{_number:02d}_{_names[0]}"] = partial(_log, names=_names)


def _corrupted_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _corrupted(spark, folder)[name]


for _name in _STAGED:
    QUERIES[f"j13_corrupted_{_name}"] = partial(_corrupted_table, name=_name)


@query("j00_banded_log")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return bands.Banded(sources.stage(_clean(spark, folder), _STAGED), as_of=AS_OF).log()


@query("j00_banded_defects")
def _(spark: SparkSession, folder: str) -> DataFrame:
    clean = sources.stage(_clean(spark, folder), _STAGED)
    dirty, log = bands.inject(clean, as_of=AS_OF)
    return verify.actual_defects(sources.stage(dirty, _STAGED), log, AS_OF).distinct()


@query("k_log_check")
def _(spark: SparkSession, folder: str) -> DataFrame:
    dirty, log = _corrupted(spark, folder), _truth(spark, folder)
    return verify.log_check(dirty, log, AS_OF)


@query("k_actual_defects")
def _(spark: SparkSession, folder: str) -> DataFrame:
    dirty, log = _corrupted(spark, folder), _truth(spark, folder)
    return verify.actual_defects(dirty, log, AS_OF).distinct()


@query("k07_tobacco_floor")
def _(spark: SparkSession, folder: str) -> DataFrame:
    t = _dirty(spark, folder)
    none = spark.createDataFrame([], "record_id string, error_type string")
    return (verify.actual_defects(t, none, AS_OF)
            .where(F.col("error_type") == "tobacco_floor_breach").distinct())


@query("k13_log_size")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return verify.log_size(_truth(spark, folder))


def _scorecard(spark: SparkSession, folder: str) -> DataFrame:
    dirty, log = _corrupted(spark, folder), _truth(spark, folder)
    return score.scorecard(fused.worklist(dirty, AS_OF, units=True), dirty["promotion_item"], log)


QUERIES["r_scorecard"] = _scorecard


@query("r_overall")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rates = ["precision", "recall", "f1"]
    return score.overall(_scorecard(spark, folder)).select(
        "TP", "FP", "FN", *[F.round(c, 9).alias(c) for c in rates])


# ---- derived tables ---------------------------------------------------------------------

def _order_weeks(spark: SparkSession, folder: str) -> DataFrame:
    o = F.col("o_orderkey")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return derive.promotion_weeks(orders, "o_orderdate", o % 4 + 1)


@query("b01_next_thursday")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _order_weeks(spark, folder).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_day"),
        F.col("header_start").alias("thursday"))


@query("b02_promotion_weeks")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _order_weeks(spark, folder).select(
        "o_orderkey", "header_start", "header_end",
        (F.datediff("header_end", "header_start") + 1).alias("days"),
        F.weekday("header_end").alias("last_weekday"))


@query("b03_lifecycle_status")
def _(spark: SparkSession, folder: str) -> DataFrame:
    status = derive.lifecycle_status(F.col("header_start"), F.col("header_end"), AS_OF,
                                     F.col("o_orderkey") % 5 < 2)
    return _order_weeks(spark, folder).select("o_orderkey", status.alias("status"))


@query("b04_promotable_pool")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return derive.promotable(_dirty(spark, folder)["article_master"]) \
        .select("article_id", "merch_category")


def _derive_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = _dirty(spark, folder)
    return t["promotion_header"], t["article_master"], t["listing"]


@query("b05_eligible_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return derive.eligible_counts(*_derive_inputs(spark, folder))


@query("b06_picked_articles")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return derive.pick_articles(*_derive_inputs(spark, folder)) \
        .select("promo_id", "store_group", "article_id", "slot")


@query("b07_priced_items")
def _(spark: SparkSession, folder: str) -> DataFrame:
    headers, articles, listing = _derive_inputs(spark, folder)
    picks = derive.pick_articles(headers, articles, listing)
    return derive.price_items(picks, articles).select(
        "promo_id", "article_id", "mechanic", "promo_price", "discount_value", "multibuy_qty",
        F.round("effective_unit_price", 6).alias("effective_unit_price"))


@query("b08_item_windows")
def _(spark: SparkSession, folder: str) -> DataFrame:
    picks = derive.pick_articles(*_derive_inputs(spark, folder))
    return derive.item_windows(picks).select(
        "promo_id", "article_id", "header_start", "item_start", "item_end")


@query("b08_promotion_items")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return derive.promotion_items(*_derive_inputs(spark, folder)).select(
        "promo_item_id", "promo_id", "article_id", "item_start", "item_end")


@query("b09_listing")
def _(spark: SparkSession, folder: str) -> DataFrame:
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    groups = nation.select(text.padded("SG_", F.col("n_nationkey"), 2).alias("store_group"),
                           F.col("n_nationkey").cast("long").alias("ordinal"))
    return derive.listing(_dirty(spark, folder)["article_master"], groups,
                          date(1993, 1, 1), 900)


@query("b10_article_site")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _dirty(spark, folder)["article_site"]


@query("b11_change_log")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _dirty(spark, folder)["change_log"]


@query("b12_minted_ids")
def _(spark: SparkSession, folder: str) -> DataFrame:
    customer = spark.read.parquet(f"{folder}/customer.parquet").select("c_name")
    return derive.mint_ids(customer, "c_name", "ART", 5, "article_id")


@query("b13_minted_barcodes")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey")
    return derive.mint_barcodes(orders, "o_orderkey")


@query("b14_variants")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return derive.variants(_dirty(spark, folder)["article_master"],
                           {"DRINKS_COLD": ["375ml", "600ml", "1.25L"]})


# ---- triage -----------------------------------------------------------------------------

@query("d01_records_scanned")
def _(spark: SparkSession, folder: str) -> DataFrame:
    t = _dirty(spark, folder)
    return triage.records_scanned(t["article_master"], t["promotion_item"])


@query("d02_headline")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.headline(_worklist(spark, folder))


@query("d03_detection_rates")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.detection_rates(_scorecard(spark, folder)).select(
        F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query("d04_severity_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.severity_counts(_worklist(spark, folder))


@query("d05_type_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.type_counts(_worklist(spark, folder))


@query("d06_group_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.group_counts(_worklist(spark, folder))


@query("d07_group_summary")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.group_summary(_worklist(spark, folder))


@query("d08_worst_groups")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.worst_groups(_worklist(spark, folder))


FILTER = {"severities": ("Critical", "High"),
          "checks": ("Tobacco on promotion", "Priced below cost", "Invalid barcode"),
          "groups": ("SG_03", "SG_07", "SG_11")}


@query("d09_filtered")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.filtered(_worklist(spark, folder), **FILTER)


@query("d10_in_order")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.in_order(triage.filtered(_worklist(spark, folder)))


@query("d11_worklist_view")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.worklist_view(triage.filtered(_worklist(spark, folder)))


@query("d11_shown_of_total")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.shown_of_total(_worklist(spark, folder), **FILTER)


@query("d12_scorecard_view")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.scorecard_view(_scorecard(spark, folder))


@query("d13_filter_options")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.filter_options(_worklist(spark, folder))


@query("d14_bar_widths")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.bar_widths(triage.severity_counts(_worklist(spark, folder))) \
        .select("severity", "n", F.round("width", 6).alias("width"))


@query("d15_log_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return triage.log_counts(_truth(spark, folder))


# ---- functions --------------------------------------------------------------------------

@query("f01_ean13")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Validity of the article barcodes and of spoilt forms of them."""
    articles = _dirty(spark, folder)["article_master"]
    forms = F.array(F.col("barcode"), F.substring("barcode", 1, 12),
                    F.concat("barcode", F.lit("0")), F.concat("barcode", F.lit("\n")),
                    F.overlay("barcode", F.lit("X"), F.lit(5)), F.lit(None).cast("string"))
    spoilt = articles.select("article_id", F.posexplode(forms).alias("form", "code"))
    return spoilt.select("article_id", "form", barcode.is_valid(F.col("code")).alias("valid"))


@query("f02_similar_descriptions")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of different token sets of a category that score 97 or more."""
    described = near_duplicates.describe(_dirty(spark, folder)["article_master"])
    classes = near_duplicates.classes_of(described)
    pairs = near_duplicates.similar_classes(classes)
    texts = classes.select("class", "category", similarity.joined(F.col("tokens")).alias("text"))
    left = texts.select(F.col("class").alias("a"), "category", F.col("text").alias("text_a"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select(
        "category", F.least("text_a", "text_b").alias("text_low"),
        F.greatest("text_a", "text_b").alias("text_high"), F.round("score", 6).alias("score"))


@query("f05_parsed_dates")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Dates read from text; text that is no date becomes null instead of an error."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    written = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("n/a "), day)).otherwise(day)
    return orders.select("o_orderkey", written.alias("text")) \
        .withColumn("day", F.col("text").try_cast("date"))


@query("f10_formats")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Money, whole and percent text of numbers."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return lines.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n")).select(
        "l_orderkey", text.money(F.col("quantity")).alias("money"),
        text.whole(F.col("quantity") / 2).alias("whole"),
        text.percent(F.col("n") / 8).alias("percent"))


# ---- sources and sinks ------------------------------------------------------------------

@query("s01_table_rows")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table after a round trip through declared-type Parquet files."""
    return _row_counts(sources.stage(_dirty(spark, folder), TABLE_SCHEMAS))


def _row_counts(tables: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()])


def _new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


@query("s03_csv_tables")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table after a round trip through CSV files with declared types."""
    path = _new_folder(spark, "csv")
    t = _dirty(spark, folder)
    sources.write_tables(Tables({name: t[name] for name in TABLE_SCHEMAS}), path, "csv")
    return _row_counts(sources.read_tables(spark, path, "csv"))


@query("s03_csv_round_trip")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Articles written as CSV and read back with declared types; barcodes stay text."""
    path = _new_folder(spark, "csv")
    articles = _dirty(spark, folder)["article_master"]
    sources.write_tables(Tables({"article_master": articles}), path, "csv")
    return sources.read_table(spark, path, "article_master", "csv")


@query("s04_schema_check")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table whose columns match the declared names and types."""
    t = _dirty(spark, folder)
    out = None
    for name in TABLE_SCHEMAS:
        sources.check_columns(t[name], name, types=True)
        width = F.lit(len(TABLE_SCHEMAS[name])).cast("long")
        one = t[name].agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), width.alias("columns"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("s05_worklist_sink")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Worklist written partitioned by error type, read back."""
    path = _new_folder(spark, "out")
    sources.write_output(_worklist(spark, folder), path, "exceptions", partition_by="error_type")
    return sources.read_output(spark, path, "exceptions")


@query("s06_scorecard_sink")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Scorecard written and read back."""
    path = _new_folder(spark, "out")
    sources.write_output(_scorecard(spark, folder), path, "scorecard")
    return sources.read_output(spark, path, "scorecard")


@query("s07_truth_log_sink")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The corrupted tables and the truth log written; the log read back."""
    path = _new_folder(spark, "out")
    dirty, log = _corrupted(spark, folder), _truth(spark, folder)
    sources.write_tables(Tables({name: dirty[name] for name in TABLE_SCHEMAS}), path)
    sources.write_output(log, path, "ground_truth")
    return sources.read_output(spark, path, "ground_truth")


@query("s09_exported_view")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The worklist view exported as CSV, read back."""
    path = _new_folder(spark, "view")
    view = triage.worklist_view(triage.filtered(_worklist(spark, folder)))
    sources.export_view(view, path)
    return spark.read.schema(view.schema).option("header", True).csv(path)


@query("s08_clean_tables")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The six clean tables written, checked and read back: rows per table."""
    path = _new_folder(spark, "clean")
    t = _clean(spark, folder)
    sources.write_tables(Tables({name: t[name] for name in TABLE_SCHEMAS}), path)
    back = sources.read_tables(spark, path)
    for name, df in back.items():
        sources.check_columns(df, name, types=True)
    return _row_counts(back)


#: Rules on one table each, so that a run of a part of the rules is cheap.
SOME_RULES = ("barcode_invalidity", "stale_status", "uom_pack_mismatch")


def _some_rules(spark: SparkSession, folder: str, names: tuple[str, ...] = SOME_RULES) -> DataFrame:
    t = _dirty(spark, folder)
    found = rules.run(t, AS_OF, [rule for rule in rules.RULES if rule.name in names])
    return rules.with_store_group(found, t)


@query("s10_missing_inputs")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A run writes its worklist and no other output: what a later step finds."""
    path = _new_folder(spark, "out")
    sources.write_output(_some_rules(spark, folder), path, "exceptions", partition_by="error_type")
    return sources.inputs_found(spark, path)


@query("s11_rejected_values")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Orders exported as CSV with spoilt values, parsed once: typed values and what was rejected."""
    path = _new_folder(spark, "csv")
    k = F.col("o_orderkey")
    spark.read.parquet(f"{folder}/orders.parquet").select(
        k.cast("string").alias("o_orderkey"),
        F.concat(F.when(k % 7 == 0, "n/a ").otherwise(""), F.col("o_orderdate").cast("date").cast("string"))
        .alias("day"),
        F.when(k % 11 == 0, "many").otherwise((k % 50).cast("string")).alias("lines")) \
        .write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("day", T.DateType()),
                           T.StructField("lines", T.IntegerType())])
    typed, rejected = sources.with_rejects(spark, path, schema, ["o_orderkey"])
    said = rejected.groupBy(F.col("o_orderkey").cast("long").alias("o_orderkey")).agg(
        F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "column_name", "text"))), ";").alias("rejected"))
    return typed.join(said, "o_orderkey", "left").select("o_orderkey", "day", "lines", "rejected")


@query("s12_rerun_partitions")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Three rules written, one of them from stale rows; that rule written again, all read back."""
    path = _new_folder(spark, "runs")
    work = _some_rules(spark, folder)
    stale = work.withColumn("description", F.when(F.col("error_type") == "stale_status", "stale")
                            .otherwise(F.col("description")))
    runs.write_partitions(stale, path, "error_type", SOME_RULES)
    again = _some_rules(spark, folder, ("stale_status",))
    runs.write_partitions(again, path, "error_type", ("stale_status",))
    return runs.read_partitions(spark, path, "error_type", EXCEPTION_SCHEMA)


@query("d16_observed_totals")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Headline and severities of a worklist, observed by the job that writes it."""
    seen = runs.write_partitions(_some_rules(spark, folder), _new_folder(spark, "runs"), "error_type",
                                 SOME_RULES, triage.observed_metrics())
    return spark.createDataFrame([tuple(seen.values())], ", ".join(f"{name} long" for name in seen))


@query("d17_distinct_records")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct records per error type, exact, and whether merged sketches of two parts agree."""
    # Read three times below.
    work = written(_worklist(spark, folder).select("error_type", "record_id"))
    part = F.pmod(F.xxhash64("record_id"), F.lit(2))
    halves = [triage.record_sketches(work.where(part == i)) for i in (0, 1)]
    merged = triage.merged_records(halves[0].unionByName(halves[1]))
    exact = work.groupBy("error_type").agg(F.count_distinct("record_id").alias("records"))
    return exact.join(merged.withColumnRenamed("records", "estimate"), "error_type").select(
        "error_type", "records",
        # Six standard errors, and one record.
        (F.abs(F.col("estimate") - F.col("records")) <= 1 + 0.05 * F.col("records")).alias("close"))
