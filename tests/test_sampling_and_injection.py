import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfproof.functions import text
from shelfproof.operators import bands, derive, fused, gate, inject, score, triage, verify
from shelfproof.operators.numbering import exact_sample, ordinals
from shelfproof.schema import Tables
from shelfproof.sources import adapter
from shelfproof.sources.tables import stage

FOLDER = "/root/testdata/sf0.001"


def digest(*parts):
    return hashlib.md5(":".join(parts).encode()).hexdigest()


@pytest.mark.parametrize("rows, fraction", [(0, 0.5), (1, 0.01), (999, 0.05), (5000, 1.0)])
def test_exact_sample(spark, rows, fraction):
    pool = spark.range(rows).select(F.col("id").cast("string").alias("k"))
    got = {r.k for r in exact_sample(pool, "k", fraction, 7, "t").collect()}
    keys = sorted((str(n) for n in range(rows)), key=lambda k: digest("7", "t", k))
    assert got == set(keys[:max(1, int(rows * fraction))])


def test_ordinals_per_group(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), "id")
    h = text.keyed_hash(1, "o", F.col("id"))
    got = {(r.g, r.id): r.n for r in ordinals(df, h, "n", ["g"]).collect()}
    for g in range(3):
        ids = sorted((i for i in range(2000) if i % 3 == g), key=lambda i: digest("1", "o", str(i)))
        assert [got[g, i] for i in ids] == list(range(len(ids)))


@pytest.fixture(scope="module")
def corrupted(spark):
    names = ("article_master", "promotion_header", "promotion_item", "listing")
    clean = stage(adapter.tables_from(spark, FOLDER, clean=True), names)
    gate.require_clean(clean)
    dirty, log = inject.inject(clean, as_of=adapter.AS_OF)
    return clean, dirty, log.cache()


def test_log_matches_data(corrupted):
    _, dirty, log = corrupted
    verify.require_match(dirty, log, adapter.AS_OF)
    types = {r.error_type for r in verify.log_check(dirty, log, adapter.AS_OF).collect()}
    assert len(types) == 12
    missing_one = log.where(F.col("error_type") != "margin_breach")
    with pytest.raises(verify.LogMismatch, match="margin_breach"):
        verify.require_match(dirty, missing_one, adapter.AS_OF)


def test_everything_injected_is_detected(corrupted):
    _, dirty, log = corrupted
    card = score.scorecard(fused.worklist(dirty, adapter.AS_OF), dirty["promotion_item"], log)
    for row in card.collect():
        assert row.FN == 0, row
        if row.error_type != "duplicate_near_duplicate":
            assert row.FP == 0, row


def test_one_defect_per_article_and_header(corrupted):
    _, _, log = corrupted
    rows = log.where("table_name <> 'promotion_item' and error_type <> 'barcode_invalidity'") \
              .select("table_name", "record_id", "error_type").distinct().collect()
    assert max(Counter((r.table_name, r.record_id) for r in rows).values()) == 1
    assert log.select("gt_id").distinct().count() == log.count()


def test_only_logged_records_change(corrupted):
    clean, dirty, log = corrupted
    logged = {r.record_id for r in log.select("record_id").collect()}
    for name, key in (("article_master", "article_id"), ("promotion_header", "promo_id"),
                      ("promotion_item", "promo_item_id")):
        changed = dirty[name].exceptAll(clean[name]).select(key).collect()
        assert changed and all(r[key] in logged for r in changed)


def test_copies_do_not_inherit_defects(corrupted):
    _, dirty, _ = corrupted
    copies = dirty["article_master"].where(F.col("article_id").startswith("ARTDUP_"))
    assert copies.count() > 0
    assert fused.article_exceptions(copies).count() == 0


def test_same_seed_same_defects(spark, corrupted):
    clean, _, log = corrupted
    again = inject.truth_log(inject.Injection(clean, as_of=adapter.AS_OF))
    assert log.exceptAll(again).count() == 0 and again.count() == log.count()


@pytest.fixture(scope="module")
def banded(corrupted):
    clean = corrupted[0]
    dirty, log = bands.inject(clean, as_of=adapter.AS_OF)
    return clean, stage(dirty, bands.BANDS), log.cache()


def test_bands_are_disjoint_and_as_wide_as_the_rates():
    for table, names in bands.BANDS.items():
        found = bands.edges(table)
        assert [name for name, _, _ in found] == list(names)
        assert all(a[2] == b[1] for a, b in zip(found, found[1:])) and found[-1][2] <= 16 ** 7
        assert all(abs((high - low) / 16 ** 7 - inject.RATES[name]) < 1e-6 for name, low, high in found)
    assert sorted(sum(bands.BANDS.values(), ())) == sorted(inject.RATES)


def test_banded_log_matches_data(banded):
    _, dirty, log = banded
    verify.require_match(dirty, log, adapter.AS_OF)
    assert log.select("error_type").distinct().count() == 12
    assert log.select("gt_id").distinct().count() == log.count()


def test_banded_one_defect_per_article_and_header(banded):
    _, _, log = banded
    rows = log.where("table_name <> 'promotion_item'").groupBy("table_name", "record_id").count()
    assert rows.agg(F.max("count")).first()[0] == 1
    # Nor may the source of a copy have one.
    copies = log.where("error_type = 'duplicate_near_duplicate'").select(F.col("old_value").alias("record_id"))
    assert copies.join(log, "record_id").count() == 0


def test_banded_changes_are_logged(banded):
    clean, dirty, log = banded
    logged = {r.record_id for r in log.select("record_id").collect()}
    for name, key in (("article_master", "article_id"), ("promotion_header", "promo_id"),
                      ("promotion_item", "promo_item_id")):
        changed = {r[key] for r in dirty[name].exceptAll(clean[name]).select(key).collect()}
        assert changed and changed <= logged
        assert clean[name].join(dirty[name], key, "left_anti").count() == 0
    pairs = clean["listing"].select("article_id", "store_group").exceptAll(
        dirty["listing"].select("article_id", "store_group"))
    items = dirty["promotion_item"].join(dirty["promotion_header"], "promo_id")
    assert pairs.join(items, ["article_id", "store_group"], "left_anti").count() == 0


def test_banded_plan_has_no_order_and_few_scans(banded):
    """The log reads items once each for items, articles and headers; nothing is ranked or sampled."""
    log = bands.Banded(banded[0], seed=8, as_of=adapter.AS_OF).log()  # another seed: not cached
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    assert plan.count("Relation [promo_item_id#") == 3


def test_banded_edge_rows(spark, banded):
    """Null keys are in no band, empty tables stay empty, a repeated row gets the same defect."""
    clean = banded[0]
    empty = clean.replace(**{n: clean[n].limit(0) for n in bands.BANDS})
    dirty, log = bands.inject(empty, as_of=adapter.AS_OF)
    assert log.count() == 0 and all(dirty[n].count() == 0 for n in bands.BANDS)
    heads = clean["promotion_header"]
    nulls = heads.withColumn("promo_id", F.lit(None).cast("string"))
    made = bands.Banded(clean.replace(promotion_header=nulls)).headers()
    assert made.where("defect is not null").count() == 0
    twice = bands.Banded(clean.replace(promotion_header=heads.union(heads))).headers()
    assert twice.groupBy("promo_id").agg(F.countDistinct(F.coalesce("defect", F.lit("-"))).alias("n")) \
        .where("n > 1").count() == 0


# A published scorecard, (type, truth, found, TP).
PUBLISHED = [
    ("barcode_invalidity", 30, 30, 30), ("completeness", 24, 24, 24),
    ("duplicate_near_duplicate", 21, 25, 21), ("header_item_date_mismatch", 29, 29, 29),
    ("listing_conflict", 23, 23, 23), ("margin_breach", 12, 12, 12),
    ("orphaned_cancelled_header", 7, 7, 7), ("referential_integrity", 29, 29, 29),
    ("referential_timing", 21, 21, 21), ("stale_status", 13, 13, 13),
    ("tobacco_floor_breach", 7, 7, 7), ("uom_pack_mismatch", 27, 27, 27),
]


def test_published_scorecard(spark):
    found, truth = [], []
    for kind, in_truth, in_found, both in PUBLISHED:
        truth += [(kind, f"r{n}") for n in range(in_truth)]
        shift = in_truth - both
        found += [(kind, f"r{n + shift}") for n in range(in_found)]
    exceptions = spark.createDataFrame(
        [("tobacco_on_promotion" if k == "tobacco_floor_breach" else k, r) for k, r in found],
        "error_type string, record_id string")
    items = spark.createDataFrame([], "promo_item_id string, article_id string, promo_id string")
    card = score.scorecard(exceptions, items, spark.createDataFrame(
        truth, "error_type string, record_id string"))
    rows = {r.error_type: r for r in card.collect()}
    assert [r.error_type for r in card.collect()] == [k for k, *_ in PUBLISHED]
    assert rows["duplicate_near_duplicate"].precision == 0.84
    assert rows["duplicate_near_duplicate"].recall == 1.0
    total = score.overall(card).first()
    assert (total.TP, total.FP, total.FN) == (243, 4, 0)
    assert round(total.precision, 3) == 0.984 and round(total.f1, 4) == 0.9918
    view = {r.Check for r in triage.scorecard_view(card).collect()}
    assert "Tobacco on promotion" in view and len(view) == 12


def test_score_edges(spark):
    items = spark.createDataFrame([("I1", "A1", "P1"), ("I2", "A1", "P1")],
                                  "promo_item_id string, article_id string, promo_id string")
    found = spark.createDataFrame(
        [("referential_timing", "I1"), ("referential_timing", "I2"), ("stale_status", "P9"),
         ("orphaned_cancelled_header", "I1"), ("uom_pack_mismatch", "I404")],
        "error_type string, record_id string")
    truth = spark.createDataFrame(
        [("referential_timing", "A1"), ("margin_breach", "I1"), ("orphaned_cancelled_header", "P1")],
        "error_type string, record_id string")
    rows = {r.error_type: r for r in score.scorecard(found, items, truth).collect()}
    assert (rows["referential_timing"].TP, rows["referential_timing"].found) == (1, 1)
    assert rows["margin_breach"].precision is None and rows["margin_breach"].recall == 0.0
    assert rows["stale_status"].precision == 0.0 and rows["stale_status"].recall is None
    assert rows["orphaned_cancelled_header"].TP == 1
    assert rows["uom_pack_mismatch"].FP == 1
    nothing = score.overall(score.scorecard(found.limit(0), items, truth.limit(0))).first()
    assert nothing.precision is None and nothing.f1 is None


def test_picks_are_eligible_and_distinct(spark):
    t = adapter.tables_from(spark, FOLDER)
    picks = derive.pick_articles(t["promotion_header"], t["article_master"], t["listing"])
    per_promo = picks.groupBy("promo_id").agg(F.count("*").alias("n"),
                                              F.countDistinct("article_id").alias("d"))
    row = per_promo.agg(F.min("n"), F.max("n"), F.sum(F.col("n") - F.col("d"))).first()
    assert row[1] <= 6 and row[2] == 0
    assert picks.join(derive._eligible(t["article_master"], t["listing"]),
                      ["store_group", "article_id"], "left_anti").count() == 0


def test_derived_items_are_valid(spark):
    t = adapter.tables_from(spark, FOLDER, clean=True)
    items = derive.promotion_items(t["promotion_header"], t["article_master"], t["listing"])
    below = items.join(t["article_master"], "article_id").where(
        F.col("effective_unit_price") < F.col("cost_price") - 0.01)
    assert below.where("mechanic in ('fixed_price', 'percent_off', 'dollar_off')").count() == 0
    made = t.replace(promotion_item=items.drop("effective_unit_price"))
    for key in ("v01", "v02", "v05", "v06", "v07", "v08", "v09"):
        assert gate.assertion(made, key).first().bad_count == 0


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tables_are_joined_narrow(spark, tmp_path):
    """Pairs of the listing meet the parts when they are distinct; lines meet headers by number."""
    spark.createDataFrame([(1, 7, "2020-01-01 00:00:00", "1-URGENT")], "o_orderkey long, o_custkey long, "
                          "day string, o_orderpriority string").selectExpr(
        "*", "timestamp(day) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(7, "c", 3)], "c_custkey long, c_name string, c_nationkey int") \
        .write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(5, "n", "b", "LARGE", 1, 9.0)], "p_partkey long, p_name string, p_brand string, "
                          "p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, 5, 2, 1, 3.0), (1, 6, 2, 2, 3.0), (2, 5, 2, 1, 3.0), (None, 5, 2, 1, 3.0),
                           (1, 5, 2, 3, 3.0)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    t = adapter.tables_from(spark, str(tmp_path), clean=True)
    assert [tuple(r)[:2] for r in t["listing"].collect()] == [("SG_03", "ART00000005")]
    assert sorted(r.promo_item_id for r in t["promotion_item"].collect()) == [
        "PIT00000001_1_5_2_3", "PIT00000001_3_5_2_3"]
    broadcast = "spark.sql.autoBroadcastJoinThreshold"  # a semi join with a small table moves down
    kept = spark.conf.get(broadcast)
    spark.conf.set(broadcast, "-1")
    try:
        plan = _plan(adapter.tables_from(spark, str(tmp_path), clean=True)["listing"])
    finally:
        spark.conf.set(broadcast, kept)
    assert plan.index("Join LeftSemi") < plan.index("Aggregate") < plan.index("Join Inner")
    # No join on a text.
    assert "promo_id" not in "".join(line for line in _plan(t["promotion_item"]).splitlines() if "Join" in line)


def test_banded_decisions_ask_few_tables(banded):
    x = bands.Banded(banded[0], as_of=adapter.AS_OF)
    assert _plan(x.articles()).count("Join ") == 1
    assert _plan(x.tables()["promotion_item"].where("promo_item_id NOT LIKE 'PITTOB%'")).count("listing") == \
        _plan(x.added()).count("listing")


def test_only_sampled_items_meet_their_changes(spark):
    """Items beyond the samples pass without the join; a repeated or null key keeps its rows."""
    items = spark.range(400).selectExpr(
        "CASE WHEN id < 398 THEN concat('I', id) WHEN id = 398 THEN 'I1' END AS promo_item_id",
        "'P' AS promo_id", "'A' AS article_id", "'fixed_price' AS mechanic", "2.0D AS promo_price",
        "CAST(NULL AS DOUBLE) AS discount_value", "CAST(NULL AS INT) AS multibuy_qty",
        "DATE'2020-01-01' AS item_start", "DATE'2020-01-07' AS item_end")
    x = inject.Injection(Tables({"promotion_item": items}))
    some = items.where("promo_item_id IN ('I5', 'I1')").select("promo_item_id")
    x._done = {
        "referential_integrity": some.selectExpr("promo_item_id", "'F' AS new_article"),
        "header_item_date_mismatch": some.limit(0).selectExpr("promo_item_id", "current_date() AS new_end"),
        "margin_breach": some.limit(0).selectExpr("promo_item_id", "1.0D AS new_price"),
        "tobacco_floor_breach": some.limit(0).selectExpr(
            "promo_item_id", "'P' AS promo_id", "'A' AS article_id", "1.0D AS promo_price",
            "current_date() AS header_start", "current_date() AS header_end")}
    got = inject.corrupted_items(x)
    assert got.count() == 400
    assert sorted(r.promo_item_id for r in got.where("article_id = 'F'").collect()) == ["I1", "I1", "I5"]
    assert _plan(got).startswith("Union")
