"""Rows that need not move are not moved, and the results stay."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelfproof.operators import bands, fused, rules
from shelfproof.plans import queries
from shelfproof.sources import adapter
from tests.conftest import AS_OF


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def rows_of(df):
    return sorted(map(str, df.collect()))


def _source(spark, tmp_path):
    day = datetime(1998, 6, 1)
    spark.createDataFrame([(1, "hot bolt", "b", "LARGE", 1, 900.0), (2, "blue ring", "b", "SMALL", 2, 901.0)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                          "p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, "c1", 3), (2, "c2", None)], "c_custkey long, c_name string, c_nationkey int") \
        .write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(10, 1, day, "5-LOW"), (11, 2, day, "5-LOW"), (123456789, 1, day, "5-LOW")],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(10, 1, 7, 1, 3.0), (10, 1, 7, 2, 3.0), (11, 2, 7, 1, 3.0), (11, None, 7, 2, 3.0),
                           (123456789, 2, 7, 1, 3.0), (None, 2, 7, 1, 3.0), (99, 1, 7, 1, 3.0)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    return adapter.tables_from(spark, str(tmp_path))


def test_listed_pairs_move_once(spark, tmp_path, no_broadcast):
    listing = _source(spark, tmp_path)["listing"]
    assert sorted(((r.article_id, r.store_group) for r in listing.collect()), key=str) == [
        ("ART00000001", "SG_03"), ("ART00000002", "SG_03"), ("ART00000002", None)]
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(store_group" not in plan


def _cases(make):
    last = date(2026, 7, 8)
    return make(
        articles=[{}, {"article_id": "A2", "base_uom": "PACK", "cost_price": 9.0}, {"article_id": "A2"},
                  {"article_id": "T", "merch_category": "TOBACCO"}],
        headers=[{}, {"promo_id": "P2", "approval_status": "cancelled"}, {"promo_id": "P3", "store_group": None},
                 {"promo_id": "P3", "store_group": "G1", "header_end": None}],
        items=[{}, {"promo_item_id": "I2", "item_end": date(2026, 7, 9)},
               {"promo_item_id": "I3", "promo_id": "P2", "article_id": "A2", "mechanic": "multibuy"},
               {"promo_item_id": "I4", "promo_id": "P2", "item_end": None},
               {"promo_item_id": "I5", "promo_id": "P3", "article_id": "T", "mechanic": "percent_off"},
               {"promo_item_id": "I6", "promo_id": None, "article_id": None, "item_start": None},
               {"promo_item_id": "I7", "promo_id": "P3", "article_id": "A2", "mechanic": None, "item_end": last}],
        listing=[{}, {"article_id": "A2", "store_group": None}, {"article_id": "T"}, {"article_id": "T"}])


def test_items_go_on_to_the_articles_without_what_no_rule_needs(make):
    t = _cases(make)
    lean = fused.enriched_for_rules(t, AS_OF)
    seen = {r.promo_item_id: r for r in lean.collect()}
    assert seen["I1"].header_start is seen["I1"].promo_id is seen["I1"].item_end is None
    assert seen["I2"].header_end == date(2026, 7, 8) and seen["I3"].promo_id == "P2"
    found = fused.item_exceptions(lean, AS_OF, units=True)
    assert found.count() > 8
    assert rows_of(found) == rows_of(fused.item_exceptions(fused.enrich(t), AS_OF, units=True))


def test_unlisted_items_are_those_of_an_anti_join(make, no_broadcast):
    t = _cases(make)
    same = ["article_id", "store_group"]
    want = (t["promotion_item"].join(t["promotion_header"].select("promo_id", "store_group"), "promo_id")
            .join(t["article_master"], "article_id", "left_semi").join(t["listing"], same, "left_anti"))
    got = rules.listing_conflict(t, AS_OF)
    assert rows_of(got.select("record_id")) == rows_of(want.select(F.col("promo_item_id").alias("record_id")))
    assert "Exchange hashpartitioning(article_id" in (plan := got._jdf.queryExecution().executedPlan().toString())
    assert "Exchange hashpartitioning(article_id, store_group" not in plan.replace("#", ", #") \
        and "store_group#" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_the_rules_read_tables_that_are_built_once(spark, make, monkeypatch):
    built = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        built.add(1)
        return x

    t = make(items=[{"promo_item_id": f"I{i}", "article_id": "F"} for i in range(20)])
    t = t.replace(promotion_item=t["promotion_item"].withColumn("promo_item_id", counted("promo_item_id")))
    monkeypatch.setattr(queries, "_dirty", lambda *_: t)
    assert queries.QUERIES["e02_worklist_by_rule"](spark, "made").count() >= 20
    assert built.value == 20


def test_items_of_other_bands_do_not_meet_headers_but_repeat_with_them(make):
    n = range(200)
    t = make(articles=[{"article_id": f"A{i % 20}"} for i in range(25)],
             headers=[{"promo_id": f"P{i % 10}"} for i in range(13)],
             items=[{"promo_item_id": f"I{i}", "promo_id": f"P{i % 10}", "article_id": f"A{i % 20}"} for i in n]
             + [{"promo_item_id": "N", "promo_id": None, "article_id": None}])
    x = bands.Banded(t, as_of=AS_OF)
    whole = x.changed_items().withColumns({
        "article_id": F.coalesce("new_article", "article_id"), "item_end": F.coalesce("new_end", "item_end"),
        "promo_price": F.coalesce("new_price", "promo_price")})
    got = x.new_items()
    assert whole.count() > 250
    assert rows_of(got) == rows_of(whole.select(got.columns))


def test_who_asks_the_log_for_copies_reads_articles_alone(make):
    log = bands.Banded(make(), as_of=AS_OF).log()
    plan = log.where("error_type = 'duplicate_near_duplicate'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 1
    assert log._jdf.queryExecution().optimizedPlan().toString().count("Generate inline") == 4
