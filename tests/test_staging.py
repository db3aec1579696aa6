from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfproof.plans import queries
from shelfproof.sources import tables as sources


@pytest.fixture
def staged(monkeypatch):
    """How often each table is written."""
    seen = Counter()
    whole = sources.stage

    def stage(tables, names):
        seen.update(names)
        return whole(tables, names)

    monkeypatch.setattr(sources, "stage", stage)
    return seen


def test_tables_are_written_when_asked_and_once(make, staged):
    clean = sources.stage_when_asked(make(), ("article_master", "listing"))
    assert not staged
    dirty = clean.replace(listing=lambda: clean["listing"].limit(0))
    assert dirty["article_master"].count() == clean["article_master"].count() == 1
    assert staged == {"article_master": 1}
    assert dirty["listing"].count() == 0 and clean["listing"].count() == 1
    assert staged == {"article_master": 1, "listing": 1}


@pytest.fixture
def given(spark, make, monkeypatch):
    """Injection queries on a few made rows."""
    n = range(40)
    rows = make(
        articles=[{"article_id": f"A{i}", "article_description": f"Water {i}"} for i in n],
        headers=[{"promo_id": f"P{i}"} for i in n],
        items=[{"promo_item_id": f"I{i}", "promo_id": f"P{i}", "article_id": f"A{i}"} for i in n],
        listing=[{"article_id": f"A{i}"} for i in n])
    monkeypatch.setattr(queries, "_clean", lambda *_: rows)
    monkeypatch.setattr(queries, "_INJECTIONS", {})
    monkeypatch.setattr(queries, "_CORRUPTED", {})
    return lambda name: queries.QUERIES[name](spark, "made")


def test_cancelled_headers_need_neither_articles_nor_listing(given, staged):
    assert given("j05_orphaned_cancelled_header").count() == 10
    assert staged == {"promotion_header": 1, "promotion_item": 1}


def test_corrupted_articles_need_no_other_corrupted_table(given, staged):
    assert given("j13_corrupted_article_master").count() >= 40
    assert staged["article_master"] == 2 and staged["promotion_item"] == 1
    assert staged["listing"] == staged["promotion_header"] == 0


def test_the_log_needs_no_corrupted_table(given, staged):
    log = given("d15_log_counts").collect()
    assert log and set(staged.values()) == {1}
    assert given("k_log_check").where("status <> 'OK'").isEmpty()
    assert set(staged.values()) == {2}


def test_distinct_records_read_the_worklist_once(spark, monkeypatch):
    evaluated = spark.sparkContext.accumulator(0)

    @F.udf(T.StringType())
    def counted(x):
        evaluated.add(1)
        return x

    work = spark.range(100).select(F.lit("stale_status").alias("error_type"),
                                   counted(F.concat(F.lit("P"), F.col("id") % 50)).alias("record_id"))
    monkeypatch.setattr(queries, "_worklist", lambda *_: work)
    got = queries.QUERIES["d17_distinct_records"](spark, "made").collect()
    assert [tuple(r) for r in got] == [("stale_status", 50, True)]
    assert evaluated.value == 100
