import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfproof.operators import fused, gate, rules, score
from shelfproof.plans import queries
from tests.conftest import AS_OF, HEADER

DAY = timedelta(days=1)


def found(name, tables):
    return sorted(r.record_id for r in rules.run_rule(name, tables, AS_OF).collect())


def test_clean_rows_give_nothing(make):
    assert rules.run(make(), AS_OF).count() == 0
    assert gate.summary(gate.assertions(make())).first().status == "clean"


def test_unknown_and_null_article(make):
    t = make(items=[{"article_id": "ZZ"}, {"promo_item_id": "I2", "article_id": None}])
    assert found("referential_integrity", t) == ["I1", "I2"]
    for other in ("referential_timing", "listing_conflict", "uom_pack_mismatch",
                  "tobacco_on_promotion", "margin_breach"):
        assert found(other, t) == []


def test_discontinued_before_start_only(make):
    start = HEADER["header_start"]
    for gone, expected in ((start, []), (start - DAY, ["I1"]), (None, [])):
        t = make(articles=[{"status": "discontinued", "discontinued_date": gone}])
        assert found("referential_timing", t) == expected


def test_listing(make):
    assert found("listing_conflict", make(listing=[{"store_group": "G2"}])) == ["I1"]
    assert found("listing_conflict", make(listing=[{"valid_from": None}])) == ["I1"]
    # The window of a listing counts on request only.
    late = make(listing=[{"valid_from": date(2026, 6, 30)}])
    assert found("listing_conflict", late) == []
    assert rules.listing_conflict(late, AS_OF, within_window=True).count() == 1


def test_windows(make):
    start, end = HEADER["header_start"], HEADER["header_end"]
    cases = [({}, [], 0), ({"item_end": None}, ["I1"], 0), ({"item_end": end + DAY}, ["I1"], 1),
             ({"item_start": start - DAY}, ["I1"], 1), ({"item_start": end + DAY}, ["I1"], 0)]
    for change, expected, gate_count in cases:
        t = make(items=[change])
        assert found("header_item_date_mismatch", t) == expected
        assert gate.assertion(t, "v06").first().bad_count == gate_count


def test_unknown_header(make):
    t = make(items=[{"promo_id": "ZZ", "item_end": None}])
    for name in ("listing_conflict", "header_item_date_mismatch", "orphaned_cancelled_header"):
        assert found(name, t) == []
    assert gate.assertion(t, "v02").first().bad_count == 1


def test_cancelled(make):
    for end, expected in ((AS_OF, ["I1"]), (AS_OF - DAY, []), (None, [])):
        t = make(headers=[{"approval_status": "cancelled"}], items=[{"item_end": end}])
        assert found("orphaned_cancelled_header", t) == expected


def test_units(make):
    multibuy = [{"mechanic": "multibuy", "multibuy_qty": 2}]
    t = make(articles=[{"base_uom": None}], items=multibuy)
    assert found("uom_pack_mismatch", t) == []
    assert found("completeness", t) == ["A1"]
    assert gate.assertion(t, "v09").first().bad_count == 1
    assert found("uom_pack_mismatch", make(articles=[{"base_uom": "CTN"}], items=multibuy)) == ["I1"]


def test_margin(make):
    for price, expected in ((3.0, []), (2.99, ["I1"]), (None, [])):
        assert found("margin_breach", make(items=[{"promo_price": price}])) == expected
    percent = make(items=[{"mechanic": "percent_off", "promo_price": 1.0, "discount_value": 50.0}])
    assert found("margin_breach", percent) == []
    assert rules.margin_breach(percent, AS_OF, all_mechanics=True).count() == 1
    bundle = make(items=[{"mechanic": "multibuy", "promo_price": 5.0, "multibuy_qty": 2}])
    assert found("margin_breach", bundle) == []
    assert rules.margin_breach(bundle, AS_OF, per_unit=True).count() == 1


def test_completeness_text(make):
    t = make(articles=[{"base_uom": None, "tax_code": None}], headers=[{"approval_status": None}])
    texts = [r.description for r in rules.run_rule("completeness", t, AS_OF).collect()]
    assert "article 'A1' missing: base_uom, tax_code." in texts and len(texts) == 2


def test_stale(make):
    for end, expected in ((AS_OF, []), (AS_OF - DAY, ["P1"])):
        assert found("stale_status", make(headers=[{"header_end": end}], items=[])) == expected


def test_texts(make):
    t = make(articles=[{"merch_category": "TOBACCO", "status": "discontinued",
                        "discontinued_date": date(2026, 1, 2)}],
             items=[{"promo_price": 2.5}])
    texts = {r.error_type: r.description for r in rules.run(t, AS_OF).collect()}
    assert texts == {
        "referential_timing": "promo_item I1 promotes article 'A1', discontinued on 2026-01-02, "
                              "before the promo item started on 2026-06-25.",
        "tobacco_on_promotion": "promo_item I1 promotes tobacco article 'A1'.",
        "margin_breach": "promo_item I1 prices article 'A1' at $2.50, below cost $3.00.",
    }


def messy(make):
    articles = [{"article_id": f"A{n}", "article_description": f"Water {n % 3}",
                 "base_uom": [None, "EA", "CTN"][n % 3], "tax_code": [None, "GST"][n % 2],
                 "status": ["active", "discontinued"][n % 2],
                 "discontinued_date": date(2026, 6, 20 + n % 9) if n % 2 else None,
                 "barcode": ["9300000000019", "9300000000015", None][n % 3],
                 "merch_category": ["TOBACCO", "FUEL", None][n % 3]} for n in range(12)]
    headers = [{"promo_id": f"P{n}", "store_group": f"G{n % 2}",
                "header_end": None if n == 3 else AS_OF + (n - 3) * DAY,
                "approval_status": ["live", "cancelled", None][n % 3]} for n in range(7)]
    items = [{"promo_item_id": f"I{n}", "promo_id": f"P{n % 8}" if n % 9 else None,
              "article_id": f"A{n % 13}" if n % 11 else None,
              "mechanic": ["fixed_price", "multibuy", "percent_off"][n % 3],
              "promo_price": [2.0, 4.0, None][n % 3 - n % 2],
              "item_end": None if n % 10 == 0 else AS_OF + (n % 7 - 3) * DAY} for n in range(90)]
    listing = [{"article_id": f"A{n}", "store_group": f"G{n % 2}",
                "valid_from": None if n == 4 else date(2024, 1, 1)} for n in range(10)]
    return make(articles, headers, items, listing)


def test_fused_equals_rules_with_nulls(make):
    t = messy(make)
    slow = rules.with_store_group(rules.run(t, AS_OF), t)
    fast = fused.worklist(t, AS_OF)
    rows = sorted(map(str, slow.collect()))
    assert len({r.error_type for r in fast.collect()}) == 12
    assert rows == sorted(map(str, fast.collect()))


def test_totals_and_uniqueness(make):
    t = messy(make)
    row = rules.totals(fused.worklist(t, AS_OF)).first()
    assert (row.checks, row.exceptions) == (12, rules.run(t, AS_OF).count())
    repeated = {r.table_name: r.repeated_keys for r in gate.key_uniqueness(
        make(articles=[{}, {}, {"article_id": "A2"}])).collect()}
    assert repeated["article_master"] == 1 and repeated["promotion_item"] == 0


def test_gate_raises(make):
    gate.require_clean(make())
    with pytest.raises(gate.NotClean, match="promo item -> article exists"):
        gate.require_clean(make(items=[{"article_id": "ZZ"}]))
    t = make(articles=[{}, {"article_id": "A2", "article_type": "variant",
                            "parent_article_id": "A1"}])
    assert gate.assertion(t, "v03").first().bad_count == 1  # the parent is no generic


def test_plan_has_one_item_scan_and_no_nested_loop(make):
    t = messy(make)
    plan = fused.item_exceptions(fused.enrich(t), AS_OF)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    filtered = t["promotion_item"].where(F.col("promo_id").isNull())
    assert filtered.count() > 0  # the null keys above are really there


def test_items_move_once_by_article(spark, make):
    t = messy(make)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fused.enrich(t)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    by = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    # Items by header and by article; headers, articles and listings once each.
    assert len(by) == 5 and not any("store_group" in keys for keys in by)


def test_listing_rows_give_items_as_a_join_does(make):
    t = make(items=[{}, {"promo_item_id": "I2", "article_id": "A2"}, {"promo_item_id": "I3", "promo_id": None}],
             listing=[{}, {}, {"article_id": "A2", "store_group": None}, {"valid_from": None}])
    got = [(r.promo_item_id, r.is_listed) for r in fused.enrich(t).collect()]
    assert sorted(got) == [("I1", True), ("I1", True), ("I2", False), ("I3", False)]


def test_worklist_says_what_the_truth_log_counts(make):
    t = messy(make)
    said = score.found_keys(fused.worklist(t, AS_OF, units=True), t["promotion_item"])
    looked_up = score.found_keys(fused.worklist(t, AS_OF), t["promotion_item"])
    assert sorted(map(str, said.collect())) == sorted(map(str, looked_up.collect()))
    assert fused.worklist(t, AS_OF, units=True).drop("unit").schema == fused.worklist(t, AS_OF).schema


def test_scorecard_reads_the_items_once(spark, make, monkeypatch):
    t = messy(make)
    log = spark.createDataFrame([], "record_id string, error_type string")
    monkeypatch.setattr(queries, "_corrupted", lambda *_: t)
    monkeypatch.setattr(queries, "_truth", lambda *_: log)
    plan = queries.QUERIES["r_scorecard"](spark, "made")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"LogicalRDD \[[^]]*promo_item_id|LocalRelation \[[^]]*promo_item_id", plan)) == 1
