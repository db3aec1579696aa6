import pytest
from pyspark.sql import functions as F

from shelfproof.operators import fused, triage
from shelfproof.schema import SchemaMismatch, TABLE_SCHEMAS, Tables, check_columns
from shelfproof.sources import adapter, runs, tables as sources
from tests.conftest import AS_OF
from tests.test_rules import messy


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_tables_round_trip(spark, make, tmp_path, fmt):
    t = messy(make)
    sources.write_tables(t, str(tmp_path), fmt)
    back = sources.read_tables(spark, str(tmp_path), fmt, names=t)
    for name in t:
        assert back[name].schema == TABLE_SCHEMAS[name]
        assert sorted(map(str, back[name].collect())) == sorted(map(str, t[name].collect()))


def test_csv_types(spark, tmp_path):
    path = tmp_path / "listing.csv"
    path.write_text("valid_from,article_id,store_group,valid_to\n"
                    "2024-01-01,00123,G1,2099-12-31\nsoon,A2,G1,2099-12-31\n")
    rows = sources.read_table(spark, str(tmp_path), "listing", "csv").collect()
    assert rows[0].article_id == "00123" and rows[1].valid_from is None
    bad = sources.unparsed(spark, str(path), TABLE_SCHEMAS["listing"]).collect()
    assert [(r.column_name, r.text) for r in bad] == [("valid_from", "soon")]


def test_missing_input_names_the_step(spark, tmp_path):
    with pytest.raises(sources.MissingInput, match="run the validation run first"):
        sources.read_output(spark, str(tmp_path), "exceptions")
    with pytest.raises(sources.MissingInput):
        sources.read_table(spark, str(tmp_path), "listing", "csv")


def test_schema_check(spark):
    df = spark.createDataFrame([], "store_group string, article_id int, extra int, valid_to date")
    with pytest.raises(SchemaMismatch, match=r"missing \['valid_from'\].*unexpected \['extra'\]"):
        check_columns(df, "listing")
    typed = df.withColumnRenamed("extra", "valid_from")
    check_columns(typed, "listing")
    with pytest.raises(SchemaMismatch, match="article_id is int, declared string"):
        check_columns(typed, "listing", types=True)
    with pytest.raises(KeyError):
        Tables({"nonsense": df})


def test_outputs(spark, make, tmp_path):
    worklist = fused.worklist(messy(make), AS_OF)
    sources.write_output(worklist, str(tmp_path), "exceptions", partition_by="error_type")
    back = sources.read_output(spark, str(tmp_path), "exceptions")
    assert back.count() == worklist.count()
    view = triage.worklist_view(triage.filtered(worklist, severities=("High",)))
    sources.export_view(view, str(tmp_path / "view"))
    assert spark.read.option("header", True).csv(str(tmp_path / "view")).count() == view.count()


def exceptions(spark, rows):
    return spark.createDataFrame(rows, "error_type string, severity string, store_group string")


def test_severity_and_groups(spark):
    df = exceptions(spark, [("a", "Low", "G1"), ("b", "Low", "G1"), ("b", "High", None),
                            ("b", "High", "G2"), ("b", "High", "G3"), ("b", "High", "G3")])
    assert [(r.severity, r.n) for r in triage.severity_counts(df).collect()] == [
        ("Critical", 0), ("High", 4), ("Medium", 0), ("Low", 2)]
    assert [(r.store_group, r.n) for r in triage.group_counts(df).collect()] == [
        ("G1", 2), ("G3", 2), ("G2", 1)]
    row = triage.group_summary(df).first()
    assert (row.groups, row.worst, row["median"]) == (3, 2, 2)
    assert [r.store_group for r in triage.worst_groups(df, 2).collect()] == ["G1", "G3"]
    widths = {r.severity: r.width for r in triage.bar_widths(triage.severity_counts(df)).collect()}
    assert widths == {"High": 100.0, "Low": 50.0}
    # An unknown type keeps its own name.
    assert {r.check for r in triage.type_counts(df).collect()} == {"a", "b"}


def test_median_is_cut(spark):
    df = exceptions(spark, [("a", "Low", "G1")] * 4 + [("a", "Low", "G2")])
    assert triage.group_summary(df).first()["median"] == 2


def test_filters_and_order(make):
    worklist = fused.worklist(messy(make), AS_OF)
    assert triage.filtered(worklist).count() == worklist.count()
    assert triage.filtered(worklist, severities=()).count() == 0
    one = triage.filtered(worklist, checks=["Priced below cost"], groups=["G1"])
    assert {(r.error_type, r.store_group) for r in one.collect()} == {("margin_breach", "G1")}
    ranks = [(r.severity_rank, r.check) for r in triage.in_order(triage.filtered(worklist)).collect()]
    assert ranks == sorted(ranks)
    shown = triage.shown_of_total(worklist, checks=["Priced below cost"], groups=["G1"]).first()
    assert (shown.shown, shown.total) == (one.count(), worklist.count())


def test_filters_reach_the_scan(spark):
    t = adapter.tables_from(spark, "/root/testdata/sf0.001")
    plan = t["article_master"].where(F.col("status") == "active").select("article_id") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "p_retailprice" not in plan and "p_name" not in plan


def test_rejects_and_rows_come_from_one_parse(spark, tmp_path):
    path = tmp_path / "listing.csv"
    path.write_text("valid_from,article_id,store_group,valid_to\n"
                    "2024-01-01,00123,G1,2099-12-31\nsoon,A2,G1,never\n,A3,,2099-12-31\n")
    rows, bad = sources.with_rejects(spark, str(path), TABLE_SCHEMAS["listing"], ["store_group", "article_id"])
    read = sources.read_table(spark, str(tmp_path), "listing", "csv")
    assert sorted(map(str, rows.collect())) == sorted(map(str, read.collect()))
    assert sorted(tuple(r) for r in bad.collect()) == [
        ("G1", "A2", "valid_from", "soon"), ("G1", "A2", "valid_to", "never")]
    path.write_text("gone")  # both tables are of the one parse that was written
    assert rows.count() == 3 and bad.count() == 2
    with pytest.raises(SchemaMismatch, match="valid_from"):
        sources.with_rejects(spark, str(path), TABLE_SCHEMAS["listing"], [])


SCHEMA = "kind string, n long"


def test_rerun_replaces_its_partitions_only(spark, tmp_path):
    folder = str(tmp_path / "out")

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), SCHEMA)

    def read():
        return sorted(tuple(r) for r in runs.read_partitions(spark, folder, "kind", rows(("", 0)).schema).collect())

    seen = runs.write_partitions(rows(("a", 1), ("a", 2), ("b", 3), ("x", 9)), folder, "kind", ("a", "b", "c"),
                                 {"n": F.count(F.lit(1)), "total": F.sum("n")})
    assert seen == {"n": 3, "total": 6}  # x is no partition of this run
    assert read() == [("a", 1), ("a", 2), ("b", 3)]
    assert runs.write_partitions(rows(("b", 4)), folder, "kind", ("b", "c")) == {"rows": 1}
    assert read() == [("a", 1), ("a", 2), ("b", 4)]
    broken = rows(("a", 5)).withColumn("n", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        runs.write_partitions(broken, folder, "kind", ("a",))
    assert read() == [("a", 1), ("a", 2), ("b", 4)]
    runs.write_partitions(rows(("b", 1)).limit(0), folder, "kind", ("b",))
    assert read() == [("a", 1), ("a", 2)]


def test_sketches_of_parts_merge_to_the_whole(spark):
    work = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "rare").otherwise("common").alias("error_type"),
        F.concat(F.lit("R"), F.col("id") % 20_000).alias("record_id"))
    whole = triage.record_sketches(work)
    parts = [triage.record_sketches(work.where(F.col("id") % 2 == i)) for i in (0, 1)]
    want = {r.error_type: r.records for r in triage.merged_records(whole).collect()}
    got = {r.error_type: r.records for r in triage.merged_records(parts[0].unionByName(parts[1])).collect()}
    exact = {r.error_type: r.n for r in work.groupBy("error_type").agg(
        F.count_distinct("record_id").alias("n")).collect()}
    for name, n in exact.items():
        assert abs(got[name] - n) <= 0.05 * n and abs(got[name] - want[name]) <= 0.01 * n
