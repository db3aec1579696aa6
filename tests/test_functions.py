from datetime import date

from pyspark.sql import functions as F

from shelfproof.functions import barcode, similarity, text


def test_barcode(spark):
    body = "930012345678"
    rows = [(body, str(d), f"{body}{d}") for d in range(10)]
    df = spark.createDataFrame(rows, "body string, d string, code string")
    out = df.select("code", barcode.is_valid(F.col("code")).alias("ok"),
                    F.concat("body", barcode.check_digit(F.col("body")).cast("string")).alias("right")).collect()
    assert [r.code for r in out if r.ok] == [out[0].right]
    bad = [None, "", body, out[0].right + "0", out[0].right + "\n", "93001234X6781",
           "٣" * 13, " " + out[0].right[1:]]
    df = spark.createDataFrame([(b,) for b in bad], "code string")
    assert not any(r.ok for r in df.select(barcode.is_valid(F.col("code")).alias("ok")).collect())


def test_numbered_barcodes_equal_text_ones(spark):
    df = spark.createDataFrame([(n,) for n in (0, 7, 19, 1234567, 9999999999)], "n long")
    made = barcode.numbered(93, F.col("n"), barcode.number_check_digit(93, F.col("n")))
    body = text.padded("93", F.col("n"), 10)
    by_text = F.concat(body, barcode.check_digit(body).cast("string"))
    assert all(r.a == r.b for r in df.select(made.alias("a"), by_text.alias("b")).collect())


def test_token_set_and_indel(spark):
    df = spark.createDataFrame([("b a a \tc", "kitten", "sitting"), (None, "", "abc"),
                                ("  ", "abc", ""), ("x", "ab", "ab")], "t string, x string, y string")
    out = similarity.with_indel(df.withColumn("t", similarity.token_set(F.col("t"))),
                                "x", "y", F.lit(9), "d").collect()
    assert [r.t for r in out] == [["a", "b", "c"], [], [], ["x"]]
    assert [r.d for r in out] == [5, 3, 3, 0]


def test_formats_and_dates(spark):
    df = spark.createDataFrame([(2.5, date(2026, 7, 1)), (1234.567, date(2026, 7, 2)),
                                (98.5, date(2026, 7, 3))], "x double, d date")
    out = df.select(text.money(F.col("x")).alias("m"), text.whole(F.col("x")).alias("w"),
                    text.percent(F.col("x") / 100).alias("p"),
                    text.snap_to_thursday(F.col("d")).alias("t")).collect()
    assert [r.m for r in out] == ["2.50", "1234.57", "98.50"]
    assert [r.w for r in out] == ["2", "1235", "98"]
    assert out[2].p == "98.5%"
    assert [r.t for r in out] == [date(2026, 7, 2), date(2026, 7, 2), date(2026, 7, 9)]


def test_padded_keeps_long_numbers(spark):
    out = spark.range(1).select(text.padded("A", F.lit(7), 3).alias("a"),
                                text.padded("A", F.lit(12345), 3).alias("b")).first()
    assert (out.a, out.b) == ("A007", "A12345")
