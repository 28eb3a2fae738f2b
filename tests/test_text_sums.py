"""Digests of written files: which texts count as numbers, and that no other text is cast to one."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialscope.plans import registry

TEXTS = [
    "1", " 12.5 ", "-.5", "+7.", "1e3", "2E-2", "3d", "4.5F", "0x1p4", "0x1.8p1", "\t9\n", "1e400", "1e30", "007",
    "NaN", "Infinity", "-inf", "", " ", ".", "e5", "1e", "1 2", "--1", "0x1", "2024-01-01", "12:30", "desktop",
    "١", "1 ", "9" * 40, "true", None,
]


def _every_cast(df, c):
    text = F.col(c).cast("string")
    number = text.try_cast("double").try_cast("decimal(30,6)")
    other = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("decimal(30,6)")
    return df.agg(F.count(c), F.sum(F.coalesce(number, other)).cast("decimal(38,6)")).first()


def test_sums_of_texts_are_those_of_casting_every_text(spark):
    for text in TEXTS:
        df = spark.createDataFrame([(text,)], "x string")
        row = registry._text_sums("t", df, "name").first()
        assert (row.non_null, row.checksum) == tuple(_every_cast(df, "x")), repr(text)


def test_sums_of_other_types_are_those_of_casting_every_text(spark):
    df = spark.sql(
        "SELECT true AS a, date'2024-02-03' AS b, timestamp_ntz'2024-02-03 04:05:06' AS c, 1.25BD AS d, "
        "double('NaN') AS e, 7 AS f, timestamp'2024-02-03 04:05:06' AS g, double('1e-9') AS h UNION ALL "
        "SELECT NULL, NULL, NULL, NULL, double('1e40'), NULL, NULL, NULL"
    )
    rows = {r.column_name: r for r in registry._text_sums("t", df, "name").collect()}
    for c in df.columns:
        assert (rows[c].non_null, rows[c].checksum) == tuple(_every_cast(df, c)), c


def test_only_texts_that_look_like_numbers_are_cast(spark):
    df = spark.createDataFrame([("mobile",)], "x string").selectExpr("x", "date'2024-01-01' AS d", "true AS b")
    plan = registry._text_sums("t", df, "name")._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("as double") == plan.count("rlike") == 1


def test_sums_of_numbers_and_texts_in_one_column(spark):
    texts = [*TEXTS, "7", "mobile", "desktop", None]
    df = spark.createDataFrame([(text,) for text in texts], "x string")
    row = registry._text_sums("t", df, "name").first()
    assert (row.non_null, row.checksum) == tuple(_every_cast(df, "x"))
    decimals = df.where("x RLIKE '^[0-9]+$'").selectExpr("CAST(left(x, 20) AS DECIMAL(24,4)) / 7 AS x", "array(x) AS a", "float(left(x, 5)) / 3 AS f")
    rows = {r.column_name: r for r in registry._text_sums("t", decimals, "name").collect()}
    for c in decimals.columns:
        assert (rows[c].non_null, rows[c].checksum) == tuple(_every_cast(decimals, c)), c


def test_sums_of_no_rows(spark):
    df = spark.createDataFrame([], "x string, y double, z date")
    assert [tuple(r) for r in registry._text_sums("t", df, "name").collect()] == [("t", c, 0, None) for c in "xyz"]


def test_hashes_of_texts_are_summed_as_integers(spark):
    df = spark.createDataFrame([("mobile",)], "x string")
    plan = registry._text_sums("t", df, "name")._jdf.queryExecution().analyzed().toString().lower()
    assert "conv(" in plan and plan.count("as decimal(30,6)") == 1
