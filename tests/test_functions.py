import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark.functions import numeric
from tidemark.functions.dates import date_key


def value(spark, column, **literals):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()])
    return row.select(column.alias("v")).first()[0]


@pytest.mark.parametrize("text", ["  Blue Shirt ", "\tTabs\n", " wide ", "", "   ", "inner  gap"])
def test_strip_removes_white_space_of_any_kind(spark, text):
    assert value(spark, tf.strip("t"), t=text) == text.strip()


@pytest.mark.parametrize("text", ["t-shirt", "men's wear", "NAVY blue", "3d print", "a", "", "é tude", "x2y z"])
def test_title_case_starts_a_word_after_every_non_letter(spark, text):
    assert value(spark, tf.title_case("t"), t=text) == text.title()


@pytest.mark.parametrize("text", ["", "  ", "one", " two  words ", "a\tb\nc", "nbsp splits"])
def test_word_count(spark, text):
    assert value(spark, tf.word_count("t"), t=text) == len(text.split())


def test_text_functions_keep_null(spark):
    df = spark.range(1).select(F.lit(None).cast("string").alias("t"))
    assert df.select(tf.strip("t"), tf.title_case("t"), tf.word_count("t"), tf.na_to_null("t")).first() == (None,) * 4


@pytest.mark.parametrize("text", tf.NA_TEXTS)
def test_na_texts_become_null(spark, text):
    assert value(spark, tf.na_to_null("t"), t=text) is None


def test_na_texts_are_exact(spark):
    assert value(spark, tf.na_to_null("t"), t="none") == "none"


def test_row_hash_is_the_md5_of_the_joined_values(spark):
    df = spark.createDataFrame([("Shirts", "Blue", "Casual", 10), ("Jeans", "Red", "Casual", 25)], "a string, b string, c string, q int")
    digests = [r[0] for r in df.select(tf.row_hash(["a", "b", "c", "q"])).collect()]
    assert digests[0] == "f9ff7e103c9602770e2d2644a6336aae" == hashlib.md5(b"Shirts|Blue|Casual|10").hexdigest()
    assert digests[0] != digests[1] and all(len(d) == 32 and d == d.lower() for d in digests)


def test_row_hash_sees_the_place_of_a_null(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), (None, "a", "b")], "x string, y string, z string")
    assert df.select(tf.row_hash(["x", "y", "z"]).alias("h")).distinct().count() == 3


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 2.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(tf.safe_ratio("a", "b")).collect()] == [0.25, 0.0, 0.0, 0.0]


def test_calendar(spark):
    df = spark.sql("SELECT DATE'2024-02-29' AS d").select(*tf.calendar_columns("d"), tf.quarter_start("d").cast("string"),
                                                          tf.month_start("d").cast("string"), date_key("d"))
    assert tuple(df.first()) == (2024, 1, 2, "Thursday", "2024-01-01", "2024-02-01", 20240229)


def test_cents_become_money_without_a_division(spark):
    values = [0, 1, -1, 99, -12345, 10**15 + 7, 9_999_999_999_999_999, None]
    df = spark.createDataFrame([(v,) for v in values], "cents long")
    money = numeric.from_cents("cents")
    assert "/" not in df.select(money)._jdf.queryExecution().analyzed().toString()
    rows = df.select("cents", money.alias("money")).collect()
    assert [r.money for r in rows] == [None if v is None else Decimal(v).scaleb(-2) for v in values]
    assert df.select(money.alias("money")).dtypes == [("money", "decimal(18,2)")]
