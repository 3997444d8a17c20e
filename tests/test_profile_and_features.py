import pytest
from conftest import CATALOG, catalog_row
from pyspark.sql import functions as F

from tidemark.operators import features, profile


@pytest.fixture(scope="module")
def colours(spark):
    return spark.createDataFrame([("red", 1), ("red", 2), ("blue", 3), (None, None), ("blue", 5), ("red", 6)], "c string, n int")


def test_value_counts(colours, rows):
    assert [tuple(r) for r in profile.value_counts(colours, "c").collect()] == [("red", 3), ("blue", 2)]
    assert rows(profile.value_counts(colours, "c", top=1)) == [("red", 3)]
    assert [r[0] for r in profile.value_counts(colours, "c", by_value=True).collect()] == ["blue", "red"]


def test_shares_sum_to_the_scale(colours):
    assert profile.shares(colours, "c", 100.0).agg(F.sum("share")).first()[0] == pytest.approx(100)


def test_null_counts(colours, rows):
    assert rows(profile.null_counts(colours)) == [("c", 1), ("n", 1)]
    assert rows(profile.null_counts(colours.na.drop(), only_present=True)) == []


def test_cross_table_has_zeroes(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "x")], "r string, c string")
    assert rows(profile.cross_table(df, "r", "c")) == [("a", 2, 0), ("b", 0, 1)]
    assert rows(profile.cross_table(df, "r", "c", ["y"])) == [("a", 0), ("b", 1)]


def test_any_number_of_levels(spark, rows):
    wide = spark.range(3000).selectExpr("id % 2 AS r", "id AS c")
    assert len(profile.levels_of(wide, "c")) == 3000
    assert profile.cross_counts(wide, "r", "c").count() == 3000
    assert len(profile.cross_table(wide.filter("c < 1200"), "r", "c").columns) == 1201


def test_summary_in_one_row_and_in_rows(colours, rows):
    one = profile.summary(colours, ["c"], ["c"], "n").first()
    assert (one["total"], one["unique_c"], one["min_n"], one["max_n"], one["c_counts"]) == (6, 2, 1, 6, {"red": 3, "blue": 2})
    assert ("c", "red", 3) in rows(profile.summary_rows(colours, ["c"], ["c"], "n"))


def test_other_counts(colours):
    assert profile.distinct_count(colours, ["c", "n"]).first() == (2, 5)
    assert profile.distinct_count(colours, ["c"], approximate=True).first() == (2,)
    assert profile.value_range(colours, "n").first() == (1, 6)
    assert profile.conditional_counts(colours, {"big": F.col("n") > 2, "nulls": F.col("c").isNull()}).first() == (3, 1)


def test_engineered_catalogue(spark):
    df = spark.createDataFrame([
        catalog_row(1, "Blue Cotton Shirt", 2012, season="Fall"),
        catalog_row(2, "Cap", 2020, season="Unknown", gender="Women", article="Caps"),
        catalog_row(3, "Red  Shirt", 2016, season="Monsoon"),
        catalog_row(4, "Dress", 2016, season=None),
    ], CATALOG)
    out = features.engineer_catalog(df)
    assert "year" not in out.columns
    got = {r["id"]: r for r in out.collect()}
    one = got[1]
    assert (one["product_age_years"], one["name_length"], one["name_word_count"], one["season_code"]) == (14, 17, 3, 2)
    assert (one["gender_Men"], one["gender_Women"], one["articleType_freq_encoded"]) == (True, False, 0.75)
    assert [got[i]["season_code"] for i in (2, 3, 4)] == [-1, -1, -1]
    assert got[3]["name_word_count"] == 2 and got[2]["articleType_freq_encoded"] == 0.25


def test_frequency_of_null_is_null(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    assert rows(features.frequency_encode(df, "c", "f").distinct()) == [("a", 2 / 3), ("b", 1 / 3), (None, None)]


def test_one_hot_of_null_is_false(spark, rows):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert rows(features.one_hot(df, "c")) == [("a", True), (None, False)]


def test_sparse_vectors_of_a_wide_column(spark, rows, plan):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 10 != 3, F.format_string("level %05d", F.col("id") % 12_000)).alias("c"), F.lit("x").alias("level"))
    found = features.one_hot_sparse(df, "c", "v")
    levels = sorted({f"level {i % 12_000:05d}" for i in range(30_000) if i % 10 != 3})
    assert found.size == len(levels) > 10_000 and found.rows.columns == ["id", "c", "level", "v"]
    assert [r.level for r in found.levels.orderBy("index").collect()] == levels
    place = {level: i for i, level in enumerate(levels)}
    entries = features.vector_entries(found.rows, "v", ["id"]).collect()
    assert len(entries) == 27_000 and all(r.value == 1.0 and r["index"] == place[f"level {r.id % 12_000:05d}"] for r in entries)
    none = found.rows.filter("c IS NULL").first()["v"]
    assert none.size == found.size and none.numNonzeros() == 0
    nothing = features.one_hot_sparse(df.filter("c IS NULL"), "c", "v")
    assert nothing.size == 0 and nothing.rows.count() == 3_000


def test_more_levels_than_can_be_columns_are_an_error(spark):
    wide = spark.range(10_001).select("id", F.col("id").alias("c"))
    with pytest.raises(ValueError, match="c has more than"):
        profile.levels_of(wide, "c")
    with pytest.raises(Exception, match="c has more than"):
        profile.summary(wide, ["c"], ["c"], "id").collect()
    assert profile.summary_rows(wide, ["c"], ["c"], "id").filter("metric = 'c'").count() == 10_001


def test_a_sparse_column_names_no_places_on_the_driver(spark):
    found = features.one_hot_sparse(spark.range(50_000), "id", "v")
    assert len(found.rows.schema["v"].json()) < 1_000
    assert spark.createDataFrame([], found.rows.schema).schema["v"].metadata["ml_attr"]["num_attrs"] == 50_000
