import pytest
from conftest import CATALOG, catalog_row
from pyspark.sql import functions as F

from tidemark.operators import clean, combine
from tidemark.operators.profile import exact_median


def catalog(spark, *rows):
    return spark.createDataFrame([r + (i,) for i, r in enumerate(rows)], CATALOG + ", line int")


@pytest.fixture(scope="module")
def dirty(spark):
    return catalog(
        spark,
        catalog_row(1, " Shirt ", 2012),
        catalog_row(2, None, 2012),
        catalog_row(3, "Cap", None, colour=None, season=None, usage=None),
        catalog_row(1, "Shirt again", 2013),
        catalog_row(4, "Old", 1980),
        catalog_row(5, "New", 2027),
        catalog_row(6, "Edge", 1990),
        catalog_row(7, "Edge", 2026),
        catalog_row(8, "Mid", 2013, colour=" Red "),
    )


def test_clean_catalog(dirty, rows):
    cleaned = clean.clean_catalog(dirty, ["line"])
    # the median of 1980 1990 2012 2012 2013 2013 2026 2027 without the unnamed row is 2012.5, cut to 2012
    assert rows(cleaned, "id", "productDisplayName", "year", "baseColour", "season", "usage") == [
        (1, "Shirt", 2012, "Blue", "Fall", "Casual"),
        (3, "Cap", 2013, "Unknown", "Unknown", "Unknown"),
        (6, "Edge", 1990, "Blue", "Fall", "Casual"),
        (7, "Edge", 2026, "Blue", "Fall", "Casual"),
        (8, "Mid", 2013, "Red", "Fall", "Casual"),
    ]


def test_cleaning_report(dirty):
    report = {r[0]: r[1] for r in clean.cleaning_report(dirty, ["line"]).collect()}
    expected = {"rows_before": 9, "missing_productDisplayName": 1, "missing_baseColour": 1, "missing_year": 1,
                "missing_id": 0, "rows_named": 8, "duplicates_removed": 1, "noisy_rows_removed": 2, "rows_after": 5}
    assert {k: report[k] for k in expected} == expected


def test_fill_median_cuts_to_the_column_type(spark, rows):
    df = spark.createDataFrame([(2012,), (2013,), (None,)], "year int")
    assert rows(clean.fill_median(df, "year")) == [(2012,), (2012,), (2013,)]


def test_cleaning_an_empty_table(spark):
    empty = catalog(spark, catalog_row(1)).limit(0)
    assert clean.clean_catalog(empty, ["line"]).count() == 0
    assert {r[0]: r[1] for r in clean.cleaning_report(empty, ["line"]).collect()}["rows_before"] == 0


def test_null_is_outside_every_range(spark):
    df = spark.createDataFrame([(None,), (1989,), (1990,), (2026,), (2027,)], "year int")
    assert [r[0] for r in df.select(clean.outside("year", 1990, 2026)).collect()] == [True, True, False, False, True]
    assert clean.keep_range(df, "year", 1990, 2026).count() == 2


def test_standardise_skips_absent_columns(spark, rows):
    df = spark.createDataFrame([(" t-SHIRT ",)], "a string")
    assert rows(clean.standardise_text(df, ["a", "b"])) == [("T-Shirt",)]


@pytest.mark.parametrize("values", [[3], [1, 2], [5, 1, 3], list(range(100)), [1] * 50 + list(range(49)), [7] * 30,
                                    [1, 1, 1, 9, 9, 9], [0.5, 2.5, 2.5, 10.0]])
def test_exact_median(spark, values):
    import statistics

    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    assert exact_median(df, "v").first()[0] == statistics.median(values)


def test_median_of_nothing_is_null(spark):
    assert exact_median(spark.createDataFrame([(None,)], "v double"), "v").first()[0] is None


def test_combine(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    assert combine.missing_columns(df, ["k", "z", "y"]) == ["y", "z"]
    assert rows(combine.rows_only_in(df, df.filter("k = 2").limit(1))) == [(1, "a"), (2, "b")]
    assert rows(combine.overwrite_where(df, F.col("k") == 1, {"v": F.lit("x")})) == [(1, "x"), (2, "b"), (2, "b")]
    assert rows(combine.add_missing_columns(df, {"k": F.lit(9), "n": F.lit(0)}).distinct()) == [(1, "a", 0), (2, "b", 0)]
    assert rows(combine.union_all([df, df.select("v", "k")]).groupBy("k").count()) == [(1, 2), (2, 4)]
    assert rows(combine.last_rows(df, ["k"], 1)) == [(2, "b")]
