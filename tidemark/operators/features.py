"""Feature columns for a cleaned catalogue."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import word_count
from tidemark.operators.ids import surrogate_keys
from tidemark.operators.profile import levels_of
from tidemark.session import materialise

# Season codes; any other text counts as unknown.
SEASON_CODES = {"Spring": 0, "Summer": 1, "Fall": 2, "Winter": 3, "Unknown": -1}


def ordinal_code(column: str, codes: dict[str, int], unknown: int = -1) -> Column:
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in codes.items()))
    return F.coalesce(F.try_element_at(table, F.col(column)), F.lit(unknown))


def one_hot(df: DataFrame, column: str, levels: list | None = None) -> DataFrame:
    """One boolean column `<column>_<level>` per level; NULL rows are false everywhere. Wide columns: `one_hot_sparse`."""
    levels = levels_of(df, column) if levels is None else levels
    return df.select("*", *[F.coalesce(F.col(column) == v, F.lit(False)).alias(f"{column}_{v}") for v in levels])


@dataclass(frozen=True)
class SparseEncoding:
    """`rows` with the vector column, and the `levels` (index, level) behind its places."""

    rows: DataFrame
    levels: DataFrame
    size: int


def one_hot_sparse(df: DataFrame, column: str, output: str) -> SparseEncoding:
    """One-hot vectors of a column of any width.

    Levels are numbered 0, 1, … in their natural order by a distributed sort, so
    only their number comes to the driver. `output` is a sparse vector of that
    size, as Spark's learning algorithms take it; a NULL has no place set. The
    column's metadata has its size, but no name for each place (Spark's encoder
    makes one, which takes the driver's memory): names are in `levels`.
    """
    levels = materialise(surrogate_keys(df.select(F.col(column).alias("level")).na.drop(), ["level"], "index")
                         .withColumn("index", F.col("index") - 1), "levels")
    size = levels.count()
    at = F.col("__at").cast("string")
    placed = df.join(levels.toDF("__at", "__level"), F.col(column) == F.col("__level"), "left").select(
        *df.columns, _unit_vector(at, size).alias(output, metadata={"ml_attr": {"num_attrs": size}}))
    return SparseEncoding(placed, levels, size)


def _unit_vector(at: Column, size: int) -> Column:
    """Sparse vector with a one at the place `at` (as text), or nowhere if it is NULL; read from JSON, which has a form for it."""
    places = F.coalesce(F.concat(F.lit("["), at, F.lit('],"values":[1.0]')), F.lit('[],"values":[]'))
    text = F.concat(F.lit(f'{{"v":{{"type":0,"size":{size},"indices":'), places, F.lit("}}"))
    return F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]))["v"]


def vector_entries(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """(keep…, index, value): one row for every place that is set in a sparse vector."""
    parts = F.unwrap_udt(column)
    entries = F.arrays_zip(parts["indices"].alias("index"), parts["values"].alias("value"))
    return df.select(*keep, F.inline(entries)).toDF(*keep, "index", "value")


def frequency_encode(df: DataFrame, column: str, output: str) -> DataFrame:
    """Each row gets its value's share of all non-NULL rows.

    The shares are written before the join, so a value that fills much of the
    table can be split over tasks.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n"))
    encoded = materialise(counts.select(
        F.col(column).alias("__value"), (F.col("__n") / total.scalar()).alias(output)
    ), "shares")
    return df.join(encoded, F.col(column) == F.col("__value"), "left").drop("__value")


def text_features(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.withColumns({
        f"{prefix}_length": F.length(column),
        f"{prefix}_word_count": word_count(column),
    })


def engineer_catalog(df: DataFrame, reference_year: int = 2026, gender_levels: list | None = None) -> DataFrame:
    """The engineered catalogue: age, name features, season code, gender columns, article frequency."""
    base = ["id", "gender", "masterCategory", "subCategory", "articleType",
            "baseColour", "season", "usage", "productDisplayName"]
    derived = ["product_age_years", "name_length", "name_word_count", "season_code", "articleType_freq_encoded"]
    levels = levels_of(df, "gender") if gender_levels is None else gender_levels
    aged = df.withColumn("product_age_years", F.lit(reference_year) - F.col("year"))
    coded = text_features(aged, "productDisplayName", "name").withColumn(
        "season_code", ordinal_code("season", SEASON_CODES)
    )
    encoded = frequency_encode(coded, "articleType", "articleType_freq_encoded")
    return one_hot(encoded, "gender", levels).select(*base, *derived, *[f"gender_{v}" for v in levels])
