"""Row cleaning: missing values, text, ranges, and the catalogue recipe built from them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import strip, title_case
from tidemark.operators.dedupe import first_per_key
from tidemark.operators.profile import exact_median


def drop_null_rows(df: DataFrame, required: list[str]) -> DataFrame:
    return df.na.drop(subset=required)


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


def fill_median(df: DataFrame, column: str, statistics_from: DataFrame | None = None) -> DataFrame:
    """NULL becomes the median, cut to the column's type as a cast does."""
    median = exact_median(df if statistics_from is None else statistics_from, column)
    kind = df.schema[column].dataType
    return df.withColumn(column, F.coalesce(F.col(column), median.scalar().cast(kind)))


def keep_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows inside the closed range; NULL is outside."""
    return df.filter(F.col(column).between(low, high))


def outside(column: str, low, high) -> Column:
    """True for values out of the closed range and for NULL."""
    return ~F.coalesce(F.col(column).between(low, high), F.lit(False))


def strip_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: strip(c) for c in columns if c in df.columns})


def standardise_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Strip and title-case the listed columns that exist."""
    return df.withColumns({c: title_case(strip(c)) for c in columns if c in df.columns})


@dataclass(frozen=True)
class CatalogRules:
    """What the catalogue recipe does to which column."""

    key: str = "id"
    required: list[str] = field(default_factory=lambda: ["productDisplayName"])
    unknown: list[str] = field(default_factory=lambda: ["baseColour", "season", "usage"])
    unknown_text: str = "Unknown"
    median: str = "year"
    texts: list[str] = field(default_factory=lambda: [
        "gender", "masterCategory", "subCategory", "articleType",
        "baseColour", "season", "usage", "productDisplayName",
    ])
    valid_range: tuple[int, int] = (1990, 2026)


def _repair_rows(df: DataFrame, rules: CatalogRules) -> DataFrame:
    return repair(drop_null_rows(df, rules.required), rules)


def repair(df: DataFrame, rules: CatalogRules | None = None) -> DataFrame:
    """Gaps filled and texts stripped in all rows; none is dropped."""
    rules = rules or CatalogRules()
    filled = fill_constants(df, {c: rules.unknown_text for c in rules.unknown})
    return strip_columns(fill_median(filled, rules.median), rules.texts)


def clean_catalog(df: DataFrame, order_by: list[Column | str], rules: CatalogRules | None = None) -> DataFrame:
    """Drop unnamed rows, fill gaps, strip text, keep the first row per key, keep the valid range."""
    rules = rules or CatalogRules()
    repaired = _repair_rows(df, rules)
    return keep_range(first_per_key(repaired, [rules.key], order_by), rules.median, *rules.valid_range)


def cleaning_report(df: DataFrame, order_by: list[str], rules: CatalogRules | None = None) -> DataFrame:
    """(metric, value) rows: sizes before and after, missing values, removed rows.

    One grouped pass: per key the number of rows and the range check of the
    first row decide everything the recipe removes.
    """
    rules = rules or CatalogRules()
    before = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in df.columns],
    )
    repaired = _repair_rows(df, rules)
    first = F.min(F.struct(*order_by, outside(rules.median, *rules.valid_range).alias("noisy")))
    per_key = repaired.groupBy(rules.key).agg(F.count(F.lit(1)).alias("n"), first["noisy"].alias("noisy"))
    after = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_named"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if("noisy").alias("noisy_rows_removed"),
        F.count_if(~F.col("noisy")).alias("rows_after"),
    )
    return before.unpivot([], before.columns, "metric", "value").unionByName(
        after.unpivot([], after.columns, "metric", "value")
    )
