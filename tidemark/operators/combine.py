"""Putting tables together and comparing them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame], fill_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def add_missing_columns(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add every absent column with its default; present columns are left alone."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def rows_only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference."""
    return left.exceptAll(right)


def overwrite_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Replace columns in the rows where the condition holds (NULL counts as no)."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def last_rows(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    """The n rows with the greatest order tuple."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order_by]).limit(n)
