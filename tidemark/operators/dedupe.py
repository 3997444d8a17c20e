"""Distinct and duplicate handling.

Spark turns `row_number() <= k` into a per-task group limit before the shuffle
(`WindowGroupLimit`), so a key that holds a large share of all rows sends at
most k rows per task to the task that owns the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: list[str], order_by: list[Column | str], n: int = 1) -> DataFrame:
    """The first `n` rows of every key in the given order. NULL keys form one group."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) <= n).drop(_RANK)


def latest_per_key(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the greatest `version` tuple of every key."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in version])


def first_per_key_in_file(df: DataFrame, keys: list[str], order_by: list[Column | str],
                          file_column: str = "source_file") -> DataFrame:
    """Keep-first inside each source file; a key shared by two files stays twice."""
    return first_per_key(df, [file_column, *keys], order_by)


def content_key(columns: list[str]) -> Column:
    """SHA-256 of the columns: a short key for wide values.

    Keying on it sends 64 characters per row through the shuffle and the sorts
    instead of whole texts. NULL differs from every text.
    """
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: number of rows beyond the first of each key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"))


def distinct_tuples(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_values(df: DataFrame, column: str, ordered: bool = True) -> DataFrame:
    values = df.select(column).distinct()
    return values.orderBy(column) if ordered else values
