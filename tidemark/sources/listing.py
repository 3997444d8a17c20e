"""Filtered pages and key look-ups over a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ids import with_positions
from tidemark.sinks.published import PublishedTable

DEFAULT_PAGE, LARGEST_PAGE = 100, 5000


def list_page(df: DataFrame, key: str, limit: int = DEFAULT_PAGE, offset: int = 0, **equals) -> DataFrame:
    """One page in key order. Only given filters apply; deep pages are cheaper with `list_after`."""
    _check_limit(limit)
    return _filtered(df, equals).orderBy(key).offset(offset).limit(limit)


def list_after(df: DataFrame, key: str, last_key=None, limit: int = DEFAULT_PAGE, **equals) -> DataFrame:
    """The page that follows `last_key`; the key filter reaches the scan."""
    _check_limit(limit)
    rows = _filtered(df, equals)
    if last_key is not None:
        rows = rows.filter(F.col(key) > last_key)
    return rows.orderBy(key).limit(limit)


def find_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Every requested key with its row; `found` is false for a key the table lacks."""
    present = df.withColumn("found", F.lit(True))
    return keys.join(present, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def page_borders(df: DataFrame, key: str, every: int = 100_000) -> DataFrame:
    """(position, key) of every so many rows in the order of a unique key, to be kept with the table."""
    return with_positions(df.select(key), [key], "position").filter(
        (F.col("position") - 1) % every == 0).select("position", key)


def page_between_borders(df: DataFrame, borders: DataFrame, key: str, limit: int = DEFAULT_PAGE, offset: int = 0) -> DataFrame:
    """The page of `list_page` at any depth, read from the range of keys between two borders.

    Two border rows are looked up; the range reaches the scan as a filter, and at
    most as many rows as lie between borders are passed over.
    """
    _check_limit(limit)
    low = borders.filter(F.col("position") <= offset + 1).orderBy(F.desc("position")).select("position", key).first()
    high = borders.filter(F.col("position") > offset + limit).orderBy("position").select(key).first()
    if low is not None:
        df, offset = df.filter(F.col(key) >= low[1]), offset + 1 - low[0]
    if high is not None:
        df = df.filter(F.col(key) < high[0])
    return df.orderBy(key).offset(offset).limit(limit)


def find_published(table: PublishedTable, keys: DataFrame) -> DataFrame:
    """As `find_keys` for a published table: only the buckets that the requested keys fall in are read."""
    version = table.state()["version"]
    if not version:
        raise FileNotFoundError(f"nothing has been published at {table.root}")
    touched = [r[0] for r in keys.select(table.bucket_of()).distinct().collect()]  # at most as many as there are buckets
    present = table.read(touched).withColumn("found", F.lit(True))
    return keys.join(present, table.key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def _check_limit(limit: int) -> None:
    if not 0 <= limit <= LARGEST_PAGE:
        raise ValueError(f"limit must be between 0 and {LARGEST_PAGE}")


def _filtered(df: DataFrame, equals: dict) -> DataFrame:
    for column, value in equals.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df
