"""Tables of a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None,
                 partitions: int = 1, fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Reader options; with `column` and `bounds` the scan is split into ranges of that column."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if column is not None:
        if bounds is None:
            raise ValueError("a split scan needs the bounds of its column")
        options.update({
            "partitionColumn": column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        })
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **split) -> DataFrame:
    """Filters and column choice are pushed to the database by Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **split)).load()


def key_bounds(spark: SparkSession, url: str, table: str, column: str, **extra: str) -> tuple[int, int]:
    """Smallest and largest key, asked from the database itself."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) AS bounds"
    row = spark.read.format("jdbc").options(**jdbc_options(url, query, **extra)).load().first()
    return row[0], row[1]
