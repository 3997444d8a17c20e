"""Counts, shares and summaries of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise


def value_counts(df: DataFrame, column: str, top: int | None = None, by_value: bool = False) -> DataFrame:
    """Rows per value without the NULL group, most frequent first (ties by value)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(column) if by_value else counts.orderBy(F.desc("n"), column)
    return ordered if top is None else ordered.limit(top)


def shares(df: DataFrame, column: str, scale: float = 1.0, name: str = "share") -> DataFrame:
    """value_counts plus each value's part of the total (scale=100 for percent)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.withColumn(name, F.lit(scale) * F.col("n") / total.scalar())


def null_counts(df: DataFrame, columns: list[str] | None = None, only_present: bool = False) -> DataFrame:
    """(column, nulls), all columns in one pass."""
    columns = columns or df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = counted.unpivot([], columns, "column_name", "nulls")
    return rows.filter(F.col("nulls") > 0) if only_present else rows


def distinct_count(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """One row with the number of distinct non-NULL values of each column.

    Exact counts take each column's own distinct set, so no row is copied once per column.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in columns])
    counts = [df.select(c).distinct().agg(F.count(c)) for c in columns]
    return df.sparkSession.range(1).select(*[n.scalar().alias(c) for c, n in zip(columns, counts)])


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


#: Levels that may become columns or entries of one map.
MOST_LEVELS = 10_000


def levels_of(df: DataFrame, column: str, at_most: int = MOST_LEVELS) -> list:
    """Sorted distinct non-NULL values of a column that is about to become columns.

    They come to the driver, as they become names in the schema; more than
    `at_most` are an error. A column of any width belongs in rows (`cross_counts`,
    `summary_rows`, `frequency_encode`) or sparse vectors (`one_hot_sparse`).
    """
    found = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(at_most + 1).collect()
    if len(found) > at_most:
        raise ValueError(f"{column} has more than {at_most} levels")
    return sorted(r[0] for r in found)


def cross_counts(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Counts of every pair (row value, column value) that occurs, in rows."""
    present = df.filter(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return present.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n"))


def cross_table(df: DataFrame, rows: str, columns: str, levels: list | None = None) -> DataFrame:
    """Counts of every (row value, column value), 0 where the pair does not occur, one column per level."""
    levels = levels_of(df, columns) if levels is None else levels
    # counting pairs first leaves one row per pair for the pivot
    pairs = cross_counts(df, rows, columns)
    return pairs.groupBy(rows).pivot(columns, levels).agg(F.sum("n")).na.fill(0)


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row `median`: the exact median, as the mean of the two middle values.

    Values are counted, the counts range-partitioned, and the tasks' totals tell
    which one or two tasks hold the middle; only their counts are then summed up in
    order. The values are taken by position.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    counts = materialise(values.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    ranged = materialise(counts.repartitionByRange("v").withColumn("task", F.spark_partition_id()), "value-ranges")
    # one row per task of the range partitioning
    tasks = sorted(ranged.groupBy("task").agg(F.min("v"), F.sum("n")).collect(), key=lambda r: r[1])
    total = sum(r[2] for r in tasks)
    if not total:
        return spark.range(1).select(F.lit(None).cast("double").alias("median"))
    below, found = 0, []
    for task, _, n in tasks:
        wanted = [r - below for r in sorted({(total - 1) // 2, total // 2}) if below <= r < below + n]
        if wanted:
            upto = F.sum("n").over(Window.partitionBy("task").orderBy("v"))
            running = ranged.filter(F.col("task") == task).withColumn("upto", upto)
            found += running.filter(reduce(Column.__or__, [
                (F.col("upto") > r) & (F.col("upto") - F.col("n") <= r) for r in wanted])).select("v", "n", "upto").collect()
        below += n
    # at most two values; the same one twice if it covers both places
    middle = [r["v"] for r in found]
    return spark.range(1).select(F.lit(sum(middle) / len(middle)).alias("median"))


def summary(df: DataFrame, distinct: list[str], counted: list[str], range_column: str) -> DataFrame:
    """One row: total, distinct counts, value-count maps and the range of one column.

    A map has an entry for every value, and more than `MOST_LEVELS` are an error:
    columns of any width belong in `summary_rows`.
    """
    total = df.agg(F.count(F.lit(1)).alias("total"), F.min(range_column).alias(f"min_{range_column}"),
                   F.max(range_column).alias(f"max_{range_column}"))
    unique = {f"unique_{c}": df.select(c).distinct().agg(F.count(c)).scalar() for c in distinct}
    maps = {}
    for c in counted:
        counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        entries = F.collect_list(F.struct(c, "n"))
        maps[f"{c}_counts"] = counts.limit(MOST_LEVELS + 1).agg(F.map_from_entries(F.when(F.size(entries) <= MOST_LEVELS, entries).otherwise(
            F.raise_error(F.lit(f"{c} has more than {MOST_LEVELS} values"))))).scalar()
    return total.withColumns(unique | maps)


def summary_rows(df: DataFrame, distinct: list[str], counted: list[str], range_column: str) -> DataFrame:
    """The same summary in rows (metric, value, n) for columns of any width."""
    single = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.min(range_column).cast("long").alias(f"min_{range_column}"),
        F.max(range_column).cast("long").alias(f"max_{range_column}"),
    )
    unique = {f"unique_{c}": df.select(c).distinct().agg(F.count(c)).scalar() for c in distinct}
    single = single.withColumns(unique)
    frames = [single.unpivot([], single.columns, "metric", "n").select("metric", F.lit(None).cast("string").alias("value"), "n")]
    for c in counted:
        counts = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value"))
        frames.append(counts.agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("metric"), "value", "n"))
    return reduce(DataFrame.unionByName, frames)
