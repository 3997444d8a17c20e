"""Consecutive row positions without a global window.

Rows are range-partitioned and sorted, written once, and every task's rows get
the number of rows in earlier tasks as an offset. Only one count per task is
ever brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

_TIE, _SLOT, _TASK, _PLACE, _OFFSET = "__tie", "__slot", "__task", "__place", "__offset"
_PLACE_BITS = 33  # monotonically_increasing_id keeps the row number of a task in its low 33 bits


def with_positions(df: DataFrame, order_by: list[Column | str], name: str = "position") -> DataFrame:
    """Add `name` = 1..n in the given order.

    A scan-order tie-breaker is part of the range key, so rows with equal order
    values spread over several tasks.
    """
    columns = df.columns
    tied = df.withColumn(_TIE, F.monotonically_increasing_id())
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by] + [F.col(_TIE)]
    ranged = (
        tied.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(_SLOT, F.monotonically_increasing_id())
        .drop(_TIE)
    )
    fixed = (
        materialise(ranged, "positions", "zstd")  # all rows, and maybe wide ones
        .withColumn(_TASK, F.shiftright(_SLOT, _PLACE_BITS))
        .withColumn(_PLACE, F.col(_SLOT).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
    )
    # one row per task of the previous stage, so the unpartitioned window is over task counts only
    per_task = fixed.groupBy(_TASK).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select(_TASK, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_OFFSET))
    # written, so that their size is known and the rows are not shuffled to meet them
    offsets = materialise(offsets, "offsets")
    return fixed.join(offsets, _TASK).select(
        *columns, (F.col(_OFFSET) + F.col(_PLACE) + 1).cast("long").alias(name)
    )


def surrogate_keys(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Distinct tuples of `columns` numbered 1..n in their natural order, key column first."""
    return with_positions(df.select(*columns).distinct(), columns, name).select(name, *columns)


def ranked(df: DataFrame, by: str, name: str) -> DataFrame:
    """Rank by a column, greatest first, equal values sharing the rank and leaving a gap after it.

    A rank is the first position of its value, found with a grouped minimum.
    """
    df = materialise(df, "ranked")
    first = with_positions(df.select(by), [F.desc_nulls_last(by)], name).groupBy(by).agg(F.min(name).cast("int").alias(name))
    first = materialise(first.withColumnRenamed(by, "__by"), "ranks")
    return df.join(first, F.col(by).eqNullSafe(F.col("__by"))).drop("__by")


def append_with_new_ids(existing: DataFrame, incoming: DataFrame, id_column: str,
                        order_by: list[Column | str]) -> DataFrame:
    """`existing` plus `incoming`, whose ids are replaced by max(id)+1, +2, … in the given order."""
    top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top"))
    position = "__new_position"
    numbered = with_positions(incoming, order_by, position)
    renewed = numbered.withColumn(
        id_column, (F.col(position) + top.scalar()).cast(existing.schema[id_column].dataType)
    ).drop(position)
    return existing.unionByName(renewed.select(*existing.columns))
