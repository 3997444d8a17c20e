"""Upsert and targeted repair as set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedupe import latest_per_key


def without_keys(target: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `target` whose key is not in `other`; NULL keys are equal to each other."""
    mine = other.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return target.join(mine, same, "left_anti")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], last_by: list[str] | None = None) -> DataFrame:
    """Rows of `batch` replace or extend `target`; NULL keys are equal to each other.

    A written batch has a known size: Spark broadcasts a small one, so the
    target streams through without a shuffle, and sort-merge joins a large one.
    """
    if last_by is not None:
        batch = latest_per_key(batch, keys, last_by)
    kept = without_keys(target, batch, keys)
    return kept.unionByName(batch.select(*target.columns))


def backfill(target: DataFrame, bad: Column, truth: DataFrame, key: str, columns: list[str],
             flag: str = "backfilled") -> DataFrame:
    """Replace `columns` of bad rows by the source of truth and flag them.

    Only bad rows take part in the join; a bad key that the truth lacks stays
    as it was.
    """
    is_bad = F.coalesce(bad, F.lit(False))
    if flag not in target.columns:
        target = target.withColumn(flag, F.lit(False))
    correct = truth.select(key, F.lit(True).alias("__found"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = target.filter(is_bad).join(correct, key, "left")
    found = F.coalesce(F.col("__found"), F.lit(False))
    fixed = joined.withColumns({
        **{c: F.when(found, F.col(f"__{c}")).otherwise(F.col(c)) for c in columns},
        flag: found | F.col(flag),
    })
    return target.filter(~is_bad).unionByName(fixed.select(*target.columns))


def backfill_report(before: DataFrame, after: DataFrame, bad: Column, flag: str = "backfilled") -> DataFrame:
    """One row: bad rows found, rows repaired, bad rows left."""
    is_bad = F.coalesce(bad, F.lit(False))
    found = before.agg(F.count_if(is_bad).alias("n"))
    return after.agg(
        F.count_if(F.col(flag)).alias("rows_backfilled"),
        F.count_if(is_bad).alias("remaining_bad_rows"),
    ).withColumns({
        "corrupted_rows_detected": found.scalar(),
        "backfill_successful": F.col("remaining_bad_rows") == 0,
    })
