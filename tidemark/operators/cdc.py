"""Change detection between keyed snapshots, and applying the changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import row_hash
from tidemark.operators.dedupe import first_per_key, latest_per_key
from tidemark.operators.merge import without_keys

# The columns whose content makes a tracked row differ.
TRACKED_COLUMNS = ["articleType", "baseColour", "usage", "stock_qty"]


def snapshot(df: DataFrame, key: str, columns: list[str] | None = None,
             last_by: list[str] | None = None) -> DataFrame:
    """(key, row_hash), the last row winning for a repeated key when `last_by` is given."""
    columns = TRACKED_COLUMNS if columns is None else columns
    hashed = df.filter(F.col(key).isNotNull()).withColumn("row_hash", row_hash(columns))
    if last_by is not None:
        hashed = latest_per_key(hashed.select(key, "row_hash", *[c for c in last_by if c != key]), [key], last_by)
    return hashed.select(key, "row_hash")


def diff_snapshots(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """(key, op): INSERT, UPDATE and DELETE rows; unchanged keys are left out.

    Both snapshots have unique keys, so no key is frequent in this join.
    """
    before = previous.select(key, F.col("row_hash").alias("__before"))
    after = current.select(key, F.col("row_hash").alias("__after"))
    op = (
        F.when(F.col("__before").isNull(), "INSERT")
        .when(F.col("__after").isNull(), "DELETE")
        .when(F.col("__before") != F.col("__after"), "UPDATE")
    )
    return before.join(after, key, "full_outer").select(key, op.alias("op")).filter(F.col("op").isNotNull())


def change_counts(changes: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """One row: inserted, updated, deleted, and the number of tracked keys when `current` is given."""
    counts = changes.agg(*[
        F.count_if(F.col("op") == op).alias(name)
        for op, name in (("INSERT", "inserted_count"), ("UPDATE", "updated_count"), ("DELETE", "deleted_count"))
    ])
    if current is None:
        return counts
    return counts.withColumn("total_tracked", current.agg(F.count(F.lit(1))).scalar())


def change_samples(changes: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first n keys of every kind of change."""
    return first_per_key(changes, ["op"], [key], n)


def apply_changes(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target after deletes and upserts; `changes` has unique keys, `op` and the target's columns."""
    kept = without_keys(target, changes, [key])
    written = changes.filter(F.col("op") != "DELETE").select(*target.columns)
    return kept.unionByName(written)


def change_log(changes: DataFrame, applied_at: Column | None = None) -> DataFrame:
    """Applied changes with the time of application, as `track_changes` appends them to its log."""
    return changes.withColumn("applied_at", F.current_timestamp() if applied_at is None else applied_at)


def counts_by_op(changes: DataFrame) -> DataFrame:
    return changes.groupBy("op").agg(F.count(F.lit(1)).alias("n"))
