"""Key look-ups, membership and reference checks, all as joins.

Adaptive execution splits a hot key on the probing side of a join, but only
when the other side enters the join straight from its shuffle. A side that has
to be grouped first is therefore written before it is joined, which also gives
Spark its real size for the choice between broadcast and sort-merge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedupe import latest_per_key
from tidemark.session import materialise


def map_values(df: DataFrame, column: str, lookup: DataFrame, key: str, value: str, output: str,
               last_by: list[str] | None = None, default: Column | None = None) -> DataFrame:
    """Translate `column` through a (key, value) table; unknown keys give NULL or `default`.

    With `last_by` the entry with the greatest such tuple wins for a repeated
    key; without it the keys must be unique already.
    """
    if last_by is not None:
        lookup = materialise(latest_per_key(lookup, [key], last_by), "lookup")
    entries = lookup.select(F.col(key).alias("__key"), F.col(value).alias("__value"))
    joined = df.join(entries, F.col(column) == F.col("__key"), "left")
    result = F.col("__value") if default is None else F.coalesce(F.col("__value"), default)
    return joined.withColumn(output, result).drop("__key", "__value")


def _one_per_key(keys: DataFrame, on: str | list[str], unique: bool) -> DataFrame:
    columns = [on] if isinstance(on, str) else on
    return keys.select(*columns) if unique else materialise(keys.select(*columns).distinct(), "keys")


def keep_keys(df: DataFrame, keys: DataFrame, on: str | list[str], unique: bool = False) -> DataFrame:
    """Rows whose key is in `keys`; pass `unique=True` when no key repeats there."""
    return df.join(_one_per_key(keys, on, unique), on, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: str | list[str], unique: bool = False) -> DataFrame:
    """Rows whose key is not in `keys`; also deletion by key."""
    return df.join(_one_per_key(keys, on, unique), on, "left_anti")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with the number of rows each one affects.

    Grouped before the join: a frequent key travels as one row per task.
    """
    used = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("child_rows"))
    return used.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def orphan_report(relations: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per declared foreign key: (relation, orphan_keys, orphan_rows)."""
    rows = [
        orphans(child, child_key, parent, parent_key).agg(
            F.lit(name).alias("relation"),
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphan_rows"),
        )
        for name, child, child_key, parent, parent_key in relations
    ]
    return reduce(DataFrame.unionByName, rows)
