"""Reproducible samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ids import with_positions
from tidemark.session import materialise


def sample_rows(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, chosen by a seeded digest of the key.

    The choice depends on keys and seed only, not on partitioning, so a lost
    task recomputes the same rows. Every task keeps its n smallest digests, and
    only these are ordered together.
    """
    digest = "__digest"
    marked = df.withColumn(digest, F.md5(F.concat_ws(":", F.lit(seed), *keys)))
    return marked.orderBy(digest, *keys).limit(n).drop(digest)


def sample_with_replacement(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows, each drawn from all rows; `draw` numbers them 1..n.

    Draw i takes the row at a position that is a seeded digest of i, counting rows
    in the order of their keys, which are unique and not NULL. So the sample depends
    on keys and seed only, and a larger one begins with a smaller one. Keys are put
    in order and counted by ranges; of the rows only the drawn ones are moved. An
    empty table gives no rows.
    """
    placed = materialise(with_positions(df.select(*keys), keys, "__place"), "placed")
    total = placed.count()
    # 60 bits of a digest, so that places differ in probability by under 2 ** -20 for up to 2 ** 40 rows
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "id").cast("binary")), 1, 15), 16, 10).cast("long") % F.lit(max(total, 1)) + 1
    draws = df.sparkSession.range(1, n + 1 if total else 1).select(F.col("id").alias("draw"), place.alias("__place"))
    drawn = materialise(placed.join(draws, "__place").drop("__place"), "draws")
    return df.join(drawn, keys)


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42, replacement: bool = False) -> DataFrame:
    return df.sample(withReplacement=replacement, fraction=fraction, seed=seed)
