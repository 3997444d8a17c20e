"""Sharding by a consistent-hash ring with virtual nodes and bounded loads. DataFrame operations only.

The ring is divided into `cells`; every shard owns `virtual_nodes` places on it.
A row belongs to the first virtual node clockwise from the hash of its key. No
shard takes more rows than its quota: what overflows continues clockwise to the
next virtual node of a shard with room. Quotas differ by at most one, so row
counts do too, and adding a shard moves little more than the rows it takes.

Which rows overflow needs only the number of rows in each cell, so the walk
around the ring runs over at most `cells` counts; the rows themselves are ranked
inside their cells, by Spark, and looked up in the segments that the walk made.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents
from tidemark.llm.registry import query
from tidemark.session import materialise

SEGMENTS = "cell int, first long, past long, shard int, slot_base long"


def ring(n_shards: int, virtual_nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    places = []
    for shard in range(n_shards):
        for node in range(virtual_nodes):
            digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
            value = int.from_bytes(digest, "big")
            places.append((value % cells, value, shard))
    return [(cell, shard) for cell, _, shard in sorted(places)]


def quotas(n_rows: int, n_shards: int) -> list[int]:
    """Rows for each shard, at most one apart."""
    return [n_rows // n_shards + (shard < n_rows % n_shards) for shard in range(n_shards)]


def walk(counts: dict[int, int], n_shards: int, virtual_nodes: int, cells: int) -> list[tuple[int, int, int, int, int]]:
    """Segments (cell, first rank, rank past the last, shard, slot of the first rank).

    First each cell fills its own shard; then what found no room goes on clockwise.
    """
    places = ring(n_shards, virtual_nodes, cells)
    starts = [cell for cell, _ in places]
    free = quotas(sum(counts.values()), n_shards)
    filled = [0] * n_shards
    segments, waiting = [], []

    def take(cell: int, first: int, past: int, shard: int) -> int:
        n = min(past - first, free[shard])
        if n:
            segments.append((cell, first, first + n, shard, filled[shard]))
            free[shard] -= n
            filled[shard] += n
        return first + n

    for cell in sorted(counts):
        at = bisect_left(starts, cell) % len(places)
        first = take(cell, 0, counts[cell], places[at][1])
        if first < counts[cell]:
            waiting.append((cell, first, at))
    for cell, first, at in waiting:
        while first < counts[cell]:
            at = (at + 1) % len(places)
            first = take(cell, first, counts[cell], places[at][1])
    return segments


def shard_rows(rows: DataFrame, key: list[str], n_shards: int = 8, virtual_nodes: int = 64, cells: int = 1 << 16) -> DataFrame:
    """`rows` with `shard` (0 to n_shards - 1) and `slot` (0 to n - 1 inside a shard).

    `key` are the columns that place a row on the ring. A cell holds about one in
    `cells` of the rows and is ranked in one task: raise `cells` (and so the
    counts that the driver walks) with the table. NULL keys have a place like any
    other; rows equal in all of `key` share a cell; an empty table stays empty.
    Existing columns named `shard` or `slot` are replaced.
    """
    if cells & (cells - 1):
        raise ValueError("cells must be a power of two")
    bits = cells.bit_length() - 1
    mine = ["__place", "__cell"]
    placed = materialise(
        rows.drop("shard", "slot").withColumn("__place", F.xxhash64(*key))
        .withColumn("__cell", F.shiftrightunsigned("__place", 64 - bits).cast("int") if bits else F.lit(0)), "placed")
    counts = {r[0]: r[1] for r in placed.groupBy("__cell").count().collect()}  # at most `cells` rows
    spark = rows.sparkSession
    segments = spark.createDataFrame(walk(counts, n_shards, virtual_nodes, cells), SEGMENTS)
    # equal rows are interchangeable, so the order among them does not matter
    order = Window.partitionBy("__cell").orderBy("__place", *key)
    ranked = placed.withColumn("__rank", F.row_number().over(order) - 1)
    found = ranked.join(segments.withColumnsRenamed({c: f"__s_{c}" for c in segments.columns}), (
        (F.col("__cell") == F.col("__s_cell")) & (F.col("__rank") >= F.col("__s_first")) & (F.col("__rank") < F.col("__s_past"))))
    return found.select(
        *[f"`{c}`" for c in placed.columns if c not in mine], F.col("__s_shard").alias("shard"),
        (F.col("__s_slot_base") + F.col("__rank") - F.col("__s_first")).alias("slot"))


def shard_documents(docs: DataFrame, n_shards: int = 8, **ring_sizes: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document, one per row.

    `size` is the UTF-8 length of the text plus 1; a NULL or empty text has size 1
    and checksum 0. Rows obey the law `rows`: counts of shards are at most one
    apart. A document's place comes from its id, size and checksum, so rows with
    a NULL id or a repeated id spread as well. Other columns are not used.
    """
    rows = docs.select(
        F.col("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return shard_rows(rows, ["doc_id", "size", "text_crc32"], n_shards, **ring_sizes).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op10_sharding")
def op10_sharding(spark, sf_dir):
    return shard_documents(documents(spark, sf_dir))
