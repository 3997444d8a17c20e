"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are cut into pieces of at most the largest length. Pieces are dealt by
hash into shards of a bounded expected size, and each shard is packed in one
task: longest piece first, into the open bin with the least room that is enough.
If none has room, a bin is opened. Its length is chosen then and there: for every
permitted length that holds the piece, the bin is filled from the lengths still to
come (longest that fits first), and the length of least cost per token is opened.
At the end every bin is downsized to the shortest length that holds its contents.
The shard is also packed with one opening length for all bins, once for each
length, and the packing of least total cost is kept.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, documents
from tidemark.llm.registry import query
from tidemark.session import materialise

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence besides its length, in tokens.
OVERHEAD = 32
#: Expected pieces in a shard: what one task holds.
SHARD_PIECES = 20_000
#: Repeated rows are numbered in blocks of this many, so that no array grows with their number.
BLOCK = 10_000
PLACED = ("doc_id long, piece int, start long, length long, bin_id long, bin_size long, bin_offset long, bin_used long")


class Remaining:
    """Lengths still to come: those of a falling list behind the piece that is being placed."""

    def __init__(self, lengths: Sequence[int]):
        self.values, counts = np.unique(np.asarray(lengths, dtype=np.int64), return_counts=True)
        self.values, self.counts = self.values.tolist(), counts.tolist()

    def take(self, length: int) -> None:
        """The next piece is placed; pieces come in falling order, so it is one of the largest value left."""
        self.counts[-1] -= 1
        if not self.counts[-1]:
            self.values.pop()
            self.counts.pop()

    def fill(self, room: int) -> int:
        """Tokens of the lengths that go into `room`, longest first."""
        left, at = room, len(self.values)
        while left > 0 and (at := bisect_right(self.values, left, 0, at) - 1) >= 0:
            left -= min(self.counts[at], left // self.values[at]) * self.values[at]
        return room - left


def least_cost(length: int, remaining: Remaining, capacities: Sequence[int], overhead: int) -> int:
    """The permitted length to open for a piece: least cost per token if filled from what remains; ties: the longest."""
    best = None
    for capacity in capacities[bisect_left(capacities, length):]:
        used = length + remaining.fill(capacity - length)
        rate = (capacities[bisect_left(capacities, used)] + overhead) / used
        if best is None or rate <= best[0]:
            best = rate, capacity
    return best[1]


def best_fit(lengths: Sequence[int], opening: int | None, capacities: Sequence[int],
             overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """Bin of each piece, offset of each piece, used length of each bin; `lengths` fall.

    `opening` is the length of new bins, or None for the one of least cost at each opening.
    """
    remaining = Remaining(lengths) if opening is None else None
    rooms: list[int] = []  # distinct amounts of room of open bins, ascending
    open_bins: dict[int, list[int]] = {}
    bins, offsets, used = [], [], []
    for length in lengths:
        if remaining:
            remaining.take(length)
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            same = open_bins[room]
            b = same.pop()
            if not same:
                del open_bins[room]
                rooms.pop(at)
        else:
            room = (least_cost(length, remaining, capacities, overhead) if remaining
                    else max(opening, capacities[bisect_left(capacities, length)]))
            b = len(used)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += length
        if left := room - length:
            if left not in open_bins:
                insort(rooms, left)
                open_bins[left] = []
            open_bins[left].append(b)
    return bins, offsets, used


def pack(lengths: Sequence[int], capacities: Sequence[int], overhead: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """The cheapest packing of those with a length chosen at each opening and with one length: bins, offsets, used, downsized sizes."""
    best = None
    for opening in (None, *capacities):
        bins, offsets, used = best_fit(lengths, opening, capacities, overhead)
        sizes = [capacities[bisect_left(capacities, u)] for u in used]
        cost = sum(sizes) + overhead * len(sizes)
        if best is None or cost < best[0]:
            best = cost, bins, offsets, used, sizes
    return best[1:]


def pack_pieces(pieces: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD,
                shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Place (doc_id, piece, start, length) rows, 1 <= length <= max(capacities), in bins."""
    capacities = sorted(capacities)
    columns = ["doc_id", "piece", "start", "length", "salt"]
    # rows that repeat everything are counted, numbered and dealt by their number too, so that they spread
    counted = materialise(pieces.groupBy(columns).agg(F.count("*").alias("n")), "pieces")
    shards = max(1, -(-(counted.agg(F.sum("n")).first()[0] or 0) // shard_pieces))
    blocks = counted.withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) div {BLOCK})")))
    copies = blocks.withColumn("copy", F.explode(F.expr(f"sequence(block * {BLOCK}, least(n, (block + 1) * {BLOCK}) - 1)")))
    pieces = copies.select(*columns[:-1], F.xxhash64("salt", "copy").alias("salt"))

    def pack_shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        # the order must not depend on the order in which rows arrive
        rows = rows.sort_values(["length", "doc_id", "piece", "salt"], ascending=[False, True, True, True],
                                kind="stable", na_position="last", ignore_index=True)
        bins, offsets, used, sizes = pack(rows["length"].tolist(), capacities, overhead)
        at = np.asarray(bins)
        rows["bin_id"] = (TaskContext.get().partitionId() << 32) + at
        rows["bin_size"], rows["bin_offset"] = np.asarray(sizes)[at], offsets
        rows["bin_used"] = np.asarray(used)[at]
        yield rows.drop(columns="salt")

    return pieces.repartition(shards, "salt").mapInPandas(pack_shard, PLACED)


def pack_documents(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD,
                   shard_pieces: int = SHARD_PIECES, tokens: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start and length in tokens, and its bin's id, size, use and the offset in it.

    `tokens` is an SQL expression for the number of tokens; by default the words of
    the text and an end mark, so a NULL or empty text takes one token. Every
    document is placed; one longer than the largest length comes in several pieces.
    Rows are dealt by a hash of id, text and, if rows repeat both, their number, so
    copies spread; other columns are not used, and an empty table gives an empty result.
    """
    longest = max(capacities)
    count = F.expr(tokens) if tokens else F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) + 1
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.greatest(count.cast("long"), F.lit(1)).alias("tokens"),
                        F.xxhash64("doc_id", "text").alias("mark"))
    pieces = sized.select("doc_id", "tokens", "mark", F.explode(
        F.expr(f"sequence(0, cast((tokens - 1) div {longest} as int))")).alias("piece"))
    return pack_pieces(pieces.select(
        "doc_id", "piece", (F.col("piece").cast("long") * longest).alias("start"),
        F.least(F.lit(longest).cast("long"), F.col("tokens") - F.col("piece").cast("long") * longest).alias("length"),
        F.xxhash64("mark", "piece").alias("salt")), capacities, overhead, shard_pieces)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir))
