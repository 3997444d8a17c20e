"""Byte-level BPE encoding and decoding with a rank queue.

A text is split by the vocabulary's pattern; a pre-token that is a token as a
whole is done, any other is merged pair by pair: of all neighbouring parts whose
bytes together are a token, the one of least rank goes first, ties from the left.

The pairs wait in a queue made of one bucket per rank, which holds places in the
linked list of parts, and of a bitmap of the ranks whose buckets are not empty.
The bitmap is a hierarchy: a bit of the upper word says that the word below it is
not zero, so the next rank is found by one find-first-set a level. A merge changes
two neighbouring pairs; their old entries stay and are skipped when they come up,
because the place no longer has that rank. A pre-token of n bytes takes O(n)
entries whatever its length, so runs of hundreds of thousands of bytes need no
other path.

There is no shuffle. New pre-tokens of a batch of rows go through one queue
together, each with a stop behind it. A task keeps the ids of the pre-tokens that
it has met, and starts again when it has more than `KEPT` of them, which bounds
memory and changes no result; long ones are not kept.
"""

from __future__ import annotations

import base64
import sys
from bisect import bisect_right
from collections.abc import Iterator
from heapq import heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents
from tidemark.llm.registry import query

KEPT = 400_000        # pre-tokens (and pairs) that a task keeps
KEPT_LENGTH = 64      # characters of the longest of them
TOGETHER = 8_000      # pre-tokens that share a queue
ROWS = 256            # rows of an Arrow batch that are worked on together
WORD_SHIFT = 8        # the bitmap has words of 2 ** WORD_SHIFT ranks
WORD_BITS = 1 << WORD_SHIFT


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    """Token → rank from a file of base64 tokens and ranks; every single byte has to be a token."""
    with open(path or default_ranks(), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the vocabulary lacks single bytes")
    return ranks


class RankQueue:
    """Places by rank. After use it is empty again and can be used again."""

    def __init__(self, n_ranks: int):
        self.buckets: list[list[int]] = [[] for _ in range(n_ranks)]  # heaps, so the leftmost place comes first
        self.words = [0] * ((n_ranks >> WORD_SHIFT) + 1)  # bit r of word w: bucket w * WORD_BITS + r has entries
        self.top = 0                                      # bit w: word w is not zero

    def fill(self, ranks: np.ndarray) -> None:
        """Put every place in, by the rank it has; -1 for none. The queue is empty before."""
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0):]
        found, starts = np.unique(ranks[order], return_index=True)
        places, starts = order.tolist(), starts.tolist()
        for rank, start, end in zip(found.tolist(), starts, [*starts[1:], None]):
            self.buckets[rank] = places[start:end]  # rising, so it is a heap
            self.mark(rank)

    def mark(self, rank: int) -> None:
        """The bucket of this rank has its first entry."""
        word = rank >> WORD_SHIFT
        self.words[word] |= 1 << (rank & WORD_BITS - 1)
        self.top |= 1 << word

    def push(self, rank: int, place: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heappush(bucket, place)
        else:
            bucket.append(place)
            self.mark(rank)

    def least(self) -> int:
        """The least rank with entries, -1 if there is none."""
        if not self.top:
            return -1
        word = (self.top & -self.top).bit_length() - 1
        bits = self.words[word]
        return (word << WORD_SHIFT) + (bits & -bits).bit_length() - 1

    def close(self, rank: int) -> None:
        """The bucket of this rank has become empty."""
        word = rank >> WORD_SHIFT
        self.words[word] &= ~(1 << (rank & WORD_BITS - 1))
        if not self.words[word]:
            self.top &= ~(1 << word)


class Pairs(dict):
    """Rank of two neighbouring parts (left << 32 | right) together, -1 if they are no token; filled on demand."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}

    def __missing__(self, key: int) -> int:
        if len(self) >= KEPT:
            self.clear()
        left, right = self.tokens.get(key >> 32), self.tokens.get(key & 0xFFFFFFFF)
        rank = self[key] = self.ranks.get(left + right, -1) if left and right else -1
        return rank


class BytePairs:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, Pairs(ranks)
        self.tokens = self.pairs.tokens
        self.stop = max(ranks.values()) + 1  # stands behind every pre-token, and is part of no token
        self.by_rank = pa.array([self.tokens.get(rank) for rank in range(self.stop)], pa.large_binary())
        self.queue = RankQueue(self.stop)
        # parts and pairs of single bytes; byte 256 is the stop
        self.first = np.array([*(ranks[bytes([b])] for b in range(256)), self.stop])
        self.first_pairs = np.full((257, 257), -1)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.first_pairs[token[0], token[1]] = rank

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, as bytes of 32-bit integers."""
        whole = [self.ranks.get(piece) for piece in pieces]
        split = [piece for piece, rank in zip(pieces, whole) if rank is None]
        merged = chain.from_iterable(self.merge(split[at:at + TOGETHER]) for at in range(0, len(split), TOGETHER))
        return [next(merged) if rank is None else rank.to_bytes(4, sys.byteorder) for rank in whole]

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Merge pre-tokens through one queue, in which the order within each is the same as alone."""
        if not pieces:
            return []
        stop, pairs, queue = self.stop, self.pairs, self.queue
        mark, buckets = queue.mark, queue.buckets
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        codes = np.full(int(lengths.sum()) + len(pieces), 256)
        codes[np.arange(len(codes) - len(pieces)) + np.repeat(np.arange(len(pieces)), lengths)] = np.frombuffer(b"".join(pieces), np.uint8)
        part: list[int] = self.first[codes].tolist()
        ranks = np.append(self.first_pairs[codes[:-1], codes[1:]], -1)
        queue.fill(ranks)
        waiting: list[int] = ranks.tolist()  # rank of the pair from a place on
        # before the first place comes the last one, a stop
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        while (rank := queue.least()) >= 0:
            # a merge makes longer parts, so no entry of this rank is added meanwhile
            places, buckets[rank], high = buckets[rank], [], rank << 32
            places.sort()
            for at in places:
                if waiting[at] != rank:
                    continue  # stale: the pair has grown or is gone
                gone, left = after[at], before[at]
                then = after[at] = after[gone]
                before[then] = at
                part[at], part[gone], waiting[gone] = rank, -1, -1
                right_rank = waiting[at] = pairs[high | part[then]]
                if right_rank >= 0:
                    if bucket := buckets[right_rank]:
                        heappush(bucket, at)
                    else:
                        bucket.append(at)
                        mark(right_rank)
                left_rank = waiting[left] = pairs[part[left] << 32 | rank]
                if left_rank >= 0:
                    if bucket := buckets[left_rank]:
                        heappush(bucket, left)
                    else:
                        bucket.append(left)
                        mark(left_rank)
                if 0 <= right_rank < rank or 0 <= left_rank < rank:
                    buckets[rank] = places[bisect_right(places, at):]
                    break  # a lower rank has come up
            if not buckets[rank]:
                queue.close(rank)
        ids = np.array(part, np.int32)
        ids = ids[ids >= 0]
        ends = np.flatnonzero(ids == stop)
        data, width = ids.tobytes(), ids.itemsize
        return [data[start:end] for start, end in zip([0, *((ends[:-1] + 1) * width).tolist()], (ends * width).tolist())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_rows(self, rows: pa.ListArray) -> pa.Array:
        """Bytes of each list of ids, NULL for NULL: the tokens of all rows are taken at once, and only cut by row."""
        if rows.null_count:
            # the values behind a NULL row are whatever they are
            found = self.decode_rows(rows.drop_null())
            places = np.cumsum(rows.is_valid().to_numpy(zero_copy_only=False)) - 1
            return found.take(pa.array(places, mask=rows.is_null().to_numpy(zero_copy_only=False)))
        tokens = self.by_rank.take(rows.flatten())
        if tokens.null_count:
            raise KeyError("ids that are no tokens")
        _, token_ends, data = tokens.buffers()
        token_ends = np.frombuffer(token_ends, np.int64)[tokens.offset:tokens.offset + len(tokens) + 1]
        row_ends = rows.offsets.to_numpy()
        ends = token_ends[row_ends - row_ends[0]]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends), data])


class Known:
    """Ids of the pre-tokens met so far, as bytes of 32-bit integers."""

    def __init__(self, model: BytePairs):
        self.model, self.ids = model, {}

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts, which are cut into pre-tokens; those that are new go through the queue together."""
        new = list(set().union(*texts).difference(self.ids))
        self.ids.update(zip(new, self.model.encode_pieces([piece.encode() for piece in new])))
        out = [b"".join(map(self.ids.__getitem__, pieces)) for pieces in texts]
        for piece in new:
            if len(piece) > KEPT_LENGTH:
                del self.ids[piece]
        if len(self.ids) > KEPT:
            self.ids = {}
        return out


def class_differences(pattern: str) -> dict[str, str]:
    """Character classes of `pattern` → the characters that only this process's regex library puts into them.

    Libraries follow different versions of Unicode, and the vocabulary's own
    library decides where a text is cut, so it is asked for all code points.
    """
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single, out = {bytes([b]): b for b in range(256)}, {}
    for name in sorted(set(regex.findall(r"\\p\{\w+\}|\\s", pattern))):
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs = set(probe.decode_bytes(probe.encode_ordinary(every)).decode())
        ours = set(regex.findall(name, every))
        if theirs - ours:
            raise ValueError(f"{name} lacks characters here; use a newer regex library")
        if ours - theirs:
            out[name] = "".join(sorted(ours - theirs))
    return out


class Splitter:
    """Pre-tokens of a text, cut as the vocabulary's own library does."""

    def __init__(self, pattern: str, differences: dict[str, str]):
        self.plain = self.exact = regex.compile(pattern)
        self.newer = frozenset("".join(differences.values()))
        if differences:
            for name, only in differences.items():
                pattern = pattern.replace(name, f"[{name}--[{only}]]")
            self.exact = regex.compile(f"(?V1){pattern}")

    def __call__(self, text: str) -> list[str]:
        plain = text.isascii() or self.newer.isdisjoint(text)
        return (self.plain if plain else self.exact).findall(text)


def encoded(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None,
            id_column: str = "doc_id") -> DataFrame:
    """(doc_id, ids array<int>) of each document.

    NULL and empty texts give an empty list, repeated rows their own result each;
    other columns are left out. Special tokens are ordinary text.
    """
    ranks, pattern = read_ranks(ranks_path), pattern or default_pattern()
    differences = class_differences(pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = Splitter(pattern, differences), Known(BytePairs(ranks))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = known.encode([split(text) if text else [] for text in batch.column(1).to_pylist()])
                ends = np.cumsum([0, *map(len, found)]) // np.int32().nbytes
                ids = pa.ListArray.from_arrays(ends.astype(np.int32), np.frombuffer(b"".join(found), np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_column, "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, "text").mapInArrow(encode, f"{id_column} {kind}, ids array<int>")


def decoded(rows: DataFrame, ranks_path: str | None = None, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, ids, bytes binary) from (doc_id, ids); NULL ids give NULL bytes."""
    ranks = read_ranks(ranks_path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = BytePairs(ranks)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), model.decode_rows(batch.column(1)).cast(pa.binary())],
                                                 names=[id_column, "ids", "bytes"])

    kind = rows.schema[id_column].dataType.simpleString()
    return (rows.select(id_column, F.col("ids").cast("array<int>").alias("ids"))
            .mapInArrow(decode, f"{id_column} {kind}, ids array<int>, bytes binary"))


@query("op11_byte_bpe")
def op11_byte_bpe(spark, sf_dir):
    return decoded(encoded(documents(spark, sf_dir))).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))
