"""Repeated passages by maximal repeats of an enhanced suffix array over anchored suffixes.

A passage is a string of `length` bytes that starts at two or more places, in one
document or several; every byte that such a string covers is removed.

Anchors: of the k-grams inside each window of `length` bytes, the leftmost one of
least hash is the window's anchor. Equal windows have equal anchors at equal
offsets, so only windows that share an anchor need to be compared, and about two
positions in (length - k) are anchors. An anchor owns a run of windows; the bytes
of the run are its block.

1. Anchors that occur once are left out (a count by hash, summed in the tasks).
2. Equal blocks are found by 128 bits of hash: all their windows are repeats.
3. Anchors with different blocks: one occurrence of each block is fetched, and for
   each anchor the suffixes at its occurrences are sorted. A stack scan over the
   common prefixes of neighbours gives the tree of common-prefix intervals; inside
   an interval the occurrences are ordered by what stands to their left, and where
   that differs a repeat is maximal: it goes with all its occurrences.
4. Anchors with more than `hot` different blocks would not fit one task. For these
   every window is hashed instead and windows are counted, which gives the same
   result without bringing the occurrences together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, documents
from tidemark.llm.registry import query

LENGTH, GRAM, HOT = 200, 32, 50_000
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
CHUNK = 1 << 19            # window starts worked on at once
PLACE = 20                 # bits for the place inside a chunk
KEY = ["doc_id", "mark"]   # rows that repeat both id and text share spans, and are each other's copies


# --- anchors ---------------------------------------------------------------------------------------------------------

class Anchors:
    """Finds the anchors of texts for windows of `length` bytes and k-grams of `gram`."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.width = length, gram, length - gram + 1
        n = CHUNK + 2 * length + 2
        self.power, self.inverse = (np.cumprod(np.array([1] + [b] * n, dtype=np.uint64)) for b in (BASE, pow(BASE, -1, 1 << 64)))

    def find(self, text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """Arrays of (first window, last window, anchor, hash of the anchor's k-gram), by stretches of the text."""
        windows = len(text) - self.length + 1
        for at in range(0, windows, CHUNK):
            n = min(CHUNK, windows - at)
            data = np.frombuffer(text, dtype=np.uint8, count=n + self.length - 1, offset=at).astype(np.uint64)
            sums = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * self.inverse[:len(data)])])
            hashes = (sums[self.gram:] - sums[:-self.gram]) * self.power[:len(data) - self.gram + 1]
            hashes ^= hashes >> np.uint64(33)
            hashes *= np.uint64(0xFF51AFD7ED558CCD)
            hashes ^= hashes >> np.uint64(29)
            # the place breaks ties to the left
            place = np.uint64((1 << PLACE) - 1)
            keys = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
            least = (self.sliding_min(keys, n) & place).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            last = np.concatenate([first[1:], [n]]) - 1
            anchor = least[first]
            yield at + first, at + last, at + anchor, hashes[anchor]

    def sliding_min(self, keys: np.ndarray, n: int) -> np.ndarray:
        w = self.width
        padded = np.concatenate([keys, np.full(-len(keys) % w, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, w)
        before = np.minimum.accumulate(padded, axis=1).reshape(-1)
        after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        return np.minimum(after[:n], before[w - 1:w - 1 + n])


# --- maximal repeats -------------------------------------------------------------------------------------------------

def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # equal up to low, different at some place before high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def intervals(heights: list[int], n: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (height, first, past the last) of n sorted suffixes; heights[i] is that of i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i in range(1, n + 1):
        height = heights[i - 1] if i < n else 0
        first = i - 1
        while stack and stack[-1][0] > height:
            above, first = stack.pop()
            yield above, first, i
        if height and (not stack or stack[-1][0] < height):
            stack.append((height, first))


def maximal_repeats(left: list[bytes], right: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes before, bytes after, occurrences) of every repeat through the anchor that is maximal and long enough.

    `left` holds what stands before each occurrence, reversed; `right` what follows.
    """
    order = sorted(range(len(right)), key=right.__getitem__)
    heights = [common(right[a], right[b]) for a, b in zip(order, order[1:])]
    reach = max(map(len, left))
    for after, first, past in intervals(heights, len(order)):
        if after + reach < length:
            continue
        inside = sorted(order[first:past], key=left.__getitem__)
        need = length - after
        depths = [common(left[a], left[b]) for a, b in zip(inside, inside[1:])]
        if need <= 0 and not all(depths):
            yield 0, after, inside
        for before, f, p in intervals(depths, len(inside)):
            # the occurrences differ to the left of this one, so it cannot be extended there
            if before >= need:
                yield before, after, inside[f:p]


def spans_of(members: list[dict], length: int) -> Iterator[tuple[dict, int, int]]:
    """(member, start, end) of what repeats cover in one anchor's members: `block`, its `start`, and the `lead` before the anchor.

    All repeats of a member contain its anchor, so together they cover one run of bytes.
    """
    left = [m["block"][:m["lead"]][::-1] for m in members]
    right = [m["block"][m["lead"]:] for m in members]
    reach: dict[int, tuple[int, int]] = {}
    for before, after, occurrences in maximal_repeats(left, right, length):
        for i in occurrences:
            b, a = reach.get(i, (0, 0))
            reach[i] = max(b, before), max(a, after)
    for i, (before, after) in reach.items():
        at = members[i]["start"] + members[i]["lead"]
        yield members[i], at - before, at + after


# --- distributed -----------------------------------------------------------------------------------------------------

def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, mark, spans array<struct<start, past>>): spans of bytes that repeats cover; they may overlap.

    `docs` has doc_id, mark and text (binary).
    """
    scratch = Scratch(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        finder = Anchors(length, gram)
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(2)[row].as_py() or b""
                for first, last, anchor, hashes in finder.find(text):
                    view, n = memoryview(text), len(first)
                    ends = last + length
                    blocks = b"".join(xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(first.tolist(), ends.tolist()))
                    halves = np.frombuffer(blocks, dtype=np.int64).reshape(n, 2)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(np.full(n, row))), batch.column(1).take(pa.array(np.full(n, row))),
                         pa.array(first), pa.array((anchor - first).astype(np.int32)), pa.array((ends - first).astype(np.int32)),
                         pa.array(hashes.view(np.int64)), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                        names=[*KEY, "start", "lead", "size", "anchor", "b1", "b2"])

    found = scratch.save("anchors", docs.select(*KEY, "text").mapInArrow(
        anchors, f"doc_id {id_type}, mark long, start long, lead int, size int, anchor long, b1 long, b2 long"))
    shared = scratch.save("anchors-shared", found.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("b1").alias("low"), F.max("b1").alias("high"))
        .filter("n > 1").select("anchor", (F.col("low") < F.col("high")).alias("mixed")))
    found = scratch.save("anchors-found", found.join(shared, "anchor"))
    scratch.drop("anchors", "anchors-shared")
    block = ["anchor", "lead", "size", "b1", "b2"]
    # of several occurrences of a block any one will do, but all its columns must come from the same row
    blocks = scratch.save("blocks", found.groupBy(*block, "mixed").agg(
        F.count("*").alias("n"), *(F.first(c).alias(c) for c in (*KEY, "start"))))
    equal = found.join(blocks.filter("n > 1").select(*block), block).select(
        *KEY, "start", (F.col("start") + F.col("size")).alias("past"))
    equal = scratch.save("spans-equal", equal)
    scratch.drop("anchors-found")
    # anchors whose blocks differ, if a block is still in question
    asked = scratch.save("anchors-asked", blocks.filter("mixed").groupBy("anchor").agg(
        F.count("*").alias("members"), F.min("n").alias("least")).filter("least = 1 AND members > 1")
        .select("anchor", (F.col("members") > hot).alias("hot")))
    wanted = blocks.filter("mixed").join(asked, "anchor").groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "lead", "size", "anchor", "n", "hot")).alias("wanted"))
    wanted = scratch.save("blocks-wanted", wanted)
    scratch.drop("blocks", "anchors-asked")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text, places = batch.column(2)[row].as_py(), batch.column(3)[row].as_py()
                n = len(places)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([row] * n)), batch.column(1).take(pa.array([row] * n)),
                     *(pa.array([p[c] for p in places], t) for c, t in (
                         ("start", pa.int64()), ("lead", pa.int32()), ("anchor", pa.int64()), ("n", pa.int64()), ("hot", pa.bool_()))),
                     pa.array([text[p["start"]:p["start"] + p["size"]] for p in places], pa.binary())],
                    names=[*KEY, "start", "lead", "anchor", "n", "hot", "block"])

    own = docs.select("doc_id", "mark", "text").join(
        wanted.select(F.col("doc_id").alias("w_id"), F.col("mark").alias("w_mark"), "wanted"),
        F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("mark") == F.col("w_mark")))
    # a row that repeats id and text would bring its blocks twice
    fetched = own.select(*KEY, "text", "wanted").mapInArrow(
        fetch, f"doc_id {id_type}, mark long, start long, lead int, anchor long, n long, hot boolean, block binary")
    fetched = scratch.save("blocks-fetched", fetched)
    scratch.drop("blocks-wanted")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from batch.to_pylist()

        out = []
        for _, members in groupby(rows(), key=lambda m: m["anchor"]):
            distinct = {(m["doc_id"], m["mark"], m["start"]): m for m in members}
            for member, start, past in spans_of(list(distinct.values()), length):
                if member["n"] == 1:  # the others are covered as a whole
                    out.append((member["doc_id"], member["mark"], start, past))
            if len(out) > 10_000:
                yield spans(out)
                out = []
        yield spans(out)

    ids = docs.schema["doc_id"].dataType

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_type

        columns = list(zip(*rows)) or [()] * 4
        kinds = to_arrow_type(ids), pa.int64(), pa.int64(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[*KEY, "start", "past"])

    schema = f"doc_id {id_type}, mark long, start long, past long"
    partly = fetched.filter("NOT hot").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare, schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for m in batch.to_pylist():
                block = memoryview(m["block"])
                n = len(block) - length + 1
                digests = b"".join(xxhash.xxh3_128_digest(block[i:i + length]) for i in range(n))
                halves = np.frombuffer(digests, dtype=np.int64).reshape(n, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m["doc_id"]] * n, to_type(ids)), pa.array([m["mark"]] * n, pa.int64()), pa.array(m["start"] + np.arange(n)),
                     pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=[*KEY, "start", "h1", "h2"])

    def to_type(kind):
        from pyspark.sql.pandas.types import to_arrow_type

        return to_arrow_type(kind)

    windows = fetched.filter("hot").mapInArrow(hashed, f"doc_id {id_type}, mark long, start long, h1 long, h2 long").distinct()
    windows = scratch.save("windows", windows)
    again = scratch.save("windows-again", windows.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2"))
    whole = windows.join(again, ["h1", "h2"]).select(*KEY, "start", (F.col("start") + length).alias("past"))
    spans_all = equal.unionByName(partly).unionByName(whole)
    out = scratch.save("spans", spans_all.groupBy(*KEY).agg(F.collect_list(F.struct("start", "past")).alias("spans")))
    scratch.drop("spans-equal", "blocks-fetched", "windows", "windows-again")
    return out


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for start, past in sorted((s["start"], s["past"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], past)
        else:
            out.append([start, past])
    return [(a, b) for a, b in out]


def with_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, text as bytes, spans) of every row: all the byte spans that repeats cover.

    A NULL text counts as empty; matches never cross documents; rows that repeat
    others are covered whole if they have `length` bytes. Other columns are not used.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    # of rows that repeat id and text one takes part, so that the work does not grow with the square of their number
    again = Scratch(docs.sparkSession).save("repeated-rows", rows.groupBy(*KEY).count().filter("count > 1").select(
        F.col("doc_id").alias("r_id"), F.col("mark").alias("r_mark")))
    repeats = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("mark") == F.col("r_mark"))
    single = rows.join(again, repeats, "left_anti").unionByName(rows.join(again, repeats, "left_semi").dropDuplicates(KEY))
    spans = repeated_spans(single, length, gram, hot).select(F.col("doc_id").alias("s_id"), F.col("mark").alias("s_mark"), "spans")
    found = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("mark") == F.col("s_mark")), "left").join(again, repeats, "left")
    whole = F.col("r_mark").isNotNull() & (F.length("text") >= length)
    return found.select("doc_id", "text", F.when(whole, F.array(F.struct(
        F.lit(0).cast("long").alias("start"), F.length("text").cast("long").alias("past")))).otherwise(F.col("spans")).alias("spans"))


def removal_digests(docs: DataFrame, **parameters: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                text, runs, at = text.as_py(), merged(spans.as_py()), 0
                kept = hashlib.sha256()
                for start, past in runs:
                    kept.update(text[at:start])
                    at = past
                kept.update(text[at:])
                rows.append((len(text), sum(b - a for a, b in runs), len(runs), kept.hexdigest()))
            columns = list(zip(*rows)) or [()] * 4
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.string()
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = with_spans(docs, **parameters)
    return found.mapInArrow(digest, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, "
                            "n_spans long, kept_sha256 string")


@query("op8_suffix_array_dedup")
def op8_suffix_array_dedup(spark, sf_dir):
    return removal_digests(documents(spark, sf_dir))
