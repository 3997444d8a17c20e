"""Document collections that are one JSON object, read by many tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialise
from tidemark.sources.splits import FRAGMENT_TYPES, FRAGMENTS, States, by_split, emit, rows_of, stitched, travel

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_NAME = re.compile(r'"((?:[^"\\]|\\.)*+)"\s*:\s*\{', re.DOTALL)
_COLLECTION = 2  # depth of braces between the documents of a collection


def change(row: str, in_string: bool) -> tuple[bool, int]:
    """(whether a string is open at the brace that ends the row, change of depth by the row and this brace)."""
    parts = (_ESCAPED.sub("", row) if "\\" in row else row).split('"')
    opened = sum(part.count("{") for part in parts[in_string::2])
    in_string ^= len(parts) % 2 == 0
    return in_string, opened - (not in_string)


def cut(rows: Iterator[str], in_string: bool, depth: int) -> Iterator[tuple[str | None, bool, bool, str | None]]:
    """(text, tail, closed, collection) of every document of a split, in order.

    A whole document has `tail` and `closed` set, a fragment one of them, or none
    if it fills the split. `collection` is given where one begins, and its name is
    not in the text.
    """
    held, tail, start = [], depth <= _COLLECTION and not in_string, depth

    def text(end: str) -> tuple[str, str | None]:
        whole = "}".join(held) + end
        if not tail or start >= _COLLECTION or depth < _COLLECTION:
            return whole, None
        found = _NAME.search(whole)
        if found is None:
            raise ValueError("no name of a collection in front of its first document")
        return whole[found.end():], json.loads(f'"{found[1]}"')

    for row in rows:
        in_string, by = change(row, in_string)
        depth += by
        held.append(row)
        if in_string or depth > _COLLECTION:
            continue
        # this brace closes a document, or what holds documents
        if depth == _COLLECTION:
            whole, name = text("}")
            yield whole, tail, True, name
        elif not tail:
            yield None, False, False, None
        held, tail, start = [], True, depth
    if held:
        whole, name = text("")
        yield whole, tail, False, name


def read_objects(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(text): `"<key>": {…}`, maybe behind a comma, for every document of files {"<table>": {"<key>": {…}, …}, …}.

    A file is cut at closing braces, wherever its lines end, and read by as many
    tasks as its size asks for; the depth of braces at the start of each split
    comes from a pass before. A collection's name has no closing brace. A document
    that a broken file does not close is left out.
    """
    travel(__name__)
    rows = rows_of(spark, path, "}")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for (file, block), own in by_split(batches):
                outside, inside, from_outside, from_inside = False, True, 0, 0
                for row in own:
                    outside, by = change(row, outside)
                    from_outside += by
                    inside, by = change(row, inside)
                    from_inside += by
                yield file, block, outside, from_outside, from_inside

        return emit({"file": pa.string(), "block": pa.int64(), "flips": pa.bool_(), "outside": pa.int64(), "inside": pa.int64()}, each())

    found = rows.mapInArrow(sums, "file string, block long, flips boolean, outside long, inside long").collect()  # one row a split
    starts = States.compose((False, 0), found, lambda state, s: (
        state[0] ^ s["flips"], state[1] + (s["inside"] if state[0] else s["outside"])))

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for split, own in by_split(batches):
                name = None
                for text, tail, closed, begun in cut(own, *starts.at(*split)):
                    name = name if begun is None else begun
                    if not (tail and closed):
                        yield *split, tail, closed, None, text
                if name is not None:
                    yield *split, True, True, name, None  # a mark: what comes behind this split belongs to it

        return emit(FRAGMENT_TYPES, each())

    crossing = materialise(rows.mapInArrow(fragments, FRAGMENTS), "fragments")
    # the collection that each split begins in
    named = crossing.filter("closed AND tail").select("file", "block", "name").collect()  # one row for each split where one begins
    names = States.compose(None, named, lambda _, s: s["name"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for split, own in by_split(batches):
                name = names.at(*split)
                for text, tail, closed, begun in cut(own, *starts.at(*split)):
                    name = name if begun is None else begun
                    if tail and closed and name == table:
                        yield (text,)

        return emit({"text": pa.string()}, each())

    joined = stitched(crossing, "}").filter(F.col("closed") & (F.col("name") == table))
    return rows.mapInArrow(whole, "text string").unionByName(joined.select("text"))
