"""Records of delimited text whose quoted fields may hold line breaks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialise
from tidemark.sources.splits import FRAGMENT_TYPES, FRAGMENTS, States, by_split, emit, rows_of, stitched, travel

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
#: A field with the separator before it. A quote counts only where a field begins; what follows the closing one is text.
FIELD = rf'(?:^|,)(?:{_QUOTED}"[^,]*+|[^,]*+)'
_OPEN = re.compile(rf'(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+{_QUOTED}\Z')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line that begins inside one, or at the start of a record."""
    if '"' not in line:
        return inside
    return _OPEN.match(f'"{line}' if inside else line) is not None


def cut(lines: Iterator[str], inside: bool) -> Iterator[tuple[str, bool, bool] | str]:
    """Whole records of a split, and its fragments as (text, tail, closed)."""
    held, head = [] if inside else None, inside
    for line in lines:
        inside = ends_inside(line, inside)
        if held is None and not inside:
            yield line
            continue
        held = held or []
        held.append(line)
        if not inside:
            record = "\n".join(held)
            yield (record, False, True) if head else record
            held, head = None, False
    if held:
        yield "\n".join(held), not head, False


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(value): every record of the files, blank ones included, whatever way the files are split.

    Records end at a line feed outside quotes; a carriage return before it goes.
    A quoted field that is still open at the end of a file ends there.
    """
    travel(__name__)
    lines = rows_of(spark, path, "\n")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for (file, block), own in by_split(batches):
                outside, inside = False, True
                for line in own:
                    outside, inside = ends_inside(line, outside), ends_inside(line, inside)
                yield file, block, outside, inside

        return emit({"file": pa.string(), "block": pa.int64(), "outside": pa.bool_(), "inside": pa.bool_()}, each())

    # lines without quotes change nothing
    found = lines.filter(F.col("value").contains('"')).mapInArrow(sums, "file string, block long, outside boolean, inside boolean")
    starts = States.compose(False, found.collect(), lambda state, s: s["inside"] if state else s["outside"])  # one row a split

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = ((r,) for split, own in by_split(batches) for r in cut(own, starts.at(*split)) if isinstance(r, str))
        return emit({"value": pa.string()}, records)

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ((*split, r[1], r[2], None, r[0]) for split, own in by_split(batches)
                 for r in cut(own, starts.at(*split)) if not isinstance(r, str))
        return emit(FRAGMENT_TYPES, parts)

    records = lines.mapInArrow(whole, "value string")
    if starts.changes:
        crossing = materialise(lines.mapInArrow(fragments, FRAGMENTS), "fragments")
        records = records.unionByName(stitched(crossing, "\n").select(F.col("text").alias("value")))
    return records.select(F.regexp_replace("value", r"\r\z", "").alias("value"))
