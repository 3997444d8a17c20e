"""Text whose records do not end at line ends, read by many tasks.

Spark's text reader cuts a file into splits, and its rows start in one split each.
Whether a row begins inside a quoted field, or how deeply nested it is, depends on
everything before it. So a first pass sums up what each split does to every state
it could begin in; these sums, one row a split, are composed in file order; and
then every task knows the state that each of its splits begins in and cuts records
on its own. A record that crosses a border comes in fragments, which are few (two a
split at most) and are put together by a grouping.

Both passes see the same splits, as they are planned by the same settings.
"""

from __future__ import annotations

import bisect
import sys
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FRAGMENTS = "file string, block long, tail boolean, closed boolean, name string, text string"
Row = tuple[str, int, str]


def rows_of(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, value): rows between separators with the start of their split."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def by_split(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """The rows of each split in order; a task has its splits one after the other."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    for split, own in groupby(rows, key=lambda row: row[:2]):
        yield split, (row[2] for row in own)


class States:
    """The state that a split begins in, from what is known to happen in earlier ones of its file."""

    def __init__(self, initial, changes: dict[str, list[tuple[int, object]]]):
        self.initial, self.changes = initial, changes

    @classmethod
    def compose(cls, initial, sums: Iterable, step: Callable) -> States:
        """`step(state, sum)` is the state after a split; `sums` start with file and block."""
        changes: dict[str, list] = {}
        for file, own in groupby(sorted(sums, key=lambda s: (s[0], s[1])), key=lambda s: s[0]):
            state = initial
            for one in own:
                after = step(state, one)
                if after != state:
                    changes.setdefault(file, []).append((one[1], after))
                state = after
        return cls(initial, changes)

    def at(self, file: str, block: int):
        known = self.changes.get(file)
        place = bisect.bisect_left(known, block, key=lambda change: change[0]) if known else 0
        return known[place - 1][1] if place else self.initial


def emit(columns: dict[str, pa.DataType], rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(columns, held)
            held = []
    yield _batch(columns, held)


def _batch(columns: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    values = list(zip(*rows)) or [[]] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, columns.values())], names=list(columns))


FRAGMENT_TYPES = {"file": pa.string(), "block": pa.int64(), "tail": pa.bool_(), "closed": pa.bool_(), "name": pa.string(),
                  "text": pa.string()}


def stitched(fragments: DataFrame, separator: str) -> DataFrame:
    """(file, block, closed, name, text) of each record that crosses a border, by the split it begins in.

    A record is the tail of one split and the heads of the next ones; `closed` is
    that of its last fragment, `name` the last one known at its beginning.
    """
    order = Window.partitionBy("file").orderBy("block", "tail")  # a few rows for each split of a file
    parts = fragments.withColumn("record", F.sum(F.col("tail").cast("int")).over(order)).withColumn(
        "name", F.last("name", True).over(order)).filter(F.col("text").isNotNull() & (F.col("record") > 0))
    place = F.struct("block", (~F.col("tail")).alias("head"), "text", "closed", "name")
    whole = parts.groupBy("file", "record").agg(F.sort_array(F.collect_list(place)).alias("parts"))
    return whole.select("file", F.col("parts")[0]["block"].alias("block"), F.element_at("parts", -1)["closed"].alias("closed"),
                        F.col("parts")[0]["name"].alias("name"),
                        F.array_join(F.transform("parts", lambda p: p["text"]), separator).alias("text"))


def travel(*modules: str) -> None:
    """Functions of these modules are sent along with the tasks, so workers need not have the package installed."""
    for module in (__name__, *modules):
        cloudpickle.register_pickle_by_value(sys.modules[module])
