"""Paginated collections, read page by page in parallel tasks.

A page reader is any picklable callable `(offset, limit) -> list[dict]`. A page
that cannot be read gives one error row instead of failing the job.
"""

from __future__ import annotations

import json
import sys
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.session import materialise

PageReader = Callable[[int, int], list[dict]]

#: Pages that one task reads one after the other, where there are enough pages for all cores.
TASK_PAGES = 64


class HttpPages:
    """Pages of a JSON collection read by `limit` and `offset` parameters."""

    def __init__(self, url: str, timeout: float = 5.0, **parameters: str):
        self.url, self.timeout, self.parameters = url, timeout, parameters

    def __call__(self, offset: int, limit: int) -> list[dict]:
        query = urllib.parse.urlencode({**self.parameters, "limit": limit, "offset": offset})
        with urllib.request.urlopen(f"{self.url}?{query}", timeout=self.timeout) as answer:
            return json.load(answer)


class StoredPages:
    """Answers of a paged collection that were kept: texts of JSON arrays in the folders page=0, page=1, … of a path.

    As with the collection itself, an empty array is the end; a folder that is not
    there is a page that cannot be read. The path is one that pyarrow's file
    systems open (local and shared folders, HDFS, object stores).
    """

    def __init__(self, path: str):
        self.path = path

    def __call__(self, offset: int, limit: int) -> list[dict]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(self.path)
        rows: list[dict] = []
        for info in files.get_file_info(fs.FileSelector(f"{root}/page={offset // limit}")):
            if info.base_name.startswith("part-"):
                with files.open_input_stream(info.path) as stream:
                    rows += json.loads(stream.read() or b"[]")
        return rows


@dataclass(frozen=True)
class PagedRead:
    """Rows before the first page that could not be read, that page's errors, and whether the end was reached."""

    rows: DataFrame
    errors: DataFrame
    complete: bool

    def require_complete(self) -> DataFrame:
        if not self.complete:
            raise RuntimeError(f"the collection was not read to its end: {self.errors.limit(5).collect()}")
        return self.rows


def read_pages(spark: SparkSession, reader: PageReader, schema: T.StructType, page_size: int = 500,
               wave: int | None = None) -> PagedRead:
    """All rows of a paged collection, up to its first empty page.

    Pages are read in waves, each twice as long as the one before, until a wave
    meets an empty or a failed page. After a failure the rows before it are kept
    and the result is marked as incomplete.
    """
    first, pages = 0, wave or 4 * spark.sparkContext.defaultParallelism
    waves: list[DataFrame] = []
    while True:
        waves.append(fetch_pages(spark, reader, page_size, first, pages))
        stop = waves[-1].filter(F.col("error").isNotNull()).orderBy("page").select("page", "error").first()
        if stop is not None:
            break
        first, pages = first + pages, 2 * pages
    fetched = reduce(DataFrame.unionByName, waves)
    kept = fetched.filter(F.col("row").isNotNull() & (F.col("page") < stop["page"]))
    return PagedRead(kept.select(F.from_json("row", schema).alias("r")).select("r.*"),
                     fetched.filter((F.col("page") <= stop["page"]) & (F.col("error") != "empty")).select("page", "error"),
                     stop["error"] == "empty")


def contiguous_pages(rows: DataFrame, page: str = "page") -> PagedRead:
    """Rows of stored pages 0, 1, 2 … before the first page that is not there; incomplete if later ones are."""
    pages = materialise(rows.select(F.col(page).cast("long").alias("page")).distinct(), "page-numbers")
    following = pages.select((F.col("page") + 1).alias("page")).unionByName(rows.sparkSession.sql("SELECT 0L AS page"))
    gap = following.join(pages, "page", "left_anti").agg(F.min("page")).first()[0]
    complete = pages.filter(F.col("page") > gap).isEmpty()
    errors = rows.sparkSession.createDataFrame([] if complete else [(gap, "missing")], "page long, error string")
    return PagedRead(rows.filter(F.col(page) < gap), errors, complete)


def page_source(reader: PageReader, page_size: int, name: str) -> type[DataSource]:
    """A data source of the columns page, row (JSON) and error, with one partition for each page or for some in a row.

    Its options are `first`, the number of the first page, `pages`, how many, and
    `at_once`, how many a partition has (1). An empty page and one that cannot be
    read give one row each, with an error.
    """
    class Reader(DataSourceReader):
        def __init__(self, first: int, pages: int, at_once: int):
            self.pages, self.at_once = range(first, first + pages), at_once

        def partitions(self) -> list[InputPartition]:
            starts = range(0, len(self.pages), self.at_once)
            return [InputPartition((self.pages[at], len(self.pages[at:at + self.at_once]))) for at in starts]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            first, pages = partition.value
            for page in range(first, first + pages):
                yield from self.read_page(page)

        def read_page(self, page: int) -> Iterator[tuple]:
            try:
                rows = [json.dumps(row) for row in reader(page * page_size, page_size)]
                error = None if rows else "empty"
            except Exception as problem:  # any failure of the remote side becomes data
                rows, error = [], f"{type(problem).__name__}: {problem}"
            for row in rows or [None]:
                yield page, row, error

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "page long, row string, error string"

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Reader(int(self.options.get("first", 0)), int(self.options["pages"]), int(self.options.get("at_once", 1)))

    return Pages


def fetch_pages(spark: SparkSession, reader: PageReader, page_size: int, first: int, pages: int) -> DataFrame:
    """(page, row, error) for every row of `pages` pages, plus one row per failed or empty page."""
    # readers of this module travel with the job, so workers need not have the package installed
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    source = page_source(reader, page_size, f"pages_{uuid.uuid4().hex}")
    spark.dataSource.register(source)
    # starting a task takes longer than reading a stored page
    at_once = min(TASK_PAGES, -(-pages // (4 * spark.sparkContext.defaultParallelism)))
    fetched = spark.read.format(source.name()).options(first=first, pages=pages, at_once=at_once).load()
    # a remote page may answer differently when a task is repeated, so the answers are kept
    return materialise(fetched, "pages")
