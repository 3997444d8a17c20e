"""Tables whose new content becomes visible in one step.

A write goes to a new folder, its constraints are checked on the files just
written, and only then a small file with the next version number is put in place,
which fails if that version is there already. Readers take the highest version,
so a failed or half-finished job is never seen, and of two writers that start from
the same version one fails.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import temporary

COMMITS = "commits"
BUCKET = "__bucket"
#: Tables are written once and read often.
COMPRESSION = "zstd"


class PublishRejected(Exception):
    """The written rows break a constraint; the table keeps its earlier content."""


class ConcurrentPublish(Exception):
    """Another writer published in between; the table has its content."""


@dataclass
class Constraints:
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)


def repeated_rows(df: DataFrame, keys: list[str]) -> int:
    """Rows beyond the first of each key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]


class PublishedTable:
    """A Parquet table at `root`, replaced, appended to or merged into as a whole.

    With `key`, rows are spread over `buckets` folders by key hash, and a merge
    rewrites only the buckets that the batch touches. The table keeps the key and
    the number of buckets of its first publish.
    """

    def __init__(self, spark: SparkSession, root: str, key: list[str] | None = None, buckets: int = 32,
                 constraints: Constraints | None = None):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self.constraints = constraints or Constraints()

    # versions --------------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list:
        path = self._path(folder)
        files = self._files(path)
        return list(files.listStatus(path)) if files.exists(path) else []

    def _commits(self) -> list:
        found = [s for s in self._names(COMMITS) if s.getPath().getName().startswith("v=")]
        return sorted(found, key=lambda s: s.getPath().getName())

    def state(self) -> dict:
        """Content of the highest version; an empty state before the first publish."""
        commits = self._commits()
        if not commits:
            return {"version": 0, "parts": [], "rows": 0, "schema": None, "marks": {}, "key": self.key, "buckets": self.buckets}
        stream = self._files(commits[-1].getPath()).open(commits[-1].getPath())
        try:
            state = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if self.key is not None and state["key"] != self.key:
            raise ValueError(f"{self.root} has the key {state['key']}, not {self.key}")
        self.key, self.buckets = state["key"], state["buckets"]
        return state

    def _commit(self, state: dict) -> None:
        """Put the state in place as its version, unless that version exists."""
        jvm = self.spark._jvm
        target, draft = self._path(f"{COMMITS}/v={state['version']:012d}.json"), self._path(f"{COMMITS}/draft-{uuid.uuid4().hex}")
        out = self._files(target).create(draft, True)
        try:
            out.write(bytearray(json.dumps(state).encode("utf-8")))
        finally:
            out.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(draft, target, options)
        except Py4JJavaError as problem:
            self._files(draft).delete(draft, False)
            if "FileAlreadyExists" in problem.java_exception.getClass().getName():
                raise ConcurrentPublish(f"{self.root}: version {state['version']} was published by another writer") from None
            raise

    def vacuum(self, keep_seconds: int = 7 * 24 * 3600) -> int:
        """Delete folders that the current version does not use, and older versions, after the given time.

        The time must be longer than any reader or writer of the table runs. Returns the number of folders and files.
        """
        used = {p["path"].split("/")[1] for p in self.state()["parts"]}
        before = (time.time() - keep_seconds) * 1000
        old = [s for s in self._names("data") if s.getPath().getName() not in used]
        old += self._commits()[:-1] + [s for s in self._names(COMMITS) if s.getPath().getName().startswith("draft-")]
        old = [s.getPath() for s in old if s.getModificationTime() <= before]
        for path in old:
            self._files(path).delete(path, True)
        return len(old)

    # reading ---------------------------------------------------------------

    def exists(self) -> bool:
        return self.state()["version"] > 0

    def _read_parts(self, parts: list[dict], schema: T.StructType) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p['path']}" for p in parts])

    def read(self, buckets: list[int] | None = None, since: int = 0) -> DataFrame:
        """Current rows, optionally of some buckets or of versions after `since`."""
        return self._read_state(self.state(), buckets, since)

    def _read_state(self, state: dict, buckets: list[int] | None = None, since: int = 0) -> DataFrame:
        if state["schema"] is None:
            raise FileNotFoundError(f"nothing has been published at {self.root}")
        parts = [p for p in state["parts"] if p["version"] > since]
        if buckets is not None:
            wanted = set(buckets)
            parts = [p for p in parts if p["bucket"] in wanted]
        return self._read_parts(parts, T.StructType.fromJson(state["schema"]))

    # writing ---------------------------------------------------------------

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, version: int) -> list[dict]:
        folder = f"data/v={version}-{uuid.uuid4().hex[:8]}"
        if self.key is None:
            df.write.option("compression", COMPRESSION).parquet(f"{self.root}/{folder}")
            return [{"path": folder, "bucket": None, "version": version}]
        # rebalance splits a bucket that is too large for one task and joins small ones
        placed = df.withColumn(BUCKET, self.bucket_of()).hint("rebalance", F.col(BUCKET))
        placed.write.option("compression", COMPRESSION).partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        base = self._path(folder)
        names = [s.getPath().getName() for s in self._files(base).listStatus(base) if s.isDirectory()]
        return [{"path": f"{folder}/{n}", "bucket": int(n.split("=")[1]), "version": version}
                for n in sorted(names) if n.startswith(BUCKET)]

    def _publish(self, state: dict, df: DataFrame, keep: list[dict], marks: dict | None, part_version: int | None = None,
                 allowed: Callable[[int], bool] | None = None) -> dict:
        """Write `df` next to the kept parts and publish both as the version after `state`.

        Rewritten rows keep a `part_version` of before. Rows in buckets that are not `allowed` reject all.
        """
        version = state["version"] + 1
        parts = self._write(df, part_version or version)
        strange = [p["bucket"] for p in parts if allowed is not None and not allowed(p["bucket"])]
        if strange:
            raise PublishRejected(f"{self.root}: rows outside the buckets to replace, in {strange[:5]}")
        written = self._read_parts(parts, df.schema)
        # counted on the files: a count taken while writing may see a repeated task twice
        nulls = {f"null:{c}": F.count_if(F.col(c).isNull()) for c in self.constraints.not_null}
        facts = [F.count(F.lit(1)).alias("rows"), *[n.alias(k) for k, n in nulls.items()]]
        if self.key is None:
            found = written.agg(*facts).first().asDict()
            parts[0]["rows"] = found["rows"]
        else:
            # one row for each bucket
            per_bucket = [r.asDict() for r in written.groupBy(self.bucket_of().alias("bucket")).agg(*facts).collect()]
            found = {k: sum(r[k] for r in per_bucket) for k in ("rows", *nulls)}
            rows = {r["bucket"]: r["rows"] for r in per_bucket}
            for p in parts:
                p["rows"] = rows[p["bucket"]]
        broken = {k: found[k] for k in nulls if found[k]}
        unique = self.constraints.unique
        if unique and not broken:
            repeated = repeated_rows(written, unique)
            if keep and not repeated:
                # kept rows are unique already, so only the new keys are looked up among them
                kept = self._read_parts(keep, df.schema).select(*unique)
                repeated = kept.join(written.select(*unique), unique, "left_semi").count()
            if repeated:
                broken[f"duplicate:{','.join(unique)}"] = repeated
        if broken:
            raise PublishRejected(f"{self.root}: {broken}")
        parts = keep + (parts if found["rows"] else [])
        new = {
            "version": version,
            "parts": parts,
            "rows": sum(p["rows"] for p in parts),
            "schema": df.schema.jsonValue(),
            "marks": {**state["marks"], **(marks or {})},
            "key": self.key,
            "buckets": self.buckets,
        }
        self._commit(new)
        return {"version": version, "rows_written": found["rows"], "rows_total": new["rows"]}

    def replace(self, df: DataFrame, marks: dict | None = None) -> dict:
        return self._publish(self.state(), df, [], marks)

    def append(self, df: DataFrame, marks: dict | None = None) -> dict:
        state = self.state()
        return self._publish(state, df, state["parts"], marks)

    def replace_buckets(self, df: DataFrame, buckets: list[int], marks: dict | None = None) -> dict:
        """Put the rows of `df` in the place of all rows of these buckets; others keep their files."""
        state, replaced = self.state(), set(buckets)
        return self._publish(state, df, [p for p in state["parts"] if p["bucket"] not in replaced], marks, allowed=replaced.__contains__)

    def compact(self, at_least: int = 8, up_to: int | None = None) -> int:
        """Join small parts of a bucket when there are that many, leaving its rows as they are; returns the parts joined.

        Parts are taken from the smallest on, as long as the next is at most twice
        as large as those before together, so a row is rewritten a logarithmic number
        of times. `up_to` leaves parts of later versions alone.
        """
        state, joined = self.state(), []
        by_bucket: dict = {}
        for part in state["parts"]:
            if up_to is None or part["version"] <= up_to:
                by_bucket.setdefault(part["bucket"], []).append(part)
        for parts in by_bucket.values():
            small, rows = [], 0
            for part in sorted(parts, key=lambda p: p["rows"]):
                if small and part["rows"] > 2 * rows:
                    break
                small.append(part)
                rows += part["rows"]
            if len(small) >= at_least:
                joined += small
        if joined:
            paths = {p["path"] for p in joined}
            self._publish(state, self._read_parts(joined, T.StructType.fromJson(state["schema"])),
                          [p for p in state["parts"] if p["path"] not in paths], None, max(p["version"] for p in joined))
        return len(joined)

    def merge(self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame],
              marks: dict | None = None) -> dict:
        """Replace the touched buckets by `combine(rows of those buckets, batch)`.

        The batch is written once and must have unique keys without NULLs. At most
        `buckets` integers come to the driver.
        """
        state = self.state()
        with temporary(batch, "merge-batch") as rows:
            per_key = rows.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n"))
            missing = F.lit(False)
            for c in self.key:
                missing = missing | F.col(c).isNull()
            n, keys, null_keys, touched = per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(missing), F.collect_set(self.bucket_of())).first()
            if null_keys or n > keys:
                raise PublishRejected(f"{self.root}: {n - keys} repeated keys and {null_keys} keys with NULL in the batch")
            keep = [p for p in state["parts"] if p["bucket"] not in set(touched)]
            old = self._read_state(state, touched) if state["version"] else self.spark.createDataFrame([], rows.schema)
            return {**self._publish(state, combine(old, rows), keep, marks), "rows_in_batch": n}


class RangedTable(PublishedTable):
    """A published table cut by ranges of a date: a replay swaps the ranges it covers in one version.

    `unit` is year, month or day. Rows without a date are rejected.
    """

    _DIGITS = {"year": 4, "month": 6, "day": 8}

    def __init__(self, spark: SparkSession, root: str, column: str, unit: str = "month", constraints: Constraints | None = None):
        constraints = constraints or Constraints()
        super().__init__(spark, root, [column], unit, Constraints([*{column: None, **dict.fromkeys(constraints.not_null)}], constraints.unique))

    def bucket_of(self) -> Column:
        """Number of a row's range, such as 202405."""
        return F.coalesce(self._number(F.date_format(self.key[0], "yyyyMMdd")), F.lit(0))

    def _number(self, day: Column) -> Column:
        return F.left(day, F.lit(self._DIGITS[self.buckets])).cast("int")

    def _ranges(self, first: date, last: date) -> tuple[int, int]:
        return tuple(int(day.strftime("%Y%m%d")[:self._DIGITS[self.buckets]]) for day in (first, last))

    def swap(self, df: DataFrame, first: date, last: date, marks: dict | None = None) -> dict:
        """Put `df` in the place of all rows of the ranges from `first` to `last`, in one version.

        `df` has the whole content of these ranges; rows outside them reject all. If
        anything fails, every range stays as it is.
        """
        state = self.state()
        low, high = self._ranges(first, last)
        keep = [p for p in state["parts"] if not low <= p["bucket"] <= high]
        return {**self._publish(state, df, keep, marks, allowed=lambda b: low <= b <= high),
                "ranges_replaced": len({p["bucket"] for p in state["parts"]} - {p["bucket"] for p in keep})}

    def between(self, first: date, last: date) -> DataFrame:
        """Rows of these days, read from the folders of their ranges."""
        state = self.state()
        low, high = self._ranges(first, last)
        rows = self._read_state(state, [p["bucket"] for p in state["parts"] if low <= p["bucket"] <= high])
        return rows.filter(F.col(self.key[0]).cast("date").between(F.lit(first), F.lit(last)))
