"""Choosing the first source that can be read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_with_fallback(sources: list[tuple[str, Callable[[], DataFrame]]], tag: str = "mode") -> tuple[DataFrame, str]:
    """The first source that opens and gives a row, tagged with its name.

    Each candidate is probed with a one-row read; failures are collected and
    raised together when no source works.
    """
    failures = []
    for name, load in sources:
        try:
            df = load()
            if not df.limit(1).collect():
                raise LookupError("no rows")
            return df.withColumn(tag, F.lit(name)), name
        except Exception as problem:
            failures.append(f"{name}: {type(problem).__name__}")
    raise RuntimeError(f"no source could be read ({'; '.join(failures)})")
