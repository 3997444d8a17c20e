"""Content hashes computed by built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARKER = "\\N"


def _joined(columns: list[str], separator: str, null_marker: str) -> Column:
    # concat_ws skips NULLs, so (a, NULL, b) would equal (a, b) without a marker
    return F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit(null_marker)) for c in columns])


def row_hash(columns: list[str], separator: str = "|", null_marker: str = NULL_MARKER) -> Column:
    """MD5 hex digest of the listed columns joined by `separator`."""
    return F.md5(_joined(columns, separator, null_marker))


def event_digest(columns: list[str]) -> Column:
    """Event id that depends on content only, so encoding the same rows again gives the same ids."""
    return F.sha2(_joined(columns, "\u001f", NULL_MARKER), 256)
