"""Text expressions. All of them keep NULL as NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts a delimited-file reader takes for a missing value.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space of any kind at both ends (`trim` removes blanks only)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def title_case(c: Column | str) -> Column:
    """Upper-case every letter that does not follow a letter, lower-case the rest.

    `initcap` starts a word after a blank only: it gives `T-shirt` where this
    gives `T-Shirt`.
    """
    words = F.split(F.lower(_col(c)), r"(?<=\P{L})(?=\p{L})")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1))),
        "",
    )


def word_count(c: Column | str) -> Column:
    """Number of runs of non-space characters; 0 for blank text."""
    return F.regexp_count(_col(c), F.lit(r"(?U)\S+"))


def na_to_null(c: Column | str, na_texts: list[str] | None = None) -> Column:
    """NULL for the texts that mean "missing", the text itself otherwise."""
    c = _col(c)
    return F.when(~c.isin(NA_TEXTS if na_texts is None else na_texts), c)
