"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_name(c: Column | str) -> Column:
    return F.date_format(_col(c), "EEEE")


def quarter_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "quarter")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def date_key(c: Column | str) -> Column:
    """yyyymmdd as an integer: a time key that needs no look-up."""
    c = _col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def days_between(first: Column | str, last: Column | str) -> Column:
    """All days from the first to the last, as an array to explode."""
    return F.sequence(_col(first), _col(last), F.expr("INTERVAL 1 DAY"))


def calendar_columns(c: Column | str) -> list[Column]:
    c = _col(c)
    return [
        F.year(c).alias("year"),
        F.quarter(c).alias("quarter"),
        F.month(c).alias("month"),
        day_name(c).alias("day_of_week"),
    ]
