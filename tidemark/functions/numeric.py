"""Numeric expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_TOTAL = "decimal(38,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(amount: Column | str) -> Column:
    """A floating amount as whole cents; far cheaper per row than a cast to decimal."""
    return F.rint(_col(amount).cast("double") * 100).cast("long")


def from_cents(c: Column | str) -> Column:
    """Whole cents as money; a product, as a division of decimals takes several times as long and gives the same."""
    return (_col(c).cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def revenue_sum(df: DataFrame) -> Column:
    """Exact sum of a table's revenue, whatever the row order.

    Sales lines carry `revenue_cents`; fact tables and sub-totals carry a
    decimal `revenue`.
    """
    if "revenue_cents" in df.columns:
        return (F.sum(F.col("revenue_cents").cast("decimal(18,0)")) / 100).cast(MONEY_TOTAL)
    return F.sum("revenue").cast(MONEY_TOTAL)


def safe_ratio(numerator: Column | str, denominator: Column | str, default: float = 0.0) -> Column:
    """numerator / denominator, or `default` where the quotient does not exist."""
    return F.coalesce(F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double")), F.lit(default))
