"""Scalar column expressions (all JVM-side built-ins, codegen-friendly)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmart.schemas import INCENTIVE_RATE, MART_MONEY, MONEY


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sales_month(date_col: str | Column = "sales_date") -> Column:
    """``yyyy-MM`` text of a date; same value as ``substring(date, 1, 7)``."""
    return F.date_format(col_of(date_col), "yyyy-MM")


def full_name(first: str | Column, last: str | Column) -> Column:
    """``first || ' ' || last``; NULL when either part is NULL."""
    return F.concat(col_of(first), F.lit(" "), col_of(last))


def money(c: str | Column) -> Column:
    """Exact money type used for every sum (decimal, not float)."""
    return col_of(c).cast(MONEY)


def mart_money(c: str | Column) -> Column:
    """Money as the database table's DECIMAL(10,2); overflow raises under ANSI."""
    return col_of(c).cast(MART_MONEY)


def incentive(total: str | Column, is_top: str | Column) -> Column:
    """1 % of the month's total for the store's best seller, else 0 (HALF_UP)."""
    rate = F.lit(Decimal(INCENTIVE_RATE))
    paid = F.round(col_of(total) * rate, 2)
    return F.when(col_of(is_top), paid).otherwise(F.lit(Decimal("0.00"))).cast(MONEY)


def base_name(path: str | Column) -> Column:
    """Last path segment of a file path or URI."""
    return F.element_at(F.split(col_of(path), "/"), -1)


def split_name(name: str | Column, part: int) -> Column:
    """Part ``part`` (1-based) of a ``Word#number`` style name."""
    return F.split_part(col_of(name), F.lit("#"), F.lit(part))
