"""Row filters (P9-P12). Each returns the filtered DataFrame; the predicate
is a plain Catalyst expression, so it is pushed into parquet scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import as_col

__all__ = ["keep", "keep_in", "keep_like", "keep_null", "keep_not_null", "keep_true"]


def keep(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Rows where ``predicate`` is true (null counts as false)."""
    return df.where(predicate)


def keep_in(df: DataFrame, column, values: Iterable, negate: bool = False) -> DataFrame:
    """P10: ``column [not] in (values)``; a null column value drops the row
    either way, as in SQL."""
    cond = as_col(column).isin(list(values))
    if negate:
        cond = ~cond
    return df.where(cond)


def keep_like(df: DataFrame, column, pattern: str, negate: bool = False,
              null_as: str | None = None) -> DataFrame:
    """SQL ``like``; ``null_as`` guards nulls (``coalesce(c, '')``) so a
    ``not like`` keeps rows whose value is null."""
    col = as_col(column)
    if null_as is not None:
        col = F.coalesce(col, F.lit(null_as))
    cond = col.like(pattern)
    return df.where(~cond if negate else cond)


def keep_null(df: DataFrame, column) -> DataFrame:
    """``column is null``."""
    return df.where(as_col(column).isNull())


def keep_not_null(df: DataFrame, column) -> DataFrame:
    """``column is not null``."""
    return df.where(as_col(column).isNotNull())


def keep_true(df: DataFrame, column) -> DataFrame:
    """``column is true`` (null is not true)."""
    return df.where(as_col(column).eqNullSafe(F.lit(True)))
