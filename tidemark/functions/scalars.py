"""Scalar expressions used by the staging models and marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "LOCAL_ZONE",
    "as_col",
    "to_local",
    "local_date",
    "try_number",
    "text_to_date",
    "regex_first",
    "days_between",
    "within_days",
    "flag",
    "case_label",
    "money",
    "days_before",
    "week_start",
    "month_start",
    "coalesce_diff",
    "replace_text",
]

# Fixed value: the wall-clock zone the staging models convert event times to.
LOCAL_ZONE = "America/Sao_Paulo"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_local(c, zone: str = LOCAL_ZONE, source_zone: str = "UTC") -> Column:
    """Wall-clock time of ``c`` in ``zone``.

    The two-argument form of the models reads the value in the session zone
    (UTC here); the source zone is explicit so the result type follows the
    input (``timestamp_ntz`` stays ``timestamp_ntz``).
    """
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), as_col(c))


def local_date(c, zone: str = LOCAL_ZONE, source_zone: str = "UTC") -> Column:
    """Calendar date of a UTC instant in ``zone``."""
    return F.to_date(to_local(c, zone, source_zone))


def try_number(c) -> Column:
    """Decimal-comma text to double; malformed or empty text gives null.

    ``'12,5' -> 12.5``; ``'1.234,56' -> null`` (two separators after the
    comma is replaced); ``'' -> null``.
    """
    return F.replace(as_col(c).cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def text_to_date(c) -> Column:
    """Text to date, null for text that is not a date (ANSI-safe)."""
    return F.try_to_date(as_col(c).cast("string"))


def regex_first(c, pattern: str) -> Column:
    """First capture group of ``pattern`` in ``c``, null when no match."""
    col = as_col(c)
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, 1))


def days_between(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later`` as an integer."""
    return F.datediff(F.to_date(as_col(later)), F.to_date(as_col(earlier)))


def within_days(start, event, days: int) -> Column:
    """M6: 1 when ``event`` is at most ``days`` days after ``start``, else 0.

    Negative distances (event before start) also give 1; a null distance
    gives 0 — as the cohort flags of the attribution mart do.
    """
    return F.when(days_between(event, start) <= days, F.lit(1)).otherwise(F.lit(0))


def flag(cond: Column) -> Column:
    """Boolean condition as a 0/1 integer (null counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def case_label(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """First matching rule wins; unmatched rows get ``default``."""
    expr = None
    for cond, value in rules:
        val = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def money(c, precision: int = 18, scale: int = 2) -> Column:
    """Money as an exact decimal, so sums do not depend on addition order."""
    return as_col(c).cast(f"decimal({precision},{scale})")


def days_before(c, days: int) -> Column:
    """``c - interval <days> days`` (keeps the timestamp type)."""
    return as_col(c) - F.make_dt_interval(F.lit(days))


def week_start(c) -> Column:
    """Monday of the week of ``c``, as a date."""
    return F.to_date(F.date_trunc("week", as_col(c)))


def month_start(c) -> Column:
    """First day of the month of ``c``, as a date."""
    return F.trunc(F.to_date(as_col(c)), "month")


def coalesce_diff(a, b, default=0) -> Column:
    """``coalesce(a - b, default)`` — 0 when either side is null."""
    return F.coalesce(as_col(a) - as_col(b), F.lit(default))


def replace_text(c, search: str, replacement: str = "") -> Column:
    """Replace every occurrence of literal text."""
    return F.replace(as_col(c), F.lit(search), F.lit(replacement))
