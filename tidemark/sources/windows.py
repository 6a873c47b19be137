"""Windows of equal load (IO4): bounds at exact row ranks instead of fixed hours.

A feed whose rate changes by the hour makes fixed windows uneven; here every
window of a plan holds about the same number of rows. The bounds are exact
quantiles of the time column, found by histograms that get finer around each
bound: every pass is one aggregate with map-side combine over the time column
alone, and the driver gets at most ``BUCKETS`` counts a pass.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 65_536  # counts that one pass brings to the driver
_EPOCH = datetime(1970, 1, 1)
_US = timedelta(microseconds=1)


def wall_clock(df: DataFrame, column: str) -> Column:
    """The column as a time without a zone (the session's zone for a zoned one)."""
    return F.col(column).cast("timestamp_ntz")


def time_literal(df: DataFrame, column: str, value: datetime) -> Column:
    """A literal of the column's own time type, so that comparisons reach the scan."""
    kind = df.schema[column].dataType.simpleString()
    return F.lit(value).cast(kind if kind in ("timestamp", "timestamp_ntz") else "timestamp_ntz")


def between(df: DataFrame, column: str, lo: datetime, hi: datetime) -> DataFrame:
    """Rows with ``lo <= column < hi``."""
    return df.where((F.col(column) >= time_literal(df, column, lo)) & (F.col(column) < time_literal(df, column, hi)))


def _micros(value: datetime) -> int:
    return (value - _EPOCH) // _US


def _at(micros: int) -> datetime:
    return _EPOCH + timedelta(microseconds=micros)


def plan_equal_windows(df: DataFrame, ts_col: str, windows: int, start: datetime,
                       end: datetime) -> list[tuple[datetime, datetime]]:
    """At most ``windows`` half-open windows that cover [start, end) and hold
    about ``rows / windows`` rows each.

    Bound k is the time of the row of rank ``k * rows // windows`` (from 0, by
    time). Rows of one instant are never parted: where an instant holds more
    than a window's share, bounds fall together and there are fewer windows.
    Null times are in no window.
    """
    if windows < 1:
        raise ValueError("windows must be at least 1")
    if start >= end:
        return []
    lo, hi = _micros(start), _micros(end)
    rows = between(df, ts_col, start, end).select(
        (F.unix_micros(wall_clock(df, ts_col).cast("timestamp")) - F.lit(lo)).alias("at"))
    width = 1 << max(0, -(-(hi - lo) // BUCKETS) - 1).bit_length()  # powers of two: each divides the wider ones
    counts = {b: n for b, n in rows.groupBy(F.expr(f"at div {width}").alias("b")).count().collect()}
    total = sum(counts.values())
    ranks = sorted({k * total // windows for k in range(1, windows)} - {0}) if total else []

    def place(ranks: list[tuple[int, int]], counts: dict[int, dict[int, int]], width: int) -> list[tuple[int, int]]:
        """(start of the bucket that holds the rank, rank inside it) for each (start of the wider bucket, rank)."""
        out = []
        for base, rank in ranks:
            for b in sorted(counts[base]):
                if rank < counts[base][b]:
                    out.append((base + b * width, rank))
                    break
                rank -= counts[base][b]
        return out

    found = place([(0, r) for r in ranks], {0: counts}, width) if ranks else []
    while found and width > 1:
        bases = sorted({b for b, _ in found})
        finer = max(1, width >> max(1, (BUCKETS // len(bases)).bit_length() - 1))
        wide, inside = F.expr(f"at div {width} * {width}"), F.expr(f"at % {width} div {finer}")
        near = rows.where(F.col("at").between(bases[0], bases[-1] + width - 1)).withColumn("base", wide)
        fine: dict[int, dict[int, int]] = {b: {} for b in bases}
        for base, b, n in near.where(F.col("base").isin(bases)).groupBy("base", inside.alias("b")).count().collect():
            fine[base][b] = n
        found, width = place(found, fine, finer), finer
    bounds = [start, *(_at(lo + b) for b in sorted({b for b, _ in found} - {0})), end]
    return list(zip(bounds, bounds[1:]))
