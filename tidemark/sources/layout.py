"""Clustering on several columns (IO12): an interleaved (Z-order) sort key.

Sorting by range of (a, b, c) lets file statistics skip files on ``a`` only.
Here each column's values are ranked into equally filled cells and the bits of
the cells are interleaved, so files hold a box of all columns and a filter on any
of them skips files. The cells' bounds come from one aggregate of bounded
quantile sketches; the key itself is a column expression.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 6  # cells per column: 2**BITS
PREFIX = 7  # bytes of a text that count for its rank


def _image(df: DataFrame, column: str) -> Column:
    """A double or long that orders as the column does (texts: by their first bytes)."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.StringType):
        digits = F.rpad(F.hex(F.substring(c.cast("binary"), 1, PREFIX)), 2 * PREFIX, "0")
        return F.conv(digits, 16, 10).cast("long")
    if isinstance(kind, T.BooleanType):
        return c.cast("long")
    return c.cast("double")


def _cell(image: Column, bounds: list, numbers: list) -> Column:
    """``numbers[k]`` for the k-th cell between the bounds (a binary search as nested conditions); null is in the
    first cell."""
    if not bounds:
        return F.lit(numbers[0])
    mid = len(bounds) // 2
    return F.when(image > F.lit(bounds[mid]), _cell(image, bounds[mid + 1:], numbers[mid + 1:])).otherwise(
        _cell(image, bounds[:mid], numbers[:mid + 1]))


def z_key(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The interleaved key of ``columns`` as a long (at most 63 bits in all). Runs one aggregate over ``df``."""
    columns = list(columns)
    bits = min(bits, 63 // len(columns))
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    images = {c: _image(df, c) for c in columns}
    found = df.agg(*(F.percentile_approx(images[c], steps, 1000).alias(f"q{k}") for k, c in enumerate(columns))).first()
    cells = []
    for k, c in enumerate(columns):
        # a value that fills several cells takes them all, so few values still use the high bits
        steps_of = Counter(found[k] or [])
        bounds = sorted(steps_of)
        cells.append(_cell(images[c], bounds, list(accumulate((steps_of[b] for b in bounds), initial=0))))
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for k, cell in enumerate(cells):
            one = F.shiftright(cell, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(cells) + len(cells) - 1 - k))
    return key


def z_ordered(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = BITS) -> DataFrame:
    """``df`` dealt into about ``files`` partitions (default: the session's shuffle partitions) and sorted by the
    interleaved key.

    Partitions are whole boxes: the key's leading bits name at least ``files`` boxes, which are
    counted first (the driver gets one count for each). A box that holds more than its
    share, as where many rows agree in all columns, is split by a hash of the row.
    """
    key, tie, box, to = (f"__tm_{n}" for n in ("z", "tie", "box", "to"))
    columns = list(columns)
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(bits, 63 // len(columns))
    lead = min((files - 1).bit_length(), bits * len(columns))
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    keyed = df.withColumns({key: z_key(df, columns, bits), tie: F.xxhash64(*plain)})
    keyed = keyed.withColumn(box, F.shiftright(key, bits * len(columns) - lead))
    counts = sorted(tuple(r) for r in keyed.groupBy(box).count().collect())
    share = max(1, sum(n for _, n in counts) / files)
    split = [max(1, round(n / share)) for _, n in counts]
    # a box's first partition and their number, by its place in two short lists: no join, which would shuffle whole rows
    first, many = [0] * (1 << lead), [1] * (1 << lead)
    for (b, _), at, p in zip(counts, accumulate(split, initial=0), split):
        first[b], many[b] = at, p
    place = F.col(box).cast("int")
    dealt = keyed.withColumn(to, F.get(F.lit(first), place) + F.pmod(tie, F.get(F.lit(many), place)).cast("int"))
    dealt = dealt.repartitionById(max(1, sum(split)), F.col(to)).sortWithinPartitions(key, *columns)
    return dealt.select(*df.columns)
