"""Sharding by a keyed permutation of global row numbers (law ``rows``).

Rows get global numbers 0 to n-1 in the order of their keys. A Feistel network
with cycle walking permutes the numbers; position p goes to shard ``p % shards``
at slot ``p // shards``. So the counts of any two shards differ by one at most,
slots have no gaps, the order inside a shard is a shuffle that the seed fixes,
and shard and slot of a number (or the number at a shard and slot) are computed
without reading any row.

Numbers follow the values of the keys (nulls first), not files or partitions.
Rows equal in all keys may swap numbers; when the keys hold all returned
columns, the result does not change. A hot key value is split over many tasks by the row's place
in its input partition, so the input must be a plain scan or checkpointed
(its rows come in the same order when a task is run again). Null, empty and
very long texts count as 1, 1 and their bytes plus 1; an empty table gives no
rows; a column of the input with a clashing name (``shard``, ``slot``,
``number``) is replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut, unused

ROUNDS = 8
_PLACE = (1 << 33) - 1  # monotonically_increasing_id: 33 bits of place in the partition


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _round_keys(seed: int) -> np.ndarray:
    steps = (np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _mix(steps + np.uint64(seed % (1 << 64)))


def _half_bits(n: int) -> int:
    return max(1, -(-(n - 1).bit_length() // 2))


def _network(x: np.ndarray, bits: int, keys: np.ndarray, back: bool) -> np.ndarray:
    """One pass of the balanced network over 2 * ``bits`` bits."""
    half, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    left, right = x >> half, x & mask
    for k in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (_mix(left ^ k) & mask), left
        else:
            left, right = right, left ^ (_mix(right ^ k) & mask)
    return (left << half) | right


def permute(numbers: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 (``back``: its inverse).

    The network permutes the next power of four; what falls outside 0..n-1 is
    passed on until it falls inside (cycle walking), which keeps it a
    permutation of 0..n-1. Under four passes are needed on average.
    """
    x = np.asarray(numbers, dtype=np.int64).astype(np.uint64)
    if x.size == 0:
        return x.astype(np.int64)
    bits, keys = _half_bits(n), _round_keys(seed)
    out = _network(x, bits, keys, back)
    wide = np.flatnonzero(out >= np.uint64(n))
    while wide.size:
        out[wide] = again = _network(out[wide], bits, keys, back)
        wide = wide[again >= np.uint64(n)]
    return out.astype(np.int64)


def permuted(number: Column, n: int, seed: int, back: bool = False) -> Column:
    """:func:`permute` of a column of longs in 0..n-1."""

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed, back))

    return place(number)


def number_rows(df: DataFrame, keys: list[str], name: str = "number") -> tuple[DataFrame, int]:
    """``df`` with a global row number by ``keys`` (nulls first), and the count of rows.

    A range partitioning deals out (keys, place in the input), so equal keys
    are split too; the sorted rows are checkpointed, and a row's number is
    its place in its partition plus the rows of the partitions before. The
    driver gets one count for each partition.
    """
    df = df.drop(name)
    place, part = unused(df, "place_"), unused(df, "part_")
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*(F.col(k).asc_nulls_first() for k in keys), F.col(place).asc()]
    dealt = df.withColumn(place, F.monotonically_increasing_id()).repartitionByRange(width, *order)
    rows = cut(dealt.sortWithinPartitions(*order).drop(place)).withColumn(place, F.monotonically_increasing_id())
    rows = rows.withColumn(part, F.shiftright(place, 33))
    counts = sorted(tuple(r) for r in rows.groupBy(part).count().collect())
    before = np.cumsum([0, *(c for _, c in counts)]).tolist()
    first = unused(rows, "first_")
    starts = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], f"{part} long, {first} long")
    number = F.col(first) + F.col(place).bitwiseAND(F.lit(_PLACE))
    rows = rows.join(F.broadcast(starts), part).select(*df.columns, number.alias(name))
    return rows, before[-1]


def shard(df: DataFrame, keys: list[str], shards: int, seed: int) -> DataFrame:
    """``df`` with ``number``, ``shard`` and ``slot``; ``keys`` give the order of the numbers."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    rows, n = number_rows(df.drop("shard", "slot"), keys)
    at = unused(rows, "at_")
    rows = rows.withColumn(at, permuted(F.col("number"), n, seed))
    return rows.withColumns({"shard": (F.col(at) % shards).cast("int"),
                             "slot": F.expr(f"`{at}` div {shards}")}).drop(at)


def numbers_at(spark: SparkSession, n: int, shards: int, seed: int, shard: int, start: int, stop: int) -> DataFrame:
    """(number, slot) of slots ``start`` to ``stop`` - 1 of a shard, computed
    alone: what a reader that resumes in the middle of a shard asks for."""
    last = (n - shard + shards - 1) // shards
    slots = spark.range(max(0, start), max(0, start, min(stop, last))).withColumnRenamed("id", "slot")
    return slots.withColumn("number", permuted(F.col("slot") * shards + shard, n, seed, back=True))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, its files in slot order (a shard of many rows has several files)."""
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text plus 1) and ``text_crc32``; null has no bytes."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.withColumns({"size": (F.octet_length(raw) + 1).cast("long"), "text_crc32": F.crc32(raw)})


def sharding_report(docs: DataFrame, shards: int = 8, seed: int = 11) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, number."""
    slim = sized(docs.select("doc_id", "text")).select("doc_id", "size", "text_crc32")
    placed = shard(slim, ["doc_id", "size", "text_crc32"], shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "number")
