"""Feistel sharding against plain Python: permutation, counts, slots, numbers, resumed reads."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import feistel_shards as fs


def plain_permute(x: int, n: int, seed: int) -> int:
    """The network a number at a time, with Python's integers."""
    m64 = (1 << 64) - 1

    def mix(v):
        v = ((v ^ (v >> 30)) * 0xBF58476D1CE4E5B9) & m64
        v = ((v ^ (v >> 27)) * 0x94D049BB133111EB) & m64
        return v ^ (v >> 31)

    keys = [mix((k * 0x9E3779B97F4A7C15 + seed) & m64) for k in range(1, fs.ROUNDS + 1)]
    bits = 1
    while (1 << (2 * bits)) < n:
        bits += 1
    while True:
        left, right = x >> bits, x & ((1 << bits) - 1)
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & ((1 << bits) - 1))
        x = (left << bits) | right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 64, 65, 1000, 4097])
def test_is_a_permutation_and_has_an_inverse(n):
    got = fs.permute(np.arange(n), n, 7)
    assert sorted(got) == list(range(n))
    assert fs.permute(got, n, 7, back=True).tolist() == list(range(n))
    assert got.tolist() == [plain_permute(i, n, 7) for i in range(n)]


def test_seeds_differ_and_large_numbers_work():
    a, b = (fs.permute(np.arange(1000), 1000, s) for s in (1, 2))
    assert (a != b).mean() > 0.9 and abs(np.corrcoef(np.arange(1000), a)[0, 1]) < 0.15
    n = 3 * 10**18
    x = np.array([0, 1, n - 1, n // 2])
    assert fs.permute(fs.permute(x, n, 5), n, 5, back=True).tolist() == x.tolist()


def check(rows, shards):
    counts = [sum(r["shard"] == s for r in rows) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def plain_report(docs, shards, seed):
    """Numbers by a plain sort, places by the plain network."""
    base = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs]
    base.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    out = []
    for k, r in enumerate(base):
        p = plain_permute(k, len(base), seed)
        out.append((*r, "rows", p % shards, p // shards, None))
    return sorted(out, key=str)


def test_report_against_plain(spark, small):
    docs = [tuple(r) for r in small.select("doc_id", "text").collect()]
    rows = fs.sharding_report(small).collect()
    check(rows, 8)
    assert sorted((tuple(r)[:7] for r in rows), key=str) == plain_report(docs, 8, 11)
    # files and partitions do not matter
    again = fs.sharding_report(small.repartition(5, "text")).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)


def test_odd_and_empty(spark, odd, none):
    clash = odd.withColumns({c: F.lit(1) for c in ("shard", "slot", "number", "size", "place_", "part_", "first_", "at_")})
    rows = fs.sharding_report(clash).collect()
    check(rows, 8)
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert sorted((tuple(r)[:7] for r in rows), key=str) == plain_report(docs, 8, 11)
    kept = fs.shard(clash, ["doc_id", "text"], 3, 1)
    assert set(kept.columns) == set(clash.columns) and kept.count() == odd.count()
    empty = fs.sharding_report(none)
    assert empty.count() == 0 and empty.columns == fs.sharding_report(odd).columns


def test_one_key_holds_a_third(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("t").alias("t"))
    rows, n = fs.number_rows(df, ["k"])
    assert n == 30_000 and rows.select("number").distinct().count() == n
    per = rows.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(per) > 1  # the hot key is in several partitions
    ks = [r["k"] for r in rows.orderBy("number").collect()]
    assert ks == sorted(ks)


def test_resumed_read_and_files(spark, small, tmp_path):
    placed = fs.shard(small.select("doc_id", "text"), ["doc_id"], 4, 3).cache()
    n = placed.count()
    want = {r["slot"]: r["doc_id"] for r in placed.where("shard = 2").collect()}
    got = fs.numbers_at(spark, n, 4, 3, 2, 10, 10**9).join(placed.select("number", "doc_id"), "number").collect()
    assert {r["slot"]: r["doc_id"] for r in got} == {s: i for s, i in want.items() if s >= 10}
    fs.write_shards(placed, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, back.select("doc_id", "shard", "slot").collect())) == sorted(
        map(tuple, placed.select("doc_id", "shard", "slot").collect()))
