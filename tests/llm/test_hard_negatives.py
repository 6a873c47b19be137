"""Hard negatives against all pairs in plain Python; the bounds against the scores."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every=100):
    """Every pair, scored with whole numbers."""
    use = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, [math.floor(256 * x) for x in v], label))
    end, out = 2**63 - 1, []
    for a, (i, v, label) in enumerate(use):
        if i is None or i % every:
            continue
        scored = [(-max(-end, min(end, sum(p * q for p, q in zip(v, w)))), j is None, j or 0, m)
                  for b, (j, w, m) in enumerate(use) if b != a]
        scored.sort()
        for ps, pn, p, _ in [s for s in scored if s[3] == label][:5]:
            fit = [s for s in scored if s[3] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:5]
            out += [(i, None if pn else p, k, None if s[1] else s[2], -ps, -s[0]) for k, s in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(df, **kw):
    return sorted((tuple(r) for r in hn.hard_negatives(df, **kw).collect()), key=str)


def near(rnd, n, dim, labels=3):
    """Vectors around a few centres, so positives and negatives score alike."""
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(3)]
    return [(k, [c + rnd.gauss(0, 0.4) for c in rnd.choice(centres)], rnd.randrange(labels)) for k in range(n)]


def test_table_against_plain(spark, sf_small):
    df = hn.shifted(spark.read.parquet(f"{sf_small}/embeddings.parquet"))
    got = mined(df)
    assert got == plain([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]) and got


@pytest.mark.parametrize("dim", [1, 5, 64, 130])
def test_near_vectors_in_small_tiles(spark, monkeypatch, dim):
    monkeypatch.setattr(hn, "CHUNK_ROWS", 40)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 7)
    rows = near(random.Random(dim), 400, dim)
    assert mined(spark.createDataFrame(rows, SCHEMA), every=10) == plain(rows, 10)


def test_strange_rows(spark):
    rnd = random.Random(3)
    rows = near(rnd, 150, 6)
    rows += [rows[0], rows[0], rows[100], (None, rows[1][1], 0), (None, rows[2][1], 1), (200, None, 1), (300, [], 1),
             (400, [1.0], 2), (500, [0.0] * 6, 0), (600, [1.0, None], 0), (700, [float("nan")] * 6, 0),
             (800, [float("inf")] * 6, 1), (900, [1.0] * 6, None), (1000, [1e30] * 6, 1), (1001, [1e30] * 6, 1),
             (1002, [9e29] * 6, 2), (-100, [-1.0] * 6, 1), (1100, [0.5] * 90, 1), (1102, [0.49] * 90, 0)]
    rows += [(k, [0.5] * 6, k % 2) for k in range(2000, 2060)]  # ties
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.withColumns({c: F.lit("x") for c in ("id", "vector", "block", "chunk", "list", "k", "at", "part", "rank")})
    assert mined(extra) == plain(rows)
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id % 100 <> 0")) == []
    assert hn.hard_negatives(df.limit(0)).columns == hn.hard_negatives(df).columns


def test_blocks_without_positives(spark, monkeypatch):
    monkeypatch.setattr(hn, "CHUNK_ROWS", 5)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 1)
    rnd = random.Random(4)
    rows = near(rnd, 60, 8, labels=2) + [(k, [rnd.gauss(0, 1) for _ in range(8)], k) for k in range(100, 1100, 100)]
    assert mined(spark.createDataFrame(rows, SCHEMA), every=20) == plain(rows, 20)
    assert mined(spark.createDataFrame(rows[60:], SCHEMA)) == []


def test_one_vector_holds_a_third(spark):
    rows = near(random.Random(9), 400, 16) + [(1000 + k, [0.3] * 16, 1) for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert mined(df) == plain(rows)


def test_bounds_hold_and_refine():
    rng = np.random.default_rng(5)
    a, r = (np.floor(256 * (rng.normal(size=(n, 128)) + np.repeat(rng.normal(size=(n, 8)), 16, axis=1))) for n in (20, 300))
    score, wide = a @ r.T, []
    for (am, ad), (rm, rd) in zip(hn.summaries(*hn.finest(a)), hn.summaries(*hn.finest(r))):
        give = ad @ rd.T
        assert (np.abs(score - am @ rm.T) <= give + 1e-6 * np.abs(score).max()).all()
        wide.append(give.mean())
    assert wide == sorted(wide, reverse=True) and wide[-1] < 0.9 * wide[0]


def test_filter_drops_pairs_before_scoring():
    rng = np.random.default_rng(6)
    x = np.floor(256 * (np.repeat(rng.normal(size=(2000, 16)), 4, axis=1) + 0.05 * rng.normal(size=(2000, 64))))
    v = hn.Vectors(np.arange(2000), np.ones(2000, bool), np.zeros(2000, np.int64), x, *hn.finest(x))
    low = np.quantile(x @ x.T, 0.999, axis=1)
    i, j, s = hn.pairs(v, v, np.ones((2000, 2000), bool), low, np.full(2000, np.inf))
    assert len(i) < 0.05 * 2000 * 2000 and ((x @ x.T >= low[:, None]).sum() == (s >= low[i]).sum())
