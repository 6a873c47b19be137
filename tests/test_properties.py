"""Property tests: operators against brute force on random small frames,
including hot keys (one key holding most rows)."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import aggs, joins, stage

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
BASE = dt.datetime(2024, 1, 1)

keys = st.integers(min_value=0, max_value=3)
hot_keys = st.one_of(st.just(0), keys)  # key 0 is hot


@SETTINGS
@given(st.lists(st.tuples(hot_keys, st.integers(0, 50), st.integers(0, 10 ** 6)), min_size=1, max_size=40,
                unique_by=lambda r: r[2]))
def test_latest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(k, BASE + dt.timedelta(minutes=m), i) for k, m, i in rows],
                               "k int, t timestamp, id int")
    got = {r["k"]: r["id"] for r in stage.latest_per_key(df, ["k"], "t", tiebreak=[("id", "desc")]).collect()}
    want = {}
    for k, m, i in rows:
        if k not in want or (m, i) > want[k]:
            want[k] = (m, i)
    assert got == {k: v[1] for k, v in want.items()}


@SETTINGS
@given(st.lists(st.tuples(hot_keys, st.integers(0, 5)), min_size=1, max_size=60))
def test_skew_safe_rank_matches_window_rank(spark, rows):
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "k int, t int, id int")
    empty = df.limit(0)
    safe = stage.unify_ranked(df, empty, ["k"], "t", skew_safe=True)
    plain = stage.unify_ranked(df, empty, ["k"], "t", skew_safe=False)
    # ties in t make row numbers arbitrary among equals: compare (k, t, rn) multisets
    a = sorted((r["k"], r["t"], r["rn"]) for r in safe.collect())
    b = sorted((r["k"], r["t"], r["rn"]) for r in plain.collect())
    assert a == b


@SETTINGS
@given(st.lists(st.tuples(hot_keys, st.integers(0, 60 * 24 * 40)), min_size=1, max_size=8),
       st.lists(st.tuples(hot_keys, st.integers(0, 60 * 24 * 40), st.integers(1, 500)), min_size=0, max_size=40),
       st.sampled_from([1, 3, 14]), st.sampled_from([1, 2, 5, 30]))
def test_lookback_matches_brute_force(spark, anchors, events, days, bucket):
    a = spark.createDataFrame([(i, k, BASE + dt.timedelta(minutes=m)) for i, (k, m) in enumerate(anchors)],
                              "aid int, k int, at timestamp")
    e = spark.createDataFrame([(j, k, BASE + dt.timedelta(minutes=m), Decimal(v)) for j, (k, m, v) in enumerate(events)],
                              "eid int, k int, et timestamp, v decimal(18,2)")
    out = joins.lookback_agg(a, e, "k", "at", "et", days, ["aid"],
                             {"n": F.countDistinct("eid"), "s": aggs.sum_or_zero("v")}, bucket_days=bucket)
    got = {r["aid"]: (r["n"], int(r["s"])) for r in out.collect()}
    want = {}
    for i, (k, m) in enumerate(anchors):
        hit = [(j, v) for j, (k2, m2, v) in enumerate(events) if k2 == k and m - days * 1440 <= m2 <= m]
        want[i] = (len(hit), sum(v for _, v in hit))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(hot_keys, st.one_of(st.none(), st.sampled_from(["BRL", "BONUS_BRL", "USD"]))),
                min_size=1, max_size=50))
def test_concat_values_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, c string")
    got = {r[0]: r[1] for r in aggs.concat_values(df, ["k"], "c").collect()}
    groups = defaultdict(list)
    for k, c in rows:
        groups[k].append(c)
    assert got == {k: ", ".join(sorted(v for v in vs if v is not None)) for k, vs in groups.items()}


@SETTINGS
@given(st.lists(st.tuples(hot_keys, st.sampled_from(["PAYIN", "PAYOUT", "COUPON", None]),
                          st.integers(-10 ** 6, 10 ** 6)), min_size=1, max_size=50))
def test_pivot_by_type_matches_row_level_sums(spark, rows):
    df = spark.createDataFrame([(k, t, Decimal(v) / 100) for k, t, v in rows], "k int, type string, amount decimal(18,2)")
    rules = {"payin": (("PAYIN",), "value"), "payout": (("PAYOUT",), "neg"), "abs_all": (("PAYIN", "PAYOUT", "COUPON"), "abs")}
    got = {r[0]: tuple(r[1:]) for r in aggs.pivot_by_type(df, ["k"], "type", "amount", rules).collect()}
    want = defaultdict(lambda: [Decimal(0)] * 3)
    for k, t, v in rows:
        d = Decimal(v) / 100
        w = want[k]
        w[0] += d if t == "PAYIN" else 0
        w[1] += -d if t == "PAYOUT" else 0
        w[2] += abs(d) if t is not None else 0
    assert got == {k: tuple(x.quantize(Decimal("0.01")) for x in w) for k, w in want.items()}


@SETTINGS
@given(st.lists(st.tuples(hot_keys, st.integers(0, 100)), min_size=1, max_size=60),
       st.lists(st.tuples(keys, st.integers(0, 9)), min_size=0, max_size=12), st.sampled_from([1, 3, 8]),
       st.sampled_from(["inner", "left"]))
def test_salted_join_matches_plain_join(spark, big_rows, small_rows, buckets, how):
    big = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(big_rows)], "k int, v int, id int")
    small = spark.createDataFrame(small_rows, "k int, w int")
    a = sorted(map(tuple, joins.salted_join(big, small, ["k"], buckets, how=how).select("id", "w").collect()), key=str)
    b = sorted(map(tuple, big.join(small, "k", how).select("id", "w").collect()), key=str)
    assert a == b
