"""Joins (J1-J18).

No join is hinted: the planner broadcasts below its static threshold and AQE
turns a shuffle join into a broadcast from measured shuffle sizes.

Range joins (look-back windows) are equi joins on ``(key, time bucket)`` with
the exact range as residual condition: a key holding a third of all rows is
spread over as many buckets as its time span, so no task receives a whole
key, and only pairs inside neighbouring buckets are ever formed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def lookup(df: DataFrame, dim: DataFrame, keys, how: str = "left") -> DataFrame:
    """Equi join on one or more key columns with the same name on
    both sides (null keys never match)."""
    return df.join(dim, on=_keys(keys), how=how)


def join_where(df: DataFrame, dim: DataFrame, keys, dim_filter: Column,
               how: str = "inner") -> DataFrame:
    """Join with a constant predicate on the dimension, applied before
    the join (same result as keeping it in ``ON`` for inner joins)."""
    return lookup(df, dim.where(dim_filter), keys, how=how)


def lookup_if(df: DataFrame, dim: DataFrame, pairs: Sequence[tuple[str, str]],
              left_cond: Column | None = None, how: str = "left",
              drop_right: bool = True) -> DataFrame:
    """Left join whose ``ON`` holds key pairs (left name, right name)
    plus a condition on the *left* row. Left rows failing the condition are
    kept with nulls — moving it to ``WHERE`` would drop them."""
    left = df.alias("__l")
    right = dim.alias("__r")
    cond = None
    for lcol, rcol in pairs:
        c = F.col(f"__l.{lcol}") == F.col(f"__r.{rcol}")
        cond = c if cond is None else cond & c
    if left_cond is not None:
        cond = cond & left_cond
    out = left.join(right, on=cond, how=how)
    if drop_right:
        keep_right = [c for c in dim.columns if c not in {r for _, r in pairs} and c not in df.columns]
        return out.select("__l.*", *[F.col(f"__r.{c}") for c in keep_right])
    return out


def salted_join(big: DataFrame, small: DataFrame, keys, buckets: int, how: str = "inner",
                salt_from: Sequence[str] | None = None) -> DataFrame:
    """Equi join that spreads each key of ``big`` over ``buckets`` tasks.

    For a key that may hold a third of ``big`` while ``small`` is too large
    to broadcast: every ``small`` row is repeated once per bucket and every
    ``big`` row goes to one bucket, so each pair still meets exactly once.
    The bucket is a hash of ``salt_from`` (default: all columns of ``big``),
    not a random number, so a retried task after a lost executor puts every
    row in the same bucket again. ``how`` is "inner" or "left" (``big`` on
    the left).
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    ks = _keys(keys)
    cols = list(salt_from) if salt_from else big.columns
    salted = big.withColumn("__tm_salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(buckets)))
    copies = small.withColumn("__tm_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                F.lit(buckets - 1).cast("long"))))
    return salted.join(copies, on=[*ks, "__tm_salt"], how=how).drop("__tm_salt")


def without_match(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Rows of ``df`` with no partner in ``other`` (``left_anti``).

    Replaces both the ``left join ... where other.key is null`` long form
    (which Catalyst does not rewrite) and ``NOT IN (subquery)``.
    """
    ks = _keys(keys)
    return df.join(other.select(*ks), on=ks, how="left_anti")


def flag_match(df: DataFrame, other: DataFrame, keys, name: str) -> DataFrame:
    """Boolean column telling whether a row has a partner in ``other``.

    The partner keys are de-duplicated first (map-side combined), so the flag
    never multiplies rows.
    """
    ks = _keys(keys)
    marks = other.select(*ks).where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ks])).distinct()
    marks = marks.withColumn("__tm_hit", F.lit(True))
    out = df.join(marks, on=ks, how="left")
    return out.withColumn(name, F.col("__tm_hit").isNotNull()).drop("__tm_hit")


def coalesced_lookup(df: DataFrame, dim: DataFrame, left_keys: Sequence, dim_key: str,
                     value: str, name: str | None = None) -> DataFrame:
    """Look ``value`` up by the first key, else by the second key.

    Two left joins on the same dimension; duplicate dimension keys multiply
    rows, as the source model does (T19) — check the dimension with
    ``check_unique`` first.
    """
    name = name or value
    d = dim.select(dim_key, value)
    out = df
    hits = []
    for i, lk in enumerate(left_keys):
        alias = f"__tm_v{i}"
        dd = d.select(F.col(dim_key).alias(f"__tm_k{i}"), F.col(value).alias(alias))
        lcol = F.col(lk) if isinstance(lk, str) else lk
        out = out.join(dd, on=lcol == F.col(f"__tm_k{i}"), how="left").drop(f"__tm_k{i}")
        hits.append(alias)
    return out.withColumn(name, F.coalesce(*[F.col(h) for h in hits])).drop(*hits)


def fallback_lookup(df: DataFrame, first: DataFrame, first_keys: Sequence[tuple],
                    second: DataFrame, second_keys: Sequence[tuple], value: str,
                    name: str | None = None) -> DataFrame:
    """Value from ``first``; only rows where it is null are joined to
    ``second`` (the condition sits in ``ON``), and the two are coalesced.

    ``*_keys`` are pairs of (left Column or name, right name).
    """
    name = name or value
    f = first.select(*[r for _, r in first_keys], F.col(value).alias("__tm_first"))
    f = f.toDF(*[f"__tm_f{i}" for i in range(len(first_keys))], "__tm_first")
    cond = None
    for i, (lk, _) in enumerate(first_keys):
        c = (F.col(lk) if isinstance(lk, str) else lk) == F.col(f"__tm_f{i}")
        cond = c if cond is None else cond & c
    out = df.join(f, on=cond, how="left").drop(*[f"__tm_f{i}" for i in range(len(first_keys))])
    s = second.select(*[r for _, r in second_keys], F.col(value).alias("__tm_second"))
    s = s.toDF(*[f"__tm_s{i}" for i in range(len(second_keys))], "__tm_second")
    cond = F.col("__tm_first").isNull()
    for i, (lk, _) in enumerate(second_keys):
        cond = cond & ((F.col(lk) if isinstance(lk, str) else lk) == F.col(f"__tm_s{i}"))
    out = out.join(s, on=cond, how="left").drop(*[f"__tm_s{i}" for i in range(len(second_keys))])
    return out.withColumn(name, F.coalesce("__tm_first", "__tm_second")).drop("__tm_first", "__tm_second")


def on_spine(spine: DataFrame, df: DataFrame, date_col: str) -> DataFrame:
    """Every day of the calendar, with the data of that day if any."""
    return spine.join(df, on=date_col, how="left")


def star(df: DataFrame, dims: Sequence[tuple]) -> DataFrame:
    """Chain of look-ups ``[(dim, keys[, how]), ...]`` from one fact."""
    out = df
    for item in dims:
        dim, keys = item[0], item[1]
        how = item[2] if len(item) > 2 else "left"
        out = lookup(out, dim, keys, how=how)
    return out


def with_segments(df: DataFrame, segments: DataFrame, key: str, segment: str, default, name: str) -> DataFrame:
    """``df`` with the array ``name`` of the segments that each row's key ever had (sorted; ``[default]``
    without any). A key's null segments count once, as one more ``default``.

    ``segments`` may hold a pair any number of times: a key's array is a set, gathered with map-side
    combine, and a segment has few values. The join adds no rows, so totals per
    (..., array) can be summed before they fan out.
    """
    seg = F.col(segment)
    extra = F.when(F.max(seg.isNull()), F.array(F.lit(default))).otherwise(F.array().cast("array<string>"))
    sets = segments.groupBy(key).agg(F.concat(F.array_sort(F.collect_set(seg)), extra).alias(name))
    out = df.join(sets, on=key, how="left")
    return out.withColumn(name, F.coalesce(F.col(name), F.array(F.lit(default))))


def fan_out(df: DataFrame, segments: DataFrame, key: str, segment: str, default) -> DataFrame:
    """One row per (row, segment the key ever had); rows whose key
    has no segment get ``default``. Intended many-to-many: totals must come
    from the un-fanned input."""
    out = df.drop(segment) if segment in df.columns else df
    out = with_segments(out, segments, key, segment, default, "__tm_segs")
    return out.withColumn(segment, F.explode("__tm_segs")).drop("__tm_segs")


def _day_number(ts) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_date(F.to_date(c))


def range_join(anchors: DataFrame, events: DataFrame, key: str, anchor_ts: str, event_ts: str,
               days: int, how: str = "inner", bucket_days: int | None = None,
               include_anchor_end: bool = True) -> DataFrame:
    """J6/J7 core: pairs (anchor, event) of the same key with
    ``anchor_ts - days <= event_ts <= anchor_ts``.

    Each anchor is replicated to the few day-buckets its window touches and
    each event sits in exactly one bucket, so every true pair is formed
    exactly once and the join is an equi join on (key, bucket) plus the
    exact range. ``how="left"`` keeps anchors without events, once per
    bucket, so only use it under an aggregate (see :func:`lookback_agg`).
    Event columns must not clash with anchor columns (except ``key``).
    """
    b = bucket_days or max(1, math.ceil(days / 2))
    a_day = _day_number(anchor_ts)
    lo = F.floor((a_day - F.lit(days)) / F.lit(b)).cast("long")
    hi = F.floor(a_day / F.lit(b)).cast("long")
    a = anchors.withColumn("__tm_bucket", F.explode(F.sequence(lo, hi)))
    e = events.withColumn("__tm_bucket", F.floor(_day_number(event_ts) / F.lit(b)).cast("long"))
    a = a.alias("__a")
    e = e.alias("__e")
    cond = (
        (F.col(f"__a.{key}") == F.col(f"__e.{key}"))
        & (F.col("__a.__tm_bucket") == F.col("__e.__tm_bucket"))
        & (F.col(f"__e.{event_ts}") >= F.col(f"__a.{anchor_ts}") - F.make_dt_interval(F.lit(days)))
    )
    if include_anchor_end:
        cond = cond & (F.col(f"__e.{event_ts}") <= F.col(f"__a.{anchor_ts}"))
    else:
        cond = cond & (F.col(f"__e.{event_ts}") < F.col(f"__a.{anchor_ts}"))
    joined = a.join(e, on=cond, how=how)
    ev_cols = [F.col(f"__e.{c}") for c in events.columns if c != key]
    return joined.select("__a.*", *ev_cols).drop("__tm_bucket")


def lookback_agg(anchors: DataFrame, events: DataFrame, key: str, anchor_ts: str, event_ts: str,
                 days: int, anchor_id: Sequence[str], aggs: dict[str, Column],
                 bucket_days: int | None = None) -> DataFrame:
    """Per anchor, aggregates over the same key's events of the ``days``
    days up to the anchor (both ends inclusive).

    Anchors with no event in range keep one row (aggregates of nothing:
    count 0, sum null). ``anchor_id`` must identify an anchor row.
    """
    pairs = range_join(anchors.select(*_dedup([key, anchor_ts, *anchor_id])),
                       events, key, anchor_ts, event_ts, days, how="left", bucket_days=bucket_days)
    group = _dedup([*anchor_id, key, anchor_ts])
    return pairs.groupBy(*group).agg(*[c.alias(n) for n, c in aggs.items()])


def before_anchor(events: DataFrame, anchors: DataFrame, key: str, event_ts: str,
                  anchor_ts: str, days: int, bucket_days: int | None = None) -> DataFrame:
    """Events of a key that fall in the ``days`` days up to its anchor
    (``between anchor - days and anchor``), with the anchor columns."""
    return range_join(anchors, events, key, anchor_ts, event_ts, days, how="inner",
                      bucket_days=bucket_days)


def _dedup(cols: Sequence[str]) -> list[str]:
    seen, out = set(), []
    for c in cols:
        if c not in seen:
            seen.add(c)
            out.append(c)
    return out
