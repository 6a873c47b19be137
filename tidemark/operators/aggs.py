"""Aggregations.

Every aggregate here is a hash aggregate with a partial (map-side) step;
distinct counts are expanded by Catalyst into a two-level aggregate on
(group, value), so a hot group is reduced before its shuffle. The only
list-valued aggregate, :func:`concat_values`, pre-counts each
(group, value) pair so what one group ships is its distinct values, not its
rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import as_col, month_start, week_start


def grouped(df: DataFrame, keys: Mapping[str, Column] | Sequence, aggs: Mapping[str, Column]) -> DataFrame:
    """A1/A2: group by named key expressions (``group by 1, 2`` becomes a
    named column) and alias every aggregate."""
    if isinstance(keys, Mapping):
        key_cols = [as_col(v).alias(k) for k, v in keys.items()]
    else:
        key_cols = [as_col(k) for k in keys]
    return df.groupBy(*key_cols).agg(*[c.alias(n) for n, c in aggs.items()])


def pivot_sums(df: DataFrame, keys: Sequence, rules: Mapping[str, tuple], round_to: int | None = 2) -> DataFrame:
    """One conditional sum per rule, ``round(sum(case when cond then
    value else 0 end), n)``.

    ``rules`` maps the output name to ``(condition, value)`` or to a Column
    already aggregated (for derived differences such as payin - payout).
    """
    exprs = []
    for name, rule in rules.items():
        if isinstance(rule, Column):
            agg = rule
        else:
            cond, value = rule
            agg = F.sum(F.when(cond, as_col(value)).otherwise(F.lit(0)))
        if round_to is not None:
            agg = F.round(agg, round_to)
        exprs.append(agg.alias(name))
    return df.groupBy(*keys).agg(*exprs)


def type_totals(df: DataFrame, keys: Sequence, type_col: str, value_col: str) -> DataFrame:
    """Per (keys, type): exact sum of the value and of its absolute value —
    the pre-aggregate that :func:`pivot_type_totals` pivots."""
    return df.groupBy(*keys, type_col).agg(F.sum(value_col).alias("__tm_v"),
                                           F.sum(F.abs(F.col(value_col))).alias("__tm_abs"))


def pivot_type_totals(totals: DataFrame, keys: Sequence, type_col: str, rules: Mapping[str, tuple],
                      derived: Mapping[str, tuple] | None = None, round_to: int | None = 2) -> DataFrame:
    """A4/A6 over :func:`type_totals` rows (several rows per (keys, type) are
    summed again, so totals from different inputs can be unioned first).

    ``rules`` maps an output name to ``(types, how)`` with ``how`` one of
    ``"value"``, ``"neg"`` or ``"abs"``; ``derived`` maps a name to
    ``(plus_types, minus_types)`` for differences of two such sums.
    """
    t = F.col(type_col)
    pick = {"value": F.col("__tm_v"), "neg": -F.col("__tm_v"), "abs": F.col("__tm_abs")}
    exprs = []
    for name, (types, how) in rules.items():
        exprs.append((F.sum(F.when(t.isin(*types), pick[how]).otherwise(F.lit(0))), name))
    for name, (plus, minus) in (derived or {}).items():
        agg = (F.sum(F.when(t.isin(*plus), F.col("__tm_v")).otherwise(F.lit(0)))
               - F.sum(F.when(t.isin(*minus), F.col("__tm_v")).otherwise(F.lit(0))))
        exprs.append((agg, name))
    out = [(F.round(a, round_to) if round_to is not None else a).alias(n) for a, n in exprs]
    return totals.groupBy(*keys).agg(*out)


def pivot_by_type(df: DataFrame, keys: Sequence, type_col: str, value_col: str,
                  rules: Mapping[str, tuple], derived: Mapping[str, tuple] | None = None,
                  round_to: int | None = 2) -> DataFrame:
    """A4/A6 for measures that are sums of one value column by movement type.

    Rows are first summed per (keys, type) — one exact decimal sum and one
    sum of absolute values per row instead of one conditional sum per
    measure — and the pivot then runs over that small frame. The result is
    the same exact decimal as summing the conditional values row by row.
    """
    return pivot_type_totals(type_totals(df, keys, type_col, value_col), keys, type_col, rules, derived, round_to)


def cond_sum(cond: Column, value) -> Column:
    """Un-aggregated building block of :func:`pivot_sums` for derived rules."""
    return F.sum(F.when(cond, as_col(value)).otherwise(F.lit(0)))


def filtered_sum(cond: Column, value) -> Column:
    """A5: ``sum(value) filter (where cond)`` — null when no row qualifies."""
    return F.sum(F.when(cond, as_col(value)))


def window_sums(df: DataFrame, keys: Sequence, rules: Mapping[str, tuple]) -> DataFrame:
    """Filtered sums per key; ``rules`` maps name to (cond, value)."""
    return df.groupBy(*keys).agg(*[filtered_sum(c, v).alias(n) for n, (c, v) in rules.items()])


def with_general(general: DataFrame, per_segment: DataFrame, segment: str,
                 label: str = "GENERAL") -> DataFrame:
    """Grand-total rows beside per-segment rows.

    ``general`` is aggregated without the segment and labelled ``label``;
    the two inputs may differ (the per-segment one may be fanned out), which
    is why this is a union and not ``rollup``.
    """
    g = general.withColumn(segment, F.lit(label))
    cols = per_segment.columns
    return g.select(*cols).unionByName(per_segment)


def concat_values(df: DataFrame, keys: Sequence[str], column: str, sep: str = ", ",
                  name: str | None = None) -> DataFrame:
    """Sorted list of a group's values joined to text.

    Nulls are skipped and a group of only nulls gives ``''``. The list is
    sorted so the text does not depend on row order (T11). Each
    (group, value) pair is counted first, so only distinct values travel to
    the group's reducer.
    """
    name = name or column
    ks = list(keys)
    counted = df.groupBy(*ks, column).agg(F.count(F.lit(1)).alias("__tm_n"))
    pairs = counted.groupBy(*ks).agg(
        F.array_sort(F.collect_list(F.struct(F.col(column).alias("v"), F.col("__tm_n").alias("n")))).alias("__tm_vs")
    )
    expanded = F.flatten(F.transform("__tm_vs", lambda x: F.array_repeat(x["v"], x["n"].cast("int"))))
    return pairs.select(*ks, F.concat_ws(sep, expanded).alias(name))


def monthly_active(df: DataFrame, date_col: str, user_col: str, segment: str | None = None,
                   name: str = "monthly_users", month_col: str = "month") -> DataFrame:
    """Distinct users per month (and per segment when given)."""
    keys = [month_start(date_col).alias(month_col)]
    if segment:
        keys.append(F.col(segment))
    return df.groupBy(*keys).agg(F.countDistinct(user_col).alias(name))


def user_bitmaps(df: DataFrame, keys: Sequence, user_col: str) -> DataFrame:
    """A3/A13 as mergeable state: exact sets of whole-number user ids, one
    bitmap per (keys, bucket of ids), at most 4 KB each.

    A day's bitmaps are built from that day's rows alone and merged later
    (:func:`merge_bitmaps`, :func:`bitmap_users`), so a new day touches no
    other. Null users are in no set; a group of only null users has no row.
    """
    user = F.col(user_col).cast("long")
    return df.where(user.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(user).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence) -> DataFrame:
    """Union of the sets of :func:`user_bitmaps` over coarser keys (days to months, modes to all)."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def bitmap_users(bitmaps: DataFrame, keys: Sequence[str], name: str = "monthly_users") -> DataFrame:
    """Exact number of distinct users per ``keys`` (column names)."""
    return merge_bitmaps(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("users")).alias(name))


def weekly_mean(df: DataFrame, date_col: str, value: str, week_col: str = "reference_week",
                name: str | None = None) -> DataFrame:
    """Mean of ``value`` per Monday-started week."""
    return df.groupBy(week_start(date_col).alias(week_col)).agg(F.avg(value).alias(name or value))


def sum_or_zero(c) -> Column:
    """``coalesce(sum(x), 0)``."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0))


def mean_or_zero(c) -> Column:
    """A10: ``coalesce(avg(x), 0)`` — picks the one value of a cost repeated
    on every row of a group."""
    return F.coalesce(F.avg(as_col(c)), F.lit(0))
