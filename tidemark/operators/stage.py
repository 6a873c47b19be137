"""Staging operators: projection, rename, cast, constants (P1-P3, P6-P8) and
"latest / first row per key" deduplication (D1-D7, W1-W3).

Scale notes
-----------
* ``latest_per_key`` / ``first_per_key`` / ``distinct_on`` filter
  ``row_number() == 1``; Catalyst then inserts a partial ``WindowGroupLimit``
  before the shuffle, so each map task ships at most one row per key. A key
  holding a third of the table therefore reaches its reducer as one row per
  input partition, not as a third of the table.
* ``unify_ranked`` keeps every row, so it cannot pre-reduce; by default it
  counts the keys first and ranks those of very many rows by a
  range-partitioned global sort and per-partition offsets, splitting a hot
  key across as many tasks as its size needs (the other keys, and all with
  ``skew_safe=False``, are ranked with one window sort per key group).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tidemark.functions.scalars import as_col
from tidemark.session import checkpoint_dir

OrderSpec = Sequence  # of str | Column | (name, "asc"|"desc")


def stage(df: DataFrame, columns: Sequence | None = None, *, casts: Mapping[str, str] | None = None,
          constants: Mapping[str, object] | None = None) -> DataFrame:
    """Ordered projection with renames, casts and constant columns.

    ``columns`` entries are a name (kept), an ``(old, new)`` pair (renamed) or
    a ``(Column, new)`` pair (computed). ``casts`` maps output names to types;
    a cast keeps the column's name. ``constants`` appends literal columns.
    """
    casts = dict(casts or {})
    exprs: list[Column] = []
    if columns is None:
        columns = df.columns
    for item in columns:
        if isinstance(item, str):
            name, expr = item, F.col(item)
        else:
            src, name = item
            expr = as_col(src)
        if name in casts:
            expr = expr.cast(casts.pop(name))
        exprs.append(expr.alias(name))
    for name, value in (constants or {}).items():
        exprs.append(F.lit(value).alias(name))
    out = df.select(*exprs)
    for name, typ in casts.items():  # casts on names not in the projection
        out = out.withColumn(name, F.col(name).cast(typ))
    return out


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Add literal columns (``'GENERAL' as gamemode``, ``0 as new_users``)."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in constants.items()})


def _order(spec: OrderSpec, pg_nulls: bool = False) -> list[Column]:
    """Sort expressions; ``pg_nulls`` uses PostgreSQL null placement
    (nulls last ascending, first descending), otherwise Spark's default
    (nulls first ascending, last descending)."""
    out = []
    for item in spec:
        if isinstance(item, Column):
            out.append(item)
            continue
        if isinstance(item, str):
            name, direction = item, "asc"
        else:
            name, direction = item
        c = F.col(name) if isinstance(name, str) else name
        if direction == "desc":
            out.append(c.desc_nulls_first() if pg_nulls else c.desc_nulls_last())
        else:
            out.append(c.asc_nulls_last() if pg_nulls else c.asc_nulls_first())
    return out


def ordered(df: DataFrame, order: OrderSpec, pg_nulls: bool = False, within_partitions: bool = False) -> DataFrame:
    """O1/O3: final sort with explicit direction and null placement.

    Only meant for a sink (a view has no order). ``within_partitions=True``
    sorts each output file instead of the whole result, which avoids the
    range shuffle of a global sort when only file-level order matters.
    """
    cols = _order(order, pg_nulls)
    return df.sortWithinPartitions(*cols) if within_partitions else df.orderBy(*cols)


def ranked(df: DataFrame, keys: Sequence[str], order: OrderSpec, name: str = "rn",
           pg_nulls: bool = False) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` kept as
    a data column."""
    w = Window.partitionBy(*keys).orderBy(*_order(order, pg_nulls))
    return df.withColumn(name, F.row_number().over(w))


def _top_one(df: DataFrame, keys: Sequence[str], order: OrderSpec, pg_nulls: bool) -> DataFrame:
    tmp = "__tidemark_rn"
    w = Window.partitionBy(*keys).orderBy(*_order(order, pg_nulls))
    return df.withColumn(tmp, F.row_number().over(w)).where(F.col(tmp) == 1).drop(tmp)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str | Sequence,
                   tiebreak: Sequence | None = None) -> DataFrame:
    """Newest row per key (``order_by`` descending, Spark null order).

    ``tiebreak`` adds further sort keys so equal timestamps pick the same row
    on every run.
    """
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    spec = [(c, "desc") if isinstance(c, str) else c for c in cols] + list(tiebreak or [])
    return _top_one(df, keys, spec, pg_nulls=False)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: str | Sequence,
                  tiebreak: Sequence | None = None) -> DataFrame:
    """Oldest row per key (``order_by`` ascending, Spark null order)."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    spec = [(c, "asc") if isinstance(c, str) else c for c in cols] + list(tiebreak or [])
    return _top_one(df, keys, spec, pg_nulls=False)


def distinct_on(df: DataFrame, keys: Sequence[str], order: OrderSpec) -> DataFrame:
    """D3: PostgreSQL ``DISTINCT ON (keys) ... ORDER BY keys, order``.

    Null placement follows PostgreSQL (T1): nulls sort last ascending and
    first descending.
    """
    return _top_one(df, keys, order, pg_nulls=True)


def stack_rows(*frames: DataFrame, allow_missing: bool = True) -> DataFrame:
    """``UNION ALL`` by column name; columns missing from a frame are
    padded with nulls and types widen as in SQL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def unify_latest(new: DataFrame, old: DataFrame, keys: Sequence[str], order_by: str,
                 tiebreak: Sequence | None = None) -> DataFrame:
    """Union of the current and legacy export, newest row per key."""
    return latest_per_key(stack_rows(new, old), keys, order_by, tiebreak)


def row_hash(df: DataFrame) -> Column:
    """A hash of the row's plain columns: the last resort of an order."""
    return F.xxhash64(*[f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)])


def _written(df: DataFrame, name: str) -> DataFrame:
    from tidemark.sources.files import stage_table

    return stage_table(df, name)


# A key of more rows than this is ranked by several tasks.
HOT_KEY_ROWS = 1_000_000


def _skew_safe_rank(df: DataFrame, keys: Sequence[str], order: OrderSpec, name: str) -> DataFrame:
    """Row number per key without putting one large key group into one task.

    The rows of each key are counted first (a partial aggregate of the key columns). Where no
    key has more than ``HOT_KEY_ROWS`` rows, whole rows travel once, to one window per key;
    the hot keys (few: at most one in so many rows) go through :func:`_rank_by_range`.
    """
    last = "__tm_last"
    columns = df.columns
    # the row's hash ends the order: equal times rank the same on every run, and a run of them can be split
    hashed = df.withColumn(last, row_hash(df))
    spec = [*order, (last, "asc")]
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__tm_n")).where(F.col("__tm_n") > HOT_KEY_ROWS)
    # a written table: the planner knows its size, and broadcasts so few keys
    hot = _written(hot.select(*[F.col(k).alias(f"__tm_h_{k}") for k in keys]), "hot_keys")
    if hot.isEmpty():
        return ranked(hashed, keys, spec, name).select(*columns, name)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__tm_h_{k}")) for k in keys])
    rest = ranked(hashed.join(hot, same, "left_anti"), keys, spec, name)
    many = _rank_by_range(hashed.join(hot, same, "left_semi"), keys, spec, name)
    return rest.unionByName(many).select(*columns, name)


def _rank_by_range(df: DataFrame, keys: Sequence[str], order: OrderSpec, name: str) -> DataFrame:
    """Row number per key, one key over several tasks.

    A range-partitioned global sort on (keys, order) splits a hot key over
    several partitions; each partition's per-key row counts (small: one row
    per key per partition) give the offset of its first row, and the rank is
    that offset plus the position inside the partition. The sorted rows are
    checkpointed in the shared folder, so the plan runs one sort (an action)
    and both sides of the join read the same partition numbers.
    """
    pid, pos = "__tm_pid", "__tm_pos"
    columns = df.columns
    ordering = [F.col(k).asc_nulls_first() for k in keys] + _order(order)
    checkpoint_dir(df.sparkSession)
    # one sort, written once: positions and counts must see the same cuts
    sorted_df = df.orderBy(*ordering).withColumn(pid, F.spark_partition_id()).checkpoint(eager=True)
    w_in = Window.partitionBy(pid, *keys).orderBy(*ordering)
    local = sorted_df.withColumn(pos, F.row_number().over(w_in))
    # counts come from the same positions, so both sides of the join agree
    counts = local.groupBy(pid, *keys).agg(F.max(pos).alias("__tm_n"))
    w_off = Window.partitionBy(*keys).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__tm_off", F.coalesce(F.sum("__tm_n").over(w_off), F.lit(0)))
    right = offsets.select(*[F.col(c).alias(f"__tm_r_{c}") for c in (pid, *keys)], "__tm_off")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__tm_r_{c}")) for c in (pid, *keys)])
    joined = local.join(right, same, "inner")
    return joined.select(*columns, (F.col("__tm_off") + F.col(pos)).cast("int").alias(name))


def unify_ranked(new: DataFrame, old: DataFrame, keys: Sequence[str], order_by: str,
                 name: str = "rn", skew_safe: bool = True, tiebreak: Sequence | None = None) -> DataFrame:
    """Union of both exports with ``rn`` exposed but *not* filtered, so
    duplicates stay and the caller decides (``rn = 1``).

    Every row is kept, so nothing can be reduced before the shuffle; by
    default the rank is computed skew-safe (a hot key is split over several
    tasks), which counts the keys at plan time. ``skew_safe=False`` uses one window sort per key group.
    ``tiebreak`` adds further sort keys; rows still equal are ranked by a hash
    of the row, so the same rows get the same ranks on every run."""
    both = stack_rows(old, new)
    spec = [(order_by, "desc"), *(tiebreak or [])]
    if skew_safe:
        return _skew_safe_rank(both, keys, spec, name)
    last = "__tm_last"
    return ranked(both.withColumn(last, row_hash(both)), keys, [*spec, (last, "asc")], name).drop(last)


def unify_prefer_primary(primary: DataFrame, legacy: DataFrame, key: str) -> DataFrame:
    """All primary rows plus legacy rows whose key is absent there.

    Legacy rows with a null key are dropped (as ``NOT IN`` does), but a null key inside the primary
    does not empty the legacy branch (the null-aware ``NOT IN`` trap, T15).
    The keys alone are compared first (an anti join, at plan time). The keys found are written, so the planner
    knows their size and broadcasts few of them; whole legacy rows travel only where many are kept.
    """
    own = legacy.select(key).where(F.col(key).isNotNull()).distinct()
    primary_keys = primary.select(key).where(F.col(key).isNotNull())
    only_there = _written(own.join(primary_keys, on=key, how="left_anti"), "legacy_keys")
    return stack_rows(primary, legacy.join(only_there, on=key, how="left_semi"))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``group by`` every selected column == ``select distinct``; the
    hash aggregate combines map-side first."""
    return df.select(*cols).distinct()
