"""Data checks (Q1-Q3): not-null and unique tests as distributed aggregates.

A check never collects rows: it returns a DataFrame of violations (or of
failure counts) that the caller writes, counts or asserts empty.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cols(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def check_not_null(df: DataFrame, column) -> DataFrame:
    """Q1: rows where any of ``column`` is null (the violations)."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in _cols(column)])
    return df.where(cond)


def check_unique(df: DataFrame, column) -> DataFrame:
    """Q2: key values occurring more than once, with their count ``n``.
    Rows with a null key are not tested (as SQL ``unique`` tests do)."""
    cols = _cols(column)
    nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (df.where(nonnull).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def failure_counts(df: DataFrame, table: str, not_null: Sequence = (), unique: Sequence = ()) -> DataFrame:
    """Q3 for one table: one aggregate pass computing every test's failure
    count; returns rows (table_name, column_name, test, failures).

    not-null failures = rows with a null; unique failures = rows with a
    non-null key minus distinct non-null keys (0 when the key is unique).
    """
    aggs, labels = [], []
    for c in not_null:
        cols = _cols(c)
        cond = reduce(lambda a, b: a | b, [F.col(x).isNull() for x in cols])
        aggs.append(F.sum(F.when(cond, 1).otherwise(0)).cast("long"))
        labels.append((",".join(cols), "not_null"))
    for c in unique:
        cols = _cols(c)
        nonnull = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in cols])
        aggs.append((F.sum(F.when(nonnull, 1).otherwise(0)) - F.countDistinct(*[F.col(x) for x in cols])).cast("long"))
        labels.append((",".join(cols), "unique"))
    names = [f"f{i}" for i in range(len(aggs))]
    one = df.agg(*[a.alias(n) for a, n in zip(aggs, names)])
    stack = F.array(*[
        F.struct(F.lit(col).alias("column_name"), F.lit(test).alias("test"), F.col(n).alias("failures"))
        for (col, test), n in zip(labels, names)
    ])
    return one.select(F.explode(stack).alias("r")).select(
        F.lit(table).alias("table_name"), "r.column_name", "r.test", F.coalesce("r.failures", F.lit(0)).alias("failures"))


def run_checks(tables: Mapping[str, DataFrame], rules: Mapping[str, Mapping[str, Sequence]]) -> DataFrame:
    """Q3: run the rules of every table; ``rules[name]`` holds ``not_null``
    and ``unique`` column lists. One aggregate job per table, results unioned."""
    frames = [failure_counts(tables[name], name, r.get("not_null", ()), r.get("unique", ()))
              for name, r in rules.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)
