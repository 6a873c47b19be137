"""Reshape and calendar operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import text_to_date, try_number, week_start
from tidemark.operators import joins
from tidemark.operators.aggs import weekly_mean

# Load-metadata columns of the wide cost sheet, never measures.
SHEET_METADATA_COLUMNS = ("_", "_airbyte_raw_id", "_airbyte_extracted_at", "_airbyte_meta",
                          "_airbyte_generation_id")


def unpivot_measures(df: DataFrame, id_cols: Sequence[str] | str, name: str = "font",
                     value: str = "cost") -> DataFrame:
    """Wide -> long over every column but the id columns.

    The column set is read from the frame at call time. Null cells are kept
    (one output row per input row and measure column), as ``stack`` does.
    """
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    measures = [c for c in df.columns if c not in ids]
    return df.unpivot(ids, measures, name, value)


def parse_measure_columns(df: DataFrame, date_col: str = "_", date_name: str = "reference_date",
                          metadata: Sequence[str] = SHEET_METADATA_COLUMNS,
                          keep: Sequence[str] = ()) -> DataFrame:
    """The date text to a date, every other non-metadata column from
    decimal-comma text to double (bad text -> null). ``keep`` columns pass
    through unchanged; the column set is read from the frame at call time."""
    skip = set(metadata) | set(keep) | {date_col}
    measures = [c for c in df.columns if c not in skip]
    return df.select(*keep, text_to_date(date_col).alias(date_name),
                     *[try_number(c).alias(c) for c in measures])


def date_spine(spark: SparkSession, start, end, name: str = "_date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive.

    ``start``/``end`` are dates, date text or Columns; no recursion is used
    (Spark's recursive CTE stops at 100 levels).
    """
    s = F.to_date(start if isinstance(start, Column) else F.lit(str(start)))
    e = F.to_date(end if isinstance(end, Column) else F.lit(str(end)))
    return spark.range(1).select(F.explode(F.sequence(s, e, F.expr("interval 1 day"))).alias(name))


def spine_between(df: DataFrame, date_col: str, name: str = "_date") -> DataFrame:
    """R3 with bounds taken from the data: every day between the first and
    last date of ``df[date_col]`` (one aggregate, then one generator row)."""
    bounds = df.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(name))


def fill_from_week(spine: DataFrame, values: DataFrame, date_col: str, value: str,
                   spine_col: str = "_date", out_date: str = "reference_date",
                   round_to: int = 4) -> DataFrame:
    """Value of each calendar day; a day without a value takes the
    mean of its (Monday) week, and a week without any value stays null.

    Calendar ⟕ daily values on the day (J13), then the weekly mean joined
    on the week only for rows still missing a value (J12 with J16's key
    expression), rounded.
    """
    daily = values.select(F.to_date(date_col).alias("__tm_day"), F.col(value))
    weekly = weekly_mean(values, date_col, value, week_col="__tm_week", name=value)
    out = joins.fallback_lookup(spine, daily, [(F.col(spine_col), "__tm_day")],
                                weekly, [(week_start(spine_col), "__tm_week")], value, name="__tm_filled")
    return out.select(F.col(spine_col).alias(out_date), F.round("__tm_filled", round_to).alias(value))


def fill_spine(spine: DataFrame, df: DataFrame, date_col: str, keys: Sequence[str],
               zero_sums: Sequence[str], sums: Sequence[str], spine_col: str = "_date") -> DataFrame:
    """Calendar ⟕ data, grouped by (day, keys). Days without data get one
    row with null keys; ``zero_sums`` become 0 there, ``sums`` stay null."""
    data = df.withColumnRenamed(date_col, spine_col) if date_col != spine_col else df
    joined = joins.on_spine(spine, data, spine_col)
    aggs = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in zero_sums]
    aggs += [F.sum(c).alias(c) for c in sums]
    return joined.groupBy(spine_col, *keys).agg(*aggs)
