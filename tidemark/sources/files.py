"""File and catalog sources and sinks (IO1, IO2, IO10-IO14)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir, shuffles_released
from tidemark.sources.layout import z_ordered
from tidemark.sources.publish import drop_folder, refresh

# Sinks the materialiser knows; anything else is rejected before any write.
SINK_FORMATS = ("parquet", "orc", "delta", "jdbc", "table")


def read_source(spark: SparkSession, location: str, name: str | None = None) -> DataFrame:
    """IO1: read a named source.

    ``location`` is either a folder holding ``<name>.parquet`` or, when
    ``name`` is None, a parquet path (it holds a ``/``) or a catalog table.
    Every call lists the files anew, so an overwritten source reads right.
    """
    if name is not None:
        return spark.read.parquet(f"{location.rstrip('/')}/{name}.parquet")
    return spark.read.parquet(location) if _is_path(location) else spark.table(location)


def _is_path(target: str) -> bool:
    return "/" in target or target.startswith("file:")


class Tables:
    """Lazy accessor for the parquet tables of one folder (IO1/IO2).

    ``t.orders`` reads ``<dir>/orders.parquet``; nothing is read until an
    action, and Catalyst prunes columns and pushes filters into each scan.
    """

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_source(self.spark, self.directory, name)

    def __getitem__(self, name: str) -> DataFrame:
        return read_source(self.spark, self.directory, name)


def _delta_available(spark: SparkSession) -> bool:
    """True when the Delta Lake data source is on the session's classpath."""
    try:
        spark._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
        return True
    except Exception:
        return False


def materialize(
    df: DataFrame,
    target: str,
    *,
    format: str = "parquet",
    mode: str = "overwrite",
    cluster_by: Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
    jdbc_url: str | None = None,
    jdbc_properties: dict | None = None,
    files_per_partition: int | None = None,
    interleave: bool = False,
    not_null: Sequence = (),
    unique: Sequence = (),
) -> str:
    """IO10/IO12/IO14: write a model output as a full refresh.

    * ``format`` picks the sink ("parquet", "orc", "delta", "jdbc" or
      "table" for a catalog table in parquet); an unknown sink raises before
      anything is written.
    * ``cluster_by`` lays rows out by range of those columns and sorts each
      file, so parquet min/max statistics skip files on later filters, the
      open-source counterpart of a clustered table. ``interleave`` does so
      for all of the columns alike (:mod:`tidemark.sources.layout`), not for
      the leading one first.
    * An overwrite goes to a fresh folder that takes the target's place when
      it is complete (:mod:`tidemark.sources.publish`), so the plan may read
      its own target and a write that fails leaves the old rows. ``not_null``
      and ``unique`` are tested on the rows as they are written.
    """
    if format not in SINK_FORMATS:
        raise ValueError(f"unknown sink format {format!r}; expected one of {SINK_FORMATS}")
    if format == "delta" and not _delta_available(df.sparkSession):
        raise RuntimeError("the delta sink needs the Delta Lake package on the classpath; "
                           "use format='parquet' or 'table' otherwise")
    out = df
    if cluster_by and interleave:
        with shuffles_released(df.sparkSession):
            out = z_ordered(df, cluster_by, files_per_partition)
    elif cluster_by:
        cols = list(cluster_by)
        ranged = (df.repartitionByRange(files_per_partition, *cols) if files_per_partition
                  else df.repartitionByRange(*cols))
        out = ranged.sortWithinPartitions(*cols)
    is_path = _is_path(target) and format != "table"
    if mode == "overwrite" and format in ("parquet", "orc", "table"):
        refresh(out, target, is_path=is_path, format="parquet" if format == "table" else format,
                partition_by=tuple(partition_by or ()), not_null=not_null, unique=unique)
        return target
    if not_null or unique:
        raise ValueError("checks in the write pass need mode='overwrite' and a parquet, orc or table sink")
    if format == "jdbc":
        if not jdbc_url:
            raise ValueError("jdbc sink needs jdbc_url")
        out.write.jdbc(jdbc_url, target, mode=mode, properties=jdbc_properties or {})
        return target
    writer = out.write.mode(mode).partitionBy(*(partition_by or ()))
    if format == "table":
        writer.format("parquet").saveAsTable(target)
    elif is_path:
        writer.format(format).save(target)
    else:
        writer.format(format).saveAsTable(target)
    return target


def _stage(df: DataFrame, name: str, partition_by: Sequence[str]) -> str:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def stage_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    return the re-read table.

    Used where a model is a table in the pipelines and is read several
    times downstream: lineage is cut (a lost executor re-reads files instead
    of recomputing the upstream joins) and later reads get column pruning
    and filter push-down. ``partition_by`` names columns of few values that
    every later read filters on, so each read opens only its own folders.
    The write's own shuffle files go when it is done.
    """
    return df.sparkSession.read.parquet(_stage(df, name, partition_by))


@contextmanager
def held_tables(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """:func:`stage_table` for the steps within, which write what they make of its tables: these go at their end."""
    paths = []

    def hold(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        paths.append(_stage(df, name, partition_by))
        return spark.read.parquet(paths[-1])

    try:
        yield hold
    finally:
        for path in paths:
            drop_folder(spark, path)


def create_view(spark: SparkSession, df_or_sql, name: str, lasting: bool = False) -> DataFrame:
    """IO11: create or replace a view.

    ``lasting`` puts it into the catalog, where other sessions find it; that
    takes SQL text over catalog tables or views (a frame lives in its session). Otherwise it is a
    temporary view of this session, from a DataFrame or SQL text.
    """
    if lasting:
        if not isinstance(df_or_sql, str):
            raise ValueError("a lasting view is defined by SQL text")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {df_or_sql}")
        return spark.table(name)
    df = spark.sql(df_or_sql) if isinstance(df_or_sql, str) else df_or_sql
    df.createOrReplaceTempView(name)
    return spark.table(name)


def split_extract(df: DataFrame, column: str, values: Iterable) -> dict:
    """IO13: one extract per category value of ``column``.

    Each entry is a lazily filtered frame, so the filter reaches the scan
    (or the JDBC query) of each load; writing ``df`` once with
    ``partitionBy(column)`` is the one-pass alternative.
    """
    return {v: df.where(F.col(column) == F.lit(v)) for v in values}
