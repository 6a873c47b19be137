"""Full refreshes that never show half a table (IO10), with checks in the write pass (Q1-Q3).

A refresh writes a fresh folder first. A folder target is then swapped by two
renames, a catalog table is pointed at the new folder; until then, and whenever
the write or a check fails, readers find the old rows. The plan may read the
table it refreshes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import shuffles_released


class ChecksFailed(ValueError):
    """The new rows break a rule; ``failures`` maps (columns, test) to a count."""

    def __init__(self, target: str, failures: dict) -> None:
        super().__init__(f"{target} not published: {failures}")
        self.failures = failures


@dataclass(frozen=True)
class Published:
    rows: int
    failures: dict


def _cols(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    where, fs = _hadoop(spark, path)
    fs.delete(where, True)


def watched(df: DataFrame, not_null: Sequence = (), unique: Sequence = ()) -> tuple[DataFrame, Observation, list]:
    """``df`` with the rules' failures counted as its rows pass (metrics ``f0``, ``f1``, ... and ``rows``).

    Not-null: rows with a null in the columns. Unique: key values that stand more than once;
    each key needs its rows together, so a unique rule adds one shuffle by its key to the write
    (rows with a null key are not tested, and spread).
    """
    rules, counts, ranks = [], [], []
    for c in not_null:
        bad = reduce(lambda a, b: a | b, [F.col(x).isNull() for x in _cols(c)])
        counts.append(F.count(F.when(bad, 1)))
        rules.append((",".join(_cols(c)), "not_null"))
    columns = df.columns
    for k, c in enumerate(unique):
        keys = _cols(c)
        null = reduce(lambda a, b: a | b, [F.col(x).isNull() for x in keys])
        rank, salt = f"__tm_rank{k}", f"__tm_salt{k}"
        spread = F.when(null, F.monotonically_increasing_id()).otherwise(F.lit(-1))
        df = df.withColumn(salt, spread)
        df = df.withColumn(rank, F.row_number().over(Window.partitionBy(salt, *keys).orderBy(salt))).drop(salt)
        ranks.append(rank)
        counts.append(F.count(F.when(F.col(rank) == 2, 1)))
        rules.append((",".join(keys), "unique"))
    seen = Observation()
    metrics = [c.alias(f"f{k}") for k, c in enumerate(counts)]
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).select(*columns)
    return out, seen, rules


def swap_folder(spark: SparkSession, new: str, target: str) -> None:
    """Put the folder ``new`` in the place of ``target``."""
    target = target.rstrip("/")
    place, fs = _hadoop(spark, target)
    old, _ = _hadoop(spark, f"{target}__old-{uuid.uuid4().hex}")
    fresh, _ = _hadoop(spark, new)
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise OSError(f"cannot move {target} away")
    if not fs.rename(fresh, place):
        if had:
            fs.rename(old, place)
        raise OSError(f"cannot move {new} to {target}")
    if had:
        fs.delete(old, True)
    spark.catalog.refreshByPath(target)


def point_table(spark: SparkSession, name: str, folder: str, schema, format: str = "parquet",
                partition_by: Sequence[str] = ()) -> None:
    """Make the catalog table ``name`` read ``folder``; it is created when absent or of another schema."""
    if spark.catalog.tableExists(name):
        told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").select("col_name", "data_type").collect()}
        same = [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]
        if same and not partition_by and told.get("Type") == "EXTERNAL" and told.get("Provider", "").lower() == format:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} USING {format} LOCATION '{folder}'")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def _version(spark: SparkSession, target: str, is_path: bool) -> str:
    if is_path:
        return f"{target.rstrip('/')}__new-{uuid.uuid4().hex}"
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{root}/{target.replace('`', '').replace('.', '/')}__versions/v-{uuid.uuid4().hex}"


def refresh(df: DataFrame, target: str, *, is_path: bool, format: str = "parquet", partition_by: Sequence[str] = (),
            not_null: Sequence = (), unique: Sequence = ()) -> Published:
    """Write ``df`` to a fresh folder, test the rules on the rows written, and only then show it as ``target``.

    Raises :class:`ChecksFailed` and leaves the old rows when a rule fails. A catalog table keeps the version
    before the new one, which running readers may still read; older ones go.
    """
    spark = df.sparkSession
    folder = _version(spark, target, is_path)
    out, seen, rules = watched(df, not_null, unique)
    try:
        with shuffles_released(spark):
            out.write.format(format).partitionBy(*partition_by).save(folder)
        got = seen.get
        failures = {rule: got[f"f{k}"] for k, rule in enumerate(rules)}
        if any(failures.values()):
            raise ChecksFailed(target, {r: n for r, n in failures.items() if n})
    except BaseException:
        drop_folder(spark, folder)
        raise
    if is_path:
        swap_folder(spark, folder, target)
    else:
        before = _location(spark, target)
        point_table(spark, target, folder, df.schema, format, partition_by)
        _drop_older(spark, folder, before)
    return Published(got["rows"], failures)


def _location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").select("data_type").first()
    return row and row[0]


def _drop_older(spark: SparkSession, folder: str, before: str | None) -> None:
    """Version folders beside ``folder`` go, but for the one shown before."""
    versions, fs = _hadoop(spark, folder.rsplit("/", 1)[0])
    keep = {folder.rsplit("/", 1)[1], (before or "").rstrip("/").rsplit("/", 1)[-1]}
    for status in fs.listStatus(versions):
        if status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)
