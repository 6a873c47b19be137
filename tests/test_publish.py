"""Refreshes that show all or nothing, checks in the write pass, interleaved layout, lasting views, user bitmaps."""

from __future__ import annotations

import glob
import re
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggs
from tidemark.sources import files, layout, publish


@pytest.fixture
def table(spark):
    name = f"tm_pub_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def failing(df):
    """Rows of which one cannot be made (the write dies half-way)."""
    return df.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))


@pytest.mark.parametrize("kind", ["path", "table"])
def test_failed_refresh_leaves_the_old_rows(spark, tmp_path, table, kind):
    target = f"{tmp_path}/t" if kind == "path" else table
    files.materialize(spark.range(5), target, format="parquet" if kind == "path" else "table")
    read = lambda: sorted(r[0] for r in files.read_source(spark, target).collect())
    with pytest.raises(Exception, match="boom"):
        files.materialize(failing(spark.range(0, 2000, 1, 8)), target, format="parquet" if kind == "path" else "table")
    assert read() == list(range(5))
    files.materialize(files.read_source(spark, target).where("id > 2"), target,  # reads what it refreshes
                      format="parquet" if kind == "path" else "table")
    assert read() == [3, 4]
    assert not glob.glob(f"{tmp_path}/t__*")


def test_table_refresh_switches_the_location(spark, table):
    for k in range(4):
        files.materialize(spark.range(k), table, format="table")
        assert spark.table(table).count() == k and spark.newSession().table(table).count() == k
    where = publish._location(spark, table)
    folder, fs = publish._hadoop(spark, where.rsplit("/", 1)[0])
    assert len(fs.listStatus(folder)) == 2  # this version and the one before
    files.materialize(spark.range(3).withColumn("x", F.lit("a")), table, format="table")  # another schema
    assert spark.table(table).columns == ["id", "x"]
    files.materialize(spark.range(6).withColumn("p", F.col("id") % 2), table, format="table", partition_by=["p"])
    assert spark.table(table).where("p = 1").count() == 3
    spark.range(2).write.mode("overwrite").saveAsTable(table)  # a managed table of another writer
    files.materialize(spark.range(9), table, format="table")
    assert spark.table(table).count() == 9


def test_checks_in_the_write_pass(spark, tmp_path):
    target = f"{tmp_path}/t"
    good = spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (None, "d")], "k long, v string")
    got = publish.refresh(good, target, is_path=True, unique=["k", ["k", "v"]])
    assert got == publish.Published(4, {("k", "unique"): 0, ("k,v", "unique"): 0})
    bad = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, "c"), (2, "c"), (3, None)], "k long, v string")
    with pytest.raises(publish.ChecksFailed) as e:
        files.materialize(bad, target, not_null=["v", ["k", "v"]], unique=["k", ["k", "v"]])
    assert e.value.failures == {("v", "not_null"): 2, ("k,v", "not_null"): 2, ("k", "unique"): 2, ("k,v", "unique"): 1}
    assert spark.read.parquet(target).count() == 4
    with pytest.raises(ValueError, match="overwrite"):
        files.materialize(bad, target, mode="append", unique=["k"])


def test_checks_take_no_second_scan(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    out, _, _ = publish.watched(orders, ["o_custkey"], ["o_orderkey"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and out.columns == orders.columns


def opened(folder, column, low, high):
    """Files whose statistics let the filter pass, and all files."""
    hit = paths = 0
    for path in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.to_arrow_schema().get_field_index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        paths += 1
        hit += any(s.min <= high and s.max >= low for s in stats)
    return hit, paths


def test_interleaved_layout_prunes_on_every_column(spark, sf_small, tmp_path):
    items = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    cols = ["l_orderkey", "l_partkey", "l_extendedprice"]
    files.materialize(items, f"{tmp_path}/z", cluster_by=cols, interleave=True, files_per_partition=64)
    files.materialize(items, f"{tmp_path}/r", cluster_by=cols, files_per_partition=64)
    assert spark.read.parquet(f"{tmp_path}/z").exceptAll(items).count() == 0
    for c in cols:
        value = items.approxQuantile(c, [0.3], 0.01)[0]
        hit, all_files = opened(f"{tmp_path}/z", c, value, value)
        assert hit < all_files / 2, c
    assert opened(f"{tmp_path}/r", c, value, value)[0] > all_files / 2  # by range: no help on the third


def test_interleaved_layout_of_odd_columns(spark, tmp_path):
    rows = [(None if k % 7 == 0 else f"name {k % 13}", None if k % 5 == 0 else k / 3, k % 2 == 0) for k in range(300)]
    df = spark.createDataFrame(rows, "s string, x double, b boolean").withColumns(
        {"d": F.date_add(F.lit("2024-01-01").cast("date"), F.col("x").cast("int")), "same": F.lit(1)})
    files.materialize(df, f"{tmp_path}/z", cluster_by=["s", "x", "b", "d", "same"], interleave=True, files_per_partition=5)
    assert spark.read.parquet(f"{tmp_path}/z").exceptAll(df).count() == 0
    # one cell holds all rows: the row hash still splits them
    spread = layout.z_ordered(df, ["same"], files=5).groupBy(F.spark_partition_id()).count()
    assert spread.count() == 5
    files.materialize(df.limit(0), f"{tmp_path}/e", cluster_by=["s", "x"], interleave=True)
    assert spark.read.parquet(f"{tmp_path}/e").count() == 0


def test_lasting_views(spark, table):
    files.materialize(spark.range(5), table, format="table")
    view = f"{table}_view"
    try:
        files.create_view(spark, f"SELECT id FROM {table} WHERE id > 2", view, lasting=True)
        assert spark.newSession().table(view).count() == 2
        files.create_view(spark, f"SELECT id FROM {table}", view, lasting=True)
        assert spark.newSession().table(view).count() == 5
        files.materialize(spark.range(8), table, format="table")  # the view follows the refreshed table
        assert spark.newSession().table(view).count() == 8
        with pytest.raises(ValueError):
            files.create_view(spark, spark.range(1), view, lasting=True)
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {view}")


def test_user_bitmaps_merge(spark, tmp_path):
    rows = [(d, m, u) for d in range(4) for m in "ab" for u in (d, 3, 40_000 + d, -5, None, 2**40 + d)]
    df = spark.createDataFrame(rows, "day int, mode string, user long")
    days = aggs.user_bitmaps(df, ["day", "mode"], "user")
    days.write.partitionBy("day").parquet(f"{tmp_path}/days")
    before = set(glob.glob(f"{tmp_path}/days/*/*.parquet"))
    # a new day writes its own folder, from its own rows
    new = spark.createDataFrame([(4, "a", 3), (4, "a", 77)], "day int, mode string, user long")
    aggs.user_bitmaps(new, ["day", "mode"], "user").write.mode("append").partitionBy("day").parquet(f"{tmp_path}/days")
    added = set(glob.glob(f"{tmp_path}/days/*/*.parquet")) - before
    assert added and all(re.search("day=4", p) for p in added)
    kept = spark.read.parquet(f"{tmp_path}/days")
    both = df.unionByName(new)
    for keys in ([], ["mode"], ["day"], ["day", "mode"]):
        want = both.groupBy(*keys).agg(F.countDistinct("user").alias("n"))
        assert sorted(map(tuple, aggs.bitmap_users(kept, keys, "n").select(*keys, "n").collect())) == sorted(
            map(tuple, want.select(*keys, "n").collect()))
