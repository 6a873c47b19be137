"""Sinks and sources on local files and embedded Derby (no server, no port)."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import stage
from tidemark.sources import files, incremental, jdbc

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _url():
    return f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"


def test_materialize_jdbc_and_unknown_sink(spark, sf_small):
    nation = spark.read.parquet(f"{sf_small}/nation.parquet")
    url = _url()
    files.materialize(nation, "NATION", format="jdbc", jdbc_url=url, jdbc_properties=DERBY)
    back = jdbc.read_jdbc_query(spark, url, "SELECT * FROM NATION", DERBY)
    assert back.count() == nation.count()
    with pytest.raises(ValueError):
        files.materialize(nation, "x", format="csv-ish")


def test_materialize_clustered_layout_and_staged_overwrite(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    target = tempfile.mkdtemp(prefix="tm-mat-") + "/orders"
    files.materialize(orders, target, cluster_by=["o_orderstatus"], files_per_partition=3)
    again = spark.read.parquet(target).where(F.col("o_orderstatus") != "P")
    files.materialize(again, target)          # plan reads the target: staged first
    assert spark.read.parquet(target).count() == orders.where("o_orderstatus <> 'P'").count()


def test_incremental_load_resumes_without_holes(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    url = _url()
    ev.write.option("createTableColumnTypes", "event_type VARCHAR(32)").jdbc(url, "EV", properties=DERBY)
    target = tempfile.mkdtemp(prefix="tm-inc-") + "/ev"
    now = dt.datetime(2024, 1, 31)
    w1 = incremental.incremental_load(spark, url, "EV", target, ts_col='"ts"', mark_col="ts",
                                      initial_start="2024-01-01T00:00:00.00", num_days=5, interval_hours=6,
                                      properties=DERBY, now=now)
    assert len(w1) == 20
    w2 = incremental.incremental_load(spark, url, "EV", target, ts_col='"ts"', mark_col="ts",
                                      num_days=60, properties=DERBY, now=now)
    assert w2[0][0] > w1[-1][0]
    loaded = spark.read.parquet(target)
    assert loaded.count() == ev.where(F.col("ts") < F.lit(now)).count()
    assert loaded.groupBy("event_id").count().where("count > 1").count() == 0


def test_window_predicates_and_probe(spark, sf_small):
    preds = jdbc.window_predicates("ts", [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))], "kind = 'a'")
    assert preds == ["(kind = 'a') AND ts >= '2024-01-01 00:00:00.000000' "
                     "AND ts < '2024-01-02 00:00:00.000000'"]
    url = _url()
    spark.read.parquet(f"{sf_small}/region.parquet").write.jdbc(url, "R", properties=DERBY)
    assert [f.name for f in jdbc.probe_schema(spark, url, "R", DERBY).fields] == ["r_regionkey", "r_name"]


def test_ordered_pg_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert [r[0] for r in stage.ordered(df, [("x", "asc")], pg_nulls=True).collect()] == [1, 2, None]
    assert [r[0] for r in stage.ordered(df, [("x", "desc")], pg_nulls=True).collect()] == [None, 2, 1]
    assert [r[0] for r in stage.ordered(df, [("x", "desc")]).collect()] == [2, 1, None]


def test_catalog_table_sink_view_and_read_source(spark, sf_small):
    region = spark.read.parquet(f"{sf_small}/region.parquet")
    name = f"tm_region_{uuid.uuid4().hex[:8]}"
    files.materialize(region, name, format="table", cluster_by=["r_regionkey"])
    assert files.read_source(spark, name).count() == region.count()          # catalog table
    files.materialize(spark.table(name).where("r_regionkey > 0"), name, format="table")  # staged self-overwrite
    assert spark.table(name).count() == region.count() - 1
    view = files.create_view(spark, f"SELECT r_name FROM {name}", f"{name}_v")
    assert view.columns == ["r_name"] and spark.table(f"{name}_v").count() == region.count() - 1
    parts = files.split_extract(region, "r_name", ["ASIA", "EUROPE"])
    assert {k: v.count() for k, v in parts.items()} == {"ASIA": 1, "EUROPE": 1}


def test_type_map_is_exact():
    expect = {"int2": "int", "int4": "int", "int8": "bigint", "bigint": "bigint", "float4": "float",
              "real": "float", "float8": "double", "double precision": "double", "numeric": "decimal(38,18)",
              "decimal": "decimal(38,18)", "bool": "boolean", "boolean": "boolean", "date": "date",
              "timestamp": "timestamp", "timestamptz": "timestamp", "jsonb": "string", "json": "string",
              "text": "string", "varchar": "string", "char": "string", "uuid": "string", "cidr": "string",
              "inet": "string", "macaddr": "string", "interval": "string", "d": "string", "te": "string"}
    assert {k: jdbc.spark_type_for(k).simpleString() for k in expect} == expect
    schema = jdbc.schema_from_type_names([("a", "int8"), ("b", "numeric")])
    assert jdbc.custom_schema_ddl(schema) == "a bigint, b decimal(38,18)"
    assert all(f.nullable for f in schema.fields)


def test_incremental_load_into_catalog_table(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"))
    url = _url()
    ev.write.jdbc(url, "EV2", properties=DERBY)
    target = f"tm_inc_{uuid.uuid4().hex[:8]}"
    assert incremental.max_updated_at(spark, target, "ts") is None          # absent table
    incremental.incremental_load(spark, url, "EV2", target, ts_col='"ts"', mark_col="ts",
                                 initial_start="2024-01-01T00:00:00.00", num_days=40, properties=DERBY,
                                 now=dt.datetime(2024, 2, 1))
    assert spark.table(target).count() == ev.count()
    again = incremental.incremental_load(spark, url, "EV2", target, ts_col='"ts"', mark_col="ts",
                                         properties=DERBY, now=dt.datetime(2024, 2, 1))
    assert spark.table(target).count() == ev.count()                        # nothing appended twice
    assert all(lo > dt.datetime(2024, 1, 30) for lo, _ in again)


def test_delta_sink_is_gated(spark, sf_small):
    nation = spark.read.parquet(f"{sf_small}/nation.parquet")
    if files._delta_available(spark):  # pragma: no cover - not in this image
        pytest.skip("delta present")
    with pytest.raises(RuntimeError, match="Delta Lake"):
        files.materialize(nation, tempfile.mkdtemp(prefix="tm-delta-") + "/n", format="delta")
