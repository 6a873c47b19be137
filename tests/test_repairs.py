"""Source, loader and rank behaviour that small inputs do not show."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tidemark import session
from tidemark.operators import stage
from tidemark.sources import files, incremental

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ranked_union_keeps_every_row(spark, tmp_path, adaptive):
    """A hot key with a third of 240,000 rows; the whole result is written."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(240_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 5000).alias("k"),
            F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("t"), F.repeat(F.lit("x"), 20).alias("pad"), "id")
        out = stage.unify_ranked(df.where("id % 2 = 0"), df.where("id % 2 = 1"), ["k"], "t")
        out.write.parquet(f"{tmp_path}/ranked")
        got = spark.read.parquet(f"{tmp_path}/ranked")
        assert got.count() == 240_000 and got.columns == ["k", "t", "pad", "id", "rn"]
        plain = stage.unify_ranked(df.where("id % 2 = 0"), df.where("id % 2 = 1"), ["k"], "t", skew_safe=False)
        assert got.join(plain.select("id", F.col("rn").alias("want")), "id").where("rn <> want").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_source_by_path_and_after_overwrite(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(path)
    assert files.read_source(spark, path).count() == 3
    spark.range(5).write.mode("overwrite").parquet(path)
    assert files.read_source(spark, path).count() == 5


def test_self_overwrite_keeps_the_layout(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), "id")
    df.repartition(6).write.parquet(path)
    again = spark.read.parquet(path)
    files.materialize(again, path, cluster_by=["a"], files_per_partition=4)
    spans = (spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("a").alias("lo"), F.max("a").alias("hi"))
             .orderBy("lo").collect())
    assert len(spans) > 1 and all(x["hi"] <= y["lo"] for x, y in zip(spans, spans[1:], strict=False))
    assert spark.read.parquet(path).count() == 20_000


def test_self_overwrite_of_a_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS tm_self")
    spark.range(10).write.saveAsTable("tm_self")
    try:
        files.materialize(spark.table("tm_self").where("id < 4"), "tm_self", format="table")
        assert spark.table("tm_self").count() == 4
    finally:
        spark.sql("DROP TABLE tm_self")


def _loader(spark, monkeypatch, bad=None):
    seen = []

    def read(_spark, _url, _table, _ts, windows, *_a, **_k):
        seen.append(len(windows))
        if bad is not None and any(lo.day == bad for lo, _ in windows):
            raise RuntimeError("window fails")
        return spark.createDataFrame([(lo,) for lo, _ in windows], T.StructType([T.StructField("updated_at", T.TimestampNTZType())]))

    monkeypatch.setattr(incremental, "read_jdbc_windows", read)
    return seen


def test_failing_window_keeps_the_ones_before_it(spark, tmp_path, monkeypatch):
    target, start, now = f"{tmp_path}/t", datetime(2024, 1, 1), datetime(2024, 1, 7)
    _loader(spark, monkeypatch, bad=3)
    with pytest.raises(RuntimeError):
        incremental.incremental_load(spark, "url", "t", target, initial_start=start, now=now)
    assert sorted(r[0].day for r in spark.read.parquet(target).collect()) == [1, 2]
    seen = _loader(spark, monkeypatch)
    done = incremental.incremental_load(spark, "url", "t", target, initial_start=start, now=now, connections=2)
    assert done[0][0] == datetime(2024, 1, 2, 0, 0, 0, 1) and max(seen) == 2
    assert incremental.max_updated_at(spark, target) >= datetime(2024, 1, 6)


def test_load_ends_at_utc_now(spark, tmp_path, monkeypatch):
    _loader(spark, monkeypatch)
    start = datetime.now(timezone.utc).replace(tzinfo=None, hour=0, minute=0, second=0, microsecond=0)
    done = incremental.incremental_load(spark, "url", "t", f"{tmp_path}/t", initial_start=start, interval_hours=1000)
    assert abs((done[-1][1] - datetime.now(timezone.utc).replace(tzinfo=None)).total_seconds()) < 300


def test_cluster_sessions_need_a_shared_folder():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_no_forced_hint_outside_the_checked_operators():
    for path in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"F\.broadcast\(|\.hint\(|localCheckpoint", path.read_text()), path


def test_ordered_rows_are_in_order(spark, sf_small):
    from tidemark.plans.basic import ordered_rows

    rows = [tuple(r) for r in ordered_rows(spark, sf_small).collect()]
    want = sorted(rows, key=lambda r: (r[1], r[0]))
    want.sort(key=lambda r: r[2] or "~", reverse=True)  # descending, nulls first
    assert rows == want


def test_unmapped_external_type_warns():
    from tidemark.sources.jdbc import spark_type_for

    with pytest.warns(UserWarning, match="hstore"):
        assert spark_type_for("hstore") == T.StringType()


def test_incremental_query_reads_past_gaps_longer_than_a_run(spark, tmp_path, monkeypatch):
    """A gap of 24 days, a type that begins on day 30; windows are filters on the parquet table."""
    from tidemark.plans import io_queries

    rows = [(1, "a", 0), (2, "a", 1), (3, "a", 25), (4, "b", 30), (5, "b", 31), (6, "a", 70), (7, "c", 44)]
    events = spark.createDataFrame([(i, datetime(2024, 1, 1, 5) + timedelta(days=d), i, t, float(i), "{}") for i, t, d in rows],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(f"{tmp_path}/events.parquet")

    def read(spark, _url, _table, ts, windows, _properties=None, *, base_filter, **_k):
        at = " OR ".join(f"({ts} >= '{lo}' AND {ts} < '{hi}')" for lo, hi in windows)
        return spark.read.parquet(f"{tmp_path}/events.parquet").where(f"{base_filter} AND ({at})".replace('"', "`"))

    monkeypatch.setattr(io_queries, "copy_events_to_derby", lambda *_: "url")
    monkeypatch.setattr(incremental, "read_jdbc_windows", read)
    got = io_queries.incremental_load(spark, str(tmp_path)).collect()
    assert sorted(r["event_id"] for r in got) == [1, 2, 3, 4, 5, 6, 7]
