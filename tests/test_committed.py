"""Committed windows, marks without a scan and windows of equal load on Spark tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from tidemark.plans import io_queries
from tidemark.sources import committed, incremental
from tidemark.sources.windows import plan_equal_windows

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/events.parquet")


def same(a, b):
    cols = sorted(a.columns)
    return sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


def run(events, target, **kw):
    kw = {"initial_start": START, "now": datetime(2024, 3, 1), "num_days": 20,
          "interval_hours": 120} | kw
    return committed.append_all(events, target, "ts", **kw)


@pytest.mark.parametrize("when", ["before the rows", "after the rows", "half a record"])
def test_a_killed_run_repeats_and_skips_nothing(spark, events, tmp_path, monkeypatch, when):
    target = f"{tmp_path}/t"
    write, commit = committed._write, committed._commit

    class Killed(Exception):
        pass

    def dying_write(rows, folder, partition_by):
        if folder.endswith("batch=4") and when == "before the rows":
            raise Killed
        write(rows, folder, partition_by)

    def dying_commit(spark, target, record):
        if record.number == 4 and when != "before the rows":
            if when == "half a record":
                (tmp_path / "t/commits/_0000000004.json").write_text('{"number": 4, "sta')
            raise Killed
        commit(spark, target, record)

    monkeypatch.setattr(committed, "_write", dying_write)
    monkeypatch.setattr(committed, "_commit", dying_commit)
    with pytest.raises(Killed):
        run(events, target, partition_by=("event_type",))
    part = committed.committed_rows(spark, target)
    assert same(part, events.where(F.col("ts") < F.lit(START + timedelta(days=20)).cast("timestamp_ntz")))
    monkeypatch.setattr(committed, "_write", write)
    monkeypatch.setattr(committed, "_commit", commit)
    records = run(events, target, partition_by=("event_type",))
    assert records[0].number == 4 and same(committed.committed_rows(spark, target), events)
    assert run(events, target) == []


def test_gaps_late_rows_and_null_times(spark, tmp_path):
    target, sec = f"{tmp_path}/t", lambda s: START + timedelta(seconds=s)
    rows = [(1, sec(0)), (2, sec(5)), (3, sec(86400 * 40)), (4, None)]
    df = lambda r: spark.createDataFrame(r, "id long, ts timestamp_ntz")
    now = sec(86400 * 40 + 100)
    records = run(df(rows), target, now=now)
    assert sorted(r[0] for r in committed.committed_rows(spark, target).select("id").collect()) == [1, 2, 3]
    assert sum(r.rows == 0 for r in records) > 5 and records[-1].open
    assert run(df(rows), target, now=now) == []
    # a row of the open range that was not there yet, and a new one
    rows += [(5, sec(86400 * 40 + 50)), (6, sec(86400 * 40 + 200))]
    run(df(rows), target, now=sec(86400 * 40 + 300))
    got = sorted(r[0] for r in committed.committed_rows(spark, target).select("id").collect())
    assert got == [1, 2, 3, 5, 6]
    assert committed.mark_of(spark, target) == sec(86400 * 40 + 200)


def test_mark_needs_no_scan(spark, events, tmp_path, monkeypatch):
    target = f"{tmp_path}/t"
    assert incremental.max_updated_at(spark, target, "ts") is None  # absent
    run(events.limit(0), target)
    assert incremental.max_updated_at(spark, target, "ts") is None  # empty
    nulls = f"{tmp_path}/n"
    run(events.withColumn("ts", F.lit(None).cast("timestamp_ntz")), nulls)
    assert incremental.max_updated_at(spark, nulls, "ts") is None
    assert committed.committed_rows(spark, nulls).count() == 0
    full = f"{tmp_path}/f"
    run(events, full)
    monkeypatch.setattr(committed, "committed_rows", None)
    (tmp_path / "f/rows").rename(tmp_path / "f/away")  # the rows are not looked at
    assert incremental.max_updated_at(spark, full, "ts") == events.agg(F.max("ts")).first()[0]


def test_two_runs_at_a_time(spark, events, tmp_path, monkeypatch):
    target = f"{tmp_path}/t"
    record = run(events, target, now=datetime(2024, 1, 2))[0]
    with pytest.raises(RuntimeError, match="another run"):
        committed._commit(spark, target, record)


def test_range_filter_reaches_the_scan(spark, events):
    text = committed.between(events, "ts", START, START + timedelta(days=1))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_equal_windows_on_skewed_times(spark):
    rnd = random.Random(1)
    times = [START + timedelta(seconds=rnd.paretovariate(0.6)) for _ in range(4000)]
    times += [START + timedelta(days=20, microseconds=k) for k in range(3000)] + [None] * 50
    end = datetime(2030, 1, 1)
    times = [t for t in times if t is None or t < end]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz").repartition(4)
    windows = plan_equal_windows(df, "ts", 24, START, end)
    have = [t for t in times if t is not None]
    counts = [sum(lo <= t < hi for t in have) for lo, hi in windows]
    assert windows[0][0] == START and windows[-1][1] == end and sum(counts) == len(have)
    assert all(a[1] == b[0] for a, b in zip(windows, windows[1:])) and len(windows) == 24
    assert max(counts) <= 2 * median(counts) and max(counts) - min(counts) <= 1
    assert plan_equal_windows(df, "ts", 1, START, end) == [(START, end)]
    assert plan_equal_windows(df.limit(0), "ts", 9, START, end) == [(START, end)]
    assert plan_equal_windows(df, "ts", 9, end, START) == []


def test_equal_windows_never_part_an_instant(spark):
    df = spark.createDataFrame([(START + timedelta(seconds=max(0, k - 60)),) for k in range(100)], "ts timestamp_ntz")
    windows = plan_equal_windows(df, "ts", 10, START, START + timedelta(days=1))
    counts = [df.where(f"ts >= timestamp_ntz'{lo}' and ts < timestamp_ntz'{hi}'").count() for lo, hi in windows]
    assert sum(counts) == 100 and counts[0] >= 61 and len(windows) < 10


def test_equal_windows_drive_a_load(spark, events, tmp_path):
    records = run(events, f"{tmp_path}/t", equal_windows=6, num_days=60, now=datetime(2024, 1, 31))
    assert len(records) == 6 and max(r.rows for r in records) <= 2 * median(r.rows for r in records)
    assert same(committed.committed_rows(spark, f"{tmp_path}/t"), events)


def test_load_query_passes_gaps_longer_than_a_run(spark, tmp_path):
    """Types with a 20-day gap and a late first event are read in full."""
    at = lambda day: datetime(2024, 1, 1) + timedelta(days=day)
    rows = [(1, at(0), 1, "a", 1.0, "{}"), (2, at(25), 1, "a", 1.0, "{}"), (3, at(24), 1, "b'c", 1.0, "{}")]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    df.write.parquet(f"{tmp_path}/events.parquet")
    assert sorted(r[0] for r in io_queries.incremental_load(spark, str(tmp_path)).collect()) == [1, 2, 3]
