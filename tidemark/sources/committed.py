"""Incremental append of a Spark table by committed windows (IO5, IO6).

The target folder holds ``rows/batch=<n>`` and one small record a batch in
``commits``. A run takes up where the last record ends, reads a range of the
source for each batch, writes the batch's folder and then its record; a batch
without a record does not count: readers pass it over and the next run writes
it again. So a run that dies anywhere repeats and skips nothing. Each record
holds the newest time of its batch, gathered by the write itself, so the mark
(IO6) is read from the records and no column of the target is scanned.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.jdbc import plan_windows
from tidemark.sources.windows import between, plan_equal_windows, wall_clock

# Defaults of the incremental loader.
INITIAL_START = datetime(2025, 7, 25)
NUM_DAYS_TO_LOAD = 30
INTERVAL_HOURS = 24

_SECOND = "%Y-%m-%dT%H:%M:%S.%f"
_RECORD = "number long, start string, end string, open boolean, rows long, mark string, columns string, partition_by string"


@dataclass(frozen=True)
class Record:
    """What one batch has committed; ``open``: its end was the run's ``now``, so later rows of
    its range may still come. ``mark`` is the target's, not only the batch's."""

    number: int
    start: datetime
    end: datetime
    open: bool
    rows: int
    mark: datetime | None
    columns: str
    partition_by: str


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def is_committed(spark: SparkSession, target: str) -> bool:
    """True when the folder has commit records."""
    folder, fs = _folder(spark, f"{target.rstrip('/')}/commits")
    return bool(fs.exists(folder))


def last_record(spark: SparkSession, target: str) -> Record | None:
    """The newest record of the target; None without one."""
    if not is_committed(spark, target):
        return None
    rows = spark.read.schema(_RECORD).json(f"{target.rstrip('/')}/commits").orderBy(F.desc("number")).limit(1).collect()
    if not rows:
        return None
    r = rows[0].asDict()
    times = {k: None if r[k] is None else datetime.strptime(r[k], _SECOND) for k in ("start", "end", "mark")}
    return Record(**{**r, **times})


def _commit(spark: SparkSession, target: str, record: Record) -> None:
    """Write the record beside its place and rename it there; a record that is there already ends the run."""
    place, fs = _folder(spark, f"{target.rstrip('/')}/commits/{record.number:010d}.json")
    beside, _ = _folder(spark, f"{target.rstrip('/')}/commits/_{record.number:010d}.json")
    if fs.exists(place):
        raise RuntimeError(f"batch {record.number} of {target} was committed by another run")
    values = {k: v.strftime(_SECOND) if isinstance(v, datetime) else v for k, v in asdict(record).items()}
    out = fs.create(beside, True)
    try:
        out.write(bytearray(json.dumps(values), "utf-8"))
    finally:
        out.close()
    if not fs.rename(beside, place):
        raise RuntimeError(f"batch {record.number} of {target} was committed by another run")


def _write(rows: DataFrame, folder: str, partition_by: list[str]) -> None:
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


def append_windows(source: DataFrame, target: str, ts_col: str, *, initial_start: datetime = INITIAL_START,
                   num_days: float = NUM_DAYS_TO_LOAD, interval_hours: float = INTERVAL_HOURS,
                   equal_windows: int | None = None, now: datetime | None = None, base_filter=None,
                   partition_by: tuple[str, ...] = ()) -> list[Record]:
    """IO5: one run: append the source's rows that follow the target's last record.

    A run covers ``num_days`` at most and never passes ``now``, in windows of
    ``interval_hours`` or, if given, in ``equal_windows`` windows of equal load; each
    window is one Spark job and one record, in order. ``base_filter`` (a column or SQL text) restricts the
    extract (IO13), ``partition_by`` lays its categories out as folders.
    The next run starts at the last record's end; where that end was ``now``, one microsecond after
    the mark, so rows that came late for the open range are still taken. A window without rows is
    recorded as well: a gap in the source ends no load. Rows with a null time are in no window. Returns the new
    records (none when there is nothing left to do).
    """
    spark, target = source.sparkSession, target.rstrip("/")
    last = last_record(spark, target)
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    if last is None:
        start = initial_start
    elif last.open and last.mark is not None:
        start = max(last.start, last.mark + timedelta(microseconds=1))
    else:
        start = last.start if last.open else last.end
    if last is not None and last.open and last.end >= now:
        return []  # nothing new can have come
    end = min(start + timedelta(days=num_days), now)
    if base_filter is not None:
        source = source.where(base_filter)
    if equal_windows:
        windows = plan_equal_windows(source, ts_col, equal_windows, start, end)
    else:
        windows = plan_windows(start, end, interval_hours)
    done: list[Record] = []
    for lo, hi in windows:
        seen = Observation()
        rows = between(source, ts_col, lo, hi).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.max(wall_clock(source, ts_col).cast("string")).alias("mark"))
        number = 0 if last is None else last.number + 1
        _write(rows, f"{target}/rows/batch={number}", list(partition_by))
        got = seen.get
        mark = None if got["mark"] is None else datetime.fromisoformat(got["mark"])
        mark = max((m for m in (mark, last and last.mark) if m is not None), default=None)
        last = Record(number, lo, hi, hi == now, got["rows"], mark, source.schema.json(), ",".join(partition_by))
        _commit(spark, target, last)
        done.append(last)
    return done


def append_all(source: DataFrame, target: str, ts_col: str, **kw) -> list[Record]:
    """Runs of :func:`append_windows` until none has anything left to do."""
    kw["now"] = kw.get("now") or datetime.now(timezone.utc).replace(tzinfo=None)
    done: list[Record] = []
    while new := append_windows(source, target, ts_col, **kw):
        done += new
    return done


def committed_rows(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all committed batches; folders without a record are pruned from the scan."""
    last = last_record(spark, target)
    if last is None:
        raise FileNotFoundError(f"{target} has no committed batch")
    schema = T.StructType.fromJson(json.loads(last.columns))
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(with_batch).parquet(f"{target.rstrip('/')}/rows")
    return rows.where(F.col("batch") <= last.number).select(*schema.names)


def mark_of(spark: SparkSession, target: str) -> datetime | None:
    """IO6: newest time in the target, from its records; None when it is absent, empty or has null times only."""
    last = last_record(spark, target)
    return None if last is None else last.mark
