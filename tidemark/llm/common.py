"""Helpers the operators share: reading tables, lineage cuts, text passes."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lower-cases A-Z, turns every other ASCII byte that is not a
# digit or a letter into a space; bytes of non-ASCII characters stay.
ALNUM_TABLE = bytes(
    (c + 32) if 0x41 <= c <= 0x5A else c if (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80) else 0x20
    for c in range(256)
)

# A small side is broadcast up to this many rows (counted, not estimated).
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    from tidemark.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def id_remainder(n: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(ALNUM_TABLE).split()


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
    return [v if v is not None else b"" for v in values]


def add_columns(df: DataFrame, text: str, fields: list[T.StructField],
                compute: Callable[[list[bytes]], list], drop: tuple[str, ...] = ()) -> DataFrame:
    """Append columns computed from whole texts, one Arrow batch at a time.

    ``compute`` gets the batch's texts and returns one list or array per
    field. Arrow batches are bounded in bytes by Spark, so memory does not
    grow with the partition.
    """
    kept = [f for f in df.schema.fields if f.name not in drop]
    keep = [f.name for f in kept]
    schema = T.StructType(kept + fields)
    types = [_arrow_type(f.dataType) for f in fields]
    names = keep + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = compute(text_bytes(batch, text))
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            cols += [pa.array(v, type=t) for v, t in zip(new, types, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.mapInArrow(run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
            "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}[t.simpleString()]


def worker_cache(key: str, build: Callable):
    """What ``build`` makes, once for each Python worker and key. The store is
    a module of its own as shipped functions bring fresh globals to each task."""
    store = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]


def field(name: str, kind: str) -> T.StructField:
    """A nullable field; ``array:kind`` is an array of that kind."""
    kinds = {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
             "boolean": T.BooleanType(), "int": T.IntegerType(), "binary": T.BinaryType(), "float": T.FloatType()}
    if kind.startswith("array:"):
        return T.StructField(name, T.ArrayType(kinds[kind[6:]]), True)
    return T.StructField(name, kinds[kind], True)


def by_keys(docs: DataFrame, side: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows of ``docs`` whose keys (nulls equal) are in ``side`` ("left_semi")
    or are not ("left_anti").

    ``side`` is counted first: up to ``BROADCAST_ROWS`` keys are broadcast so
    that the texts are not shuffled, more go through a shuffled join. Both
    ways give the same rows.
    """
    names = {k: unused(docs, f"side_{k}") for k in keys}
    side = cut(side.select([F.col(k).alias(names[k]) for k in keys]).distinct())
    if side.count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(names[k]))
    return docs.join(side, cond, how)


def text_key(text: str) -> Column:
    """Hash of the whole text; null and empty texts differ."""
    return F.xxhash64(F.col(text), F.col(text).isNull())
