"""SimHash near-duplicates through keys of several positional bytes.

Two fingerprints of 64 bits that differ in at most ``k`` bits differ in at most ``k`` of their
eight bytes, so they share at least ``8 - k`` (position, byte) entries: the
guaranteed minimum of a count filter. The dealt method, a tally per pair over the postings of
single entries, is replaced: there are only 2,048 such postings, so each grows
with the corpus and the pairs to tally with its square (884 million for the 235,850 distinct
fingerprints of 0.5 GB of text, 3,750 for each of them). Here a key is a set of ``8 - k``
entries, so two fingerprints meet under a key exactly when they share the minimum, no tally is
needed, and a key can hold at most 256^k different fingerprints however large the corpus is.
Under a key, the bit distance is verified on the remaining bytes; the
components found there leave as links to one member (never as all pairs).
Links of all keys are joined into components by alternating star steps.

Only distinct fingerprints are indexed, so copies cost nothing. Defined
results: null or empty texts have fingerprint zero and link like any other; a
null doc_id takes part but never names a component unless all its ids are
null (then null); repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import add_columns, by_keys, cut, field, text_key, unused

SHINGLE = 3
MAX_BITS = 2
# Fingerprints with over one in so many of the rows are looked up by broadcast.
HOT_PARTS = 1000


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, as a signed integer."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        hashes = [xxh64_intdigest(b" ".join(words), 42)]
    else:
        flat = b" ".join(words)
        gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
        starts = [0, *(gaps + 1).tolist()]
        ends = [*gaps.tolist(), len(flat)]
        hashes = [xxh64_intdigest(flat[s:e], 42) for s, e in zip(starts, ends[width - 1:], strict=False)]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", width: int = SHINGLE,
                 drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the fingerprint of each whole text."""
    return add_columns(docs, text, [field(name, "long")], lambda texts: [[fingerprint(b, width) for b in texts]],
                       drop=drop)


def _local_links(rests: list[int], max_bits: int, width: int) -> list[int]:
    """For each of the distinct remainders, the index of its component's first
    member, linking remainders at ``max_bits`` or fewer differing bits."""
    n = len(rests)
    root = [-1] * n
    flips = [sum(1 << b for b in c) for k in range(1, max_bits + 1) for c in combinations(range(width), k)]
    where = {v: i for i, v in enumerate(rests)}
    left = dict(where)
    for i in range(n):
        if root[i] >= 0:
            continue
        root[i] = i
        left.pop(rests[i], None)
        todo = [rests[i]]
        while todo:
            v = todo.pop()
            if len(left) < len(flips):
                near = [u for u in left if (u ^ v).bit_count() <= max_bits]
            else:
                near = [v ^ f for f in flips if v ^ f in left]
            for u in near:
                root[left.pop(u)] = i
            todo.extend(near)
    return root


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b), a > b, between distinct fingerprints ``fp``: a star per
    verified component under every posting key."""
    positions = list(combinations(range(8), max_bits))  # the bytes a key leaves out
    masks = []
    for out in positions:
        m = (1 << 64) - 1
        for p in out:
            m &= ~(0xFF << (8 * p))
        masks.append(m - (1 << 64) if m >> 63 else m)
    keys = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("v"))
                     for i, m in enumerate(masks)])
    posted = (distinct.select("fp", F.explode(keys).alias("key")).select("fp", "key.k", "key.v")
              .repartition("k", "v").sortWithinPartitions("k", "v", "fp"))

    def verified(k: int, fps: list[int]) -> Iterator[tuple[int, int]]:
        rests = [sum(((f >> (8 * p)) & 0xFF) << (8 * j) for j, p in enumerate(positions[k])) for f in fps]
        for i, r in enumerate(_local_links(rests, max_bits, 8 * max_bits)):
            if r != i:
                yield fps[i], fps[r]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((0, 3), np.int64)  # the last key's rows: more may follow
        for batch in batches:
            part = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in (1, 2, 0)], axis=1)
            rows = np.concatenate([rest, part])
            new = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            end = int(new[-1]) if len(new) else 0
            yield _pairs(rows[:end])
            rest = rows[end:]
        yield _pairs(rest)

    def _pairs(rows: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        if len(rows):
            new = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(rows)]])
            many = ends - starts > 1
            for s, e in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
                for x, y in verified(int(rows[s, 0]), rows[s:e, 2].tolist()):
                    a.append(x)
                    b.append(y)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return posted.mapInArrow(verify, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (fp, root) for every node of ``edges`` (a, b): root is the smallest
    node reachable. Alternating large-star and small-star steps; each step
    only re-links nodes to minima, so no group is gathered in one task."""

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    def small_star(e: DataFrame) -> DataFrame:
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.union(low.select("a", F.col("m").alias("b"))).distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    e = cut(edges)
    seen = mark(e)
    while seen[0]:
        e = cut(small_star(large_star(e)))
        now = mark(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("fp"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("fp"), F.col("b").alias("root")).distinct())


def _groups(prints: DataFrame, max_bits: int) -> DataFrame:
    """Rows (fp, n, root, component_id) for every distinct fingerprint of
    ``prints`` (doc_id, fp); n counts its rows."""
    per_fp = cut(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low")))
    roots = components(links(per_fp.select("fp"), max_bits))
    grouped = per_fp.join(roots, "fp", "left").select("fp", "n", "low", F.coalesce("root", "fp").alias("root"))
    low = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    return cut(grouped.join(low, "root").select("fp", "n", "root", "component_id"))


def _attach(prints: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of ``prints`` with their fingerprint's root and component_id.

    Fingerprints with over a thousandth of the rows (so fewer than a
    thousand) are looked up in a broadcast table, the others by a shuffled
    join: a large group of copies stays where it was read.
    """
    floor = max(1000, prints.count() // HOT_PARTS)
    hot = groups.where(F.col("n") > floor).select("fp", F.col("root").alias("hot_root"),
                                                  F.col("component_id").alias("hot_id"), F.lit(True).alias("hot"))
    marked = prints.join(F.broadcast(hot), "fp", "left")
    cold = marked.where(F.col("hot").isNull()).drop("hot", "hot_root", "hot_id").join(
        groups.where(F.col("n") <= floor).select("fp", "root", "component_id"), "fp")
    return cold.unionByName(marked.where("hot").drop("hot").withColumnsRenamed(
        {"hot_root": "root", "hot_id": "component_id"}))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    prints = cut(fingerprints(src, "text", "fp", width, drop=("text",)))
    return _attach(prints, _groups(prints, max_bits)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One document of every near-duplicate group: the one with the smallest
    id (null ids last, then the smaller text hash); of repeated rows with that
    id and text one stays."""
    names = docs.columns
    h = unused(docs, "text_hash")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), text_key(text).alias("key"))
    prints = cut(fingerprints(src, "text", "fp", width, drop=("text",)))
    rows = _attach(prints, _groups(prints, max_bits))
    pairs = cut(rows.groupBy("doc_id", "key").agg(F.min("root").alias("root"), F.count(F.lit(1)).alias("n")))
    keep = cut(pairs.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key", "n")).alias("b"))
               .select("b.doc_id", "b.key", "b.n"))
    kept = keep.select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"))
    gone = pairs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key")),
                      "left_anti")
    keyed = docs.withColumn(h, text_key(text))
    as_doc = [F.col("doc_id").alias(id_col), F.col("key").alias(h)]
    left = by_keys(keyed, gone.select(as_doc), [id_col, h], "left_anti")
    repeated = keep.where("n > 1").select(as_doc)
    if repeated.isEmpty():
        return left.select(names)
    once = by_keys(left, repeated, [id_col, h], "left_anti")
    one = by_keys(left, repeated, [id_col, h], "left_semi").dropDuplicates([id_col, h])
    return once.unionByName(one).select(names)
