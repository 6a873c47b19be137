"""Hard-negative mining by segment summary filtering.

Vectors become whole numbers ``floor(256 * x)`` and are packed into chunks, each
row with the mean and deviation (norm of what the mean leaves) of its segments
of four components; segments of 16, 64 and the whole follow from them. For two
vectors a segment adds ``length * mean * mean'`` to the score, give or take
``deviation * deviation'``, so the sums over the segments bound the score. Pairs
are tested with the whole, then with ever shorter segments, and only those that
may still enter a list are scored exactly.

Anchors (rows whose id is divisible by ``every``) are a stated query set; they are
packed into blocks. A block and every so many chunks are one cell of work; the cells are
dealt one after another to the tasks, so a label or a vector that holds a third of
the rows is spread evenly, a block travels once for each of its cells and a chunk once for
each block. Within a cell the block comes first and the chunks stream past it. A
first pass finds each anchor's ``positives`` best rows of the same label, a second the
``negatives`` best of other labels for each positive; a cell hands on
at most that many rows for each list, whatever it has read.

Defined cases: rows with a null label or vector, or a null or non-finite
component, take no part; a null id is never an anchor and comes last among equal
scores; a repeated row is a row of its own; shorter vectors are filled with
zeros; an empty vector scores 0; scores beyond a long stay at its ends; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

SCALE = 256
CHUNK_ROWS, CHUNK_BYTES = 16_384, 4 << 20  # a chunk of rows: whichever comes first
BLOCK_ROWS, BLOCK_BYTES = 16_384, 16 << 20  # a block of anchors: a task holds one and its lists
CELLS = 4  # cells for each task, as nearly as whole blocks and chunks allow
TILE_ANCHORS, TILE_ROWS = 256, 2_048  # pairs looked at together
_END = 2**63 - 1


# Segment summaries -----------------------------------------------------------

def finest(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each row's segments of four."""
    parts = x.reshape(len(x), -1, 4)
    mean = parts.mean(axis=2)
    return mean, np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))


def summaries(mean: np.ndarray, dev: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mean times root of length, deviation) from the whole vector to segments of four."""
    out, length = [(mean * 2.0, dev)], 4
    while mean.shape[1] > 1:
        group = 4 if length < 64 else mean.shape[1]
        m, d = mean.reshape(len(mean), -1, group), dev.reshape(len(dev), -1, group)
        top = m.mean(axis=2)
        dev = np.sqrt((d**2).sum(axis=2) + length * ((m - top[:, :, None]) ** 2).sum(axis=2))
        mean, length = top, length * group
        out.append((mean * np.sqrt(length), dev))
    return out[::-1]


class Vectors:
    """Some rows: ids, labels, whole-number vectors and their summaries."""

    def __init__(self, ids, known, labels, x, mean, dev) -> None:
        self.ids, self.known, self.labels, self.x = ids, known, labels, x
        self.levels = summaries(mean, dev)
        self.norm = np.sqrt((x**2).sum(axis=1))
        self.largest = float(np.abs(x).max()) if x.size else 0.0

    def part(self, start: int, stop: int) -> Vectors:
        new = object.__new__(Vectors)
        cut_ = slice(start, stop)
        new.ids, new.known, new.labels, new.x = (v[cut_] for v in (self.ids, self.known, self.labels, self.x))
        new.levels = [(m[cut_], d[cut_]) for m, d in self.levels]
        new.norm, new.largest = self.norm[cut_], self.largest
        return new


def exact(a: np.ndarray, r: np.ndarray, largest: float) -> np.ndarray:
    """Whole-number inner products; in doubles where these hold every sum exactly."""
    if largest * a.shape[1] < 2**53:
        return (a @ r.T).astype(np.int64)
    whole = [[int(v) for v in row] for row in a], [[int(v) for v in row] for row in r]
    return np.array([[max(-_END, min(_END, sum(map(int.__mul__, p, q)))) for q in whole[1]] for p in whole[0]], np.int64)


def pairs(a: Vectors, r: Vectors, alive: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(anchor, row, score) of the pairs in ``alive`` that the bounds leave
    between ``low`` and ``high`` of their anchor, and some beside."""
    ai, ri = np.arange(len(a.ids)), np.arange(len(r.ids))
    for (am, ad), (rm, rd) in zip(a.levels, r.levels, strict=True):
        keep_a, keep_r = alive.any(axis=1), alive.any(axis=0)
        if not keep_a.any():
            return ai[:0], ri[:0], np.zeros(0, np.int64)
        if not (keep_a.all() and keep_r.all()):
            ai, ri, alive = ai[keep_a], ri[keep_r], alive[np.ix_(keep_a, keep_r)]
        middle, give = am[ai] @ rm[ri].T, ad[ai] @ rd[ri].T
        give += np.outer(a.norm[ai], r.norm[ri]) * 1e-9 + 1e-3  # rounding of the doubles
        # scores stay within a long, and so do their bounds
        least, most = (np.clip(middle + w, -(2.0**63), 2.0**63) for w in (-give, give))
        alive &= (most >= low[ai, None]) & (least <= high[ai, None])
    keep_a, keep_r = alive.any(axis=1), alive.any(axis=0)
    ai, ri, alive = ai[keep_a], ri[keep_r], alive[np.ix_(keep_a, keep_r)]
    if not len(ai):
        return ai, ri, np.zeros(0, np.int64)
    score = exact(a.x[ai], r.x[ri], a.largest * r.largest)
    i, j = np.nonzero(alive)
    return ai[i], ri[j], score[i, j]


class Best:
    """The first ``most`` of each list by score (high first), then id (null last)."""

    def __init__(self, lists: int, most: int) -> None:
        self.most, self.last = most, np.full(lists, -_END - 1, np.int64)
        self.key = self.score = self.ids = np.zeros(0, np.int64)
        self.known = np.zeros(0, bool)

    def add(self, key, score, ids, known) -> None:
        ok = score >= self.last[key]
        if not ok.any():
            return
        new = [np.concatenate(p) for p in zip((self.key, self.score, self.ids, self.known),
                                              (key[ok], score[ok], ids[ok], known[ok]))]
        order = np.lexsort((new[2], ~new[3], -new[1], new[0]))
        key = new[0][order]
        first = np.r_[True, key[1:] != key[:-1]]
        rank = np.arange(len(key)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        keep = order[rank < self.most]
        self.key, self.score, self.ids, self.known = (v[keep] for v in new)
        full = order[rank == self.most - 1]
        self.last[new[0][full]] = new[1][full]


class Block:
    """A block of anchors and the lists it has gathered in this task."""

    def __init__(self, vectors: Vectors, chunk, place, positives, most: int) -> None:
        self.a, self.chunk, self.place, self.positives = vectors, chunk, place, positives
        n = len(chunk)
        if positives is not None:  # scores (n, k), nulls as empty ranges
            score, self.have = positives[0], positives[1]
            self.top = np.where(self.have, score, -_END - 1)
            self.floor = np.where(self.have, score - score // 5, _END)
            self.high = self.top.max(axis=1).astype(float)
        self.best = Best(n if positives is None else n * self.top.shape[1], most)

    def add(self, number: int, rows: Vectors) -> None:
        for s in range(0, len(rows.ids), TILE_ROWS):
            r = rows.part(s, s + TILE_ROWS)
            for t in range(0, len(self.chunk), TILE_ANCHORS):
                self._tile(number, r, s, t, min(t + TILE_ANCHORS, len(self.chunk)))

    def _tile(self, number: int, r: Vectors, s: int, t: int, end: int) -> None:
        a, same = self.a.part(t, end), self.a.labels[t:end, None] == r.labels[None, :]
        if self.positives is None:
            for i in np.flatnonzero(self.chunk[t:end] == number):
                own = self.place[t + i] - s
                if 0 <= own < len(r.ids):
                    same[i, own] = False
            low = self.best.last[t:end].astype(float)
            i, j, score = pairs(a, r, same, low, np.full(end - t, np.inf))
            self.best.add(i + t, score, r.ids[j], r.known[j])
            return
        k = self.top.shape[1]
        low = np.maximum(self.floor[t:end], self.best.last.reshape(-1, k)[t:end]).min(axis=1).astype(float)
        i, j, score = pairs(a, r, ~same & self.have[t:end].any(axis=1)[:, None], low, self.high[t:end])
        for p in range(k):
            fits = (score <= self.top[i + t, p]) & (score >= self.floor[i + t, p])
            self.best.add((i[fits] + t) * k + p, score[fits], r.ids[j[fits]], r.known[j[fits]])


# Spark side --------------------------------------------------------------------

_CHUNK = "ids binary, known binary, labels binary, x binary, means binary, devs binary"
_LISTS = "block long, list long, score long, id long"


def _packed(dim: int, step: int):
    """Partitions as chunks; rows that take no part go. Rows of a chunk lie by label."""

    def pack(ids, known, labels, x) -> pa.RecordBatch:
        order = np.argsort(labels, kind="stable")
        mean, dev = finest(x)
        small = np.abs(x).max(initial=0) < 2**31
        cols = [ids[order], known[order], labels[order], x[order].astype(np.int32 if small else np.float64),
                mean[order], dev[order]]
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cols],
                                          names=[c.split()[0] for c in _CHUNK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids, labels, vectors = batch.columns
            sizes = np.diff(vectors.offsets.to_numpy())
            values = vectors.values.slice(vectors.offsets[0].as_py(), int(sizes.sum()))
            flat = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x = np.zeros((len(sizes), dim))
            x[row, at] = np.floor(SCALE * flat)
            ok = np.isfinite(x).all(axis=1)
            held.append((ids.fill_null(0).to_numpy()[ok], ids.is_valid().to_numpy(zero_copy_only=False)[ok],
                         labels.to_numpy()[ok], x[ok]))
            n += int(ok.sum())
            if n >= step:
                whole = [np.concatenate(c) for c in zip(*held)]
                for s in range(0, n - n % step, step):
                    yield pack(*(c[s:s + step] for c in whole))
                held, n = [tuple(c[n - n % step:] for c in whole)], n % step
        if n:
            yield pack(*(np.concatenate(c) for c in zip(*held)))

    return run


def _vectors(row: dict, dim: int) -> Vectors:
    ids = np.frombuffer(row["ids"], np.int64)
    x = np.frombuffer(row["x"], np.int32 if len(row["x"]) == 4 * dim * len(ids) else np.float64)
    wide = dim // 4
    return Vectors(ids, np.frombuffer(row["known"], bool), np.frombuffer(row["labels"], np.int64),
                   x.reshape(-1, dim).astype(float), np.frombuffer(row["means"]).reshape(-1, wide),
                   np.frombuffer(row["devs"]).reshape(-1, wide))


def _anchors(every: int, dim: int):
    """The anchors of each chunk: where they lie, id, label and vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v = _vectors(row, dim)
                at = np.flatnonzero(v.known & (v.ids % every == 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), row["chunk"]), pa.int64()), pa.array(at, pa.int64()),
                     pa.array(v.ids[at], pa.int64()), pa.array(v.labels[at], pa.int64()),
                     pa.array([x.tobytes() for x in v.x[at]], pa.binary())],
                    names=["chunk", "place", "id", "label", "x"])

    return run


def _scored(dim: int, most: int, positives: int | None):
    """(block, list, score, id) of each block's lists, over all cells of this task."""

    def block_of(row: dict) -> Block:
        own = row["anchors"]
        x = np.frombuffer(b"".join(o["x"] for o in own)).reshape(-1, dim)
        labels = np.array([o["label"] for o in own], np.int64)
        given = None
        if positives is not None:
            score, have = np.zeros((len(own), positives), np.int64), np.zeros((len(own), positives), bool)
            for p in row["lists"] or ():
                score[p["list"], p["k"]], have[p["list"], p["k"]] = p["score"], True
            given = score, have
        vectors = Vectors(np.zeros(len(own), np.int64), np.ones(len(own), bool), labels, x, *finest(x))
        return Block(vectors, np.array([o["chunk"] for o in own]), np.array([o["place"] for o in own]), given, most)

    def out(number: int, block: Block) -> pa.RecordBatch:
        b = block.best
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(b.key), number), pa.int64()), pa.array(b.key, pa.int64()), pa.array(b.score, pa.int64()),
             pa.array(b.ids, pa.int64(), mask=~b.known)], names=["block", "list", "score", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["anchors"] is None:
                    if row["block"] == number:  # a block's number may have no anchors
                        block.add(row["chunk"], _vectors(row, dim))
                    continue
                if block is not None:
                    yield out(number, block)
                number, block = row["block"], block_of(row)
        if block is not None:
            yield out(number, block)

    return run


def _numbered(chunks: DataFrame) -> tuple[DataFrame, int]:
    """Checkpointed chunks with numbers from 0; the driver gets one count for each partition."""
    at = chunks.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33))
    counts = sorted(tuple(r) for r in at.groupBy("part").count().collect())
    before = np.cumsum([0, *(c for _, c in counts)]).tolist()
    starts = chunks.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "part long, first long")
    number = F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return at.join(F.broadcast(starts), "part").select(number.alias("chunk"), *chunks.columns), before[-1]


def _cells(blocks: DataFrame, n_blocks: int, chunks: DataFrame, n_chunks: int, run) -> DataFrame:
    """``run`` over cells of a block (first, without a chunk number) and every ``parts``-th chunk."""
    width = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(n_chunks, max(1, -(-CELLS * width // n_blocks)))

    def each(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    heads = blocks.withColumn("part", each(parts))
    rows = chunks.withColumn("block", each(n_blocks)).withColumn("part", F.col("chunk") % parts)
    cells = heads.unionByName(rows, allowMissingColumns=True).withColumn("cell", F.col("block") * parts + F.col("part"))
    dealt = cells.repartitionById(width, (F.col("cell") % width).cast("int"))
    return dealt.sortWithinPartitions("cell", F.col("chunk").asc_nulls_first()).drop("part", "cell").mapInArrow(run, _LISTS)


def _first(rows: DataFrame, most: int, name: str) -> DataFrame:
    order = Window.partitionBy("block", "list").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)


def hard_negatives(df: DataFrame, label: str = "label", vector: str = "embedding", id: str = "vec_id", every: int = 100,
                   positives: int = 5, negatives: int = 5) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its
    ``positives`` best rows of the same label, the ``negatives`` best rows of other labels that score from 0.8 of the
    positive's score to that score."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                     F.col(vector).alias("vector")).where("label is not null and vector is not null")
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    dim = -(-longest // 64) * 64
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    step = max(1, min(CHUNK_ROWS, CHUNK_BYTES // (4 * dim)))
    chunks, n_chunks = _numbered(cut(rows.mapInArrow(_packed(dim, step), _CHUNK)))
    found = cut(chunks.mapInArrow(_anchors(every, dim), "chunk long, place long, id long, label long, x binary"))
    n_anchors = found.count()
    if n_anchors == 0:
        return df.sparkSession.createDataFrame([], schema)
    # blocks even by hash: the anchors' places are all different
    size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (4 * dim)))
    n_blocks = -(-n_anchors // size)
    one = F.struct("label", "chunk", "place", "id", "x")
    blocks = cut(found.groupBy(F.pmod(F.xxhash64("chunk", "place"), F.lit(n_blocks)).alias("block")).agg(
        F.sort_array(F.collect_list(one)).alias("anchors")))
    best = _cells(blocks, n_blocks, chunks, n_chunks, _scored(dim, positives, None))
    best = cut(_first(best, positives, "k").withColumn("k", F.col("k") - 1))
    lists = best.groupBy("block").agg(F.collect_list(F.struct("list", "k", "score")).alias("lists"))
    worst = _cells(blocks.join(lists, "block", "left"), n_blocks, chunks, n_chunks, _scored(dim, negatives, positives))
    worst = _first(worst, negatives, "rank").withColumns({"k": (F.col("list") % positives).cast("int"),
                                                          "list": F.expr(f"list div {positives}")})
    ids = blocks.select("block", F.posexplode(F.col("anchors.id")).alias("list", "anchor_id"))
    named = best.join(ids.withColumn("list", F.col("list").cast("long")), ["block", "list"]).select(
        "block", "list", "k", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return worst.join(named, ["block", "list", "k"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def shifted(df: DataFrame) -> DataFrame:
    """``embeddings`` whose labels go one on (mod 10) where the id is divisible by 7."""
    return df.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
