"""Best-fit packing into fixed-length sequences, certified by lower bounds.

Documents become pieces of at most ``capacity`` tokens (only longer documents
are cut; the first piece takes the remainder). Pieces are dealt into
partitions and each packs its own by best-fit decreasing. Dual-feasible
functions give a lower bound on the partition's sequences: where the bound is
met the packing is certified as optimal and final. The partitions with a gap
exchange their documents (they are dealt anew among themselves) and rerun
best-fit decreasing, as long as that saves sequences.

Defined results: a null or empty text is its end token alone; repeated rows
are packed once each; ids come back unchanged whatever their type.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, text_bytes, worker_cache

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 16_384
MAX_ROUNDS = 4
LONG_RUN = 400  # characters without a break that go to the second tokenizer


class Encoder:
    """Ids of the byte-level BPE vocabulary.

    The rank form of the vocabulary gives the same ids as the JSON form and is
    several times faster, but slows down on unbroken runs and knows no special tokens; texts with such
    runs, or with a special token's string, go through the JSON form.
    """

    def __init__(self, json_path: str, rank_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def ids(self, text: bytes) -> np.ndarray:
        value = text.decode("utf-8", "replace")
        words = text.split()
        blank = len(text) - sum(map(len, words))
        if any(s in value for s in self.special) or max(map(len, words), default=0) >= LONG_RUN or blank >= 2 * len(words) + LONG_RUN:
            return np.array(self.whole.encode(value, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(value), "<u4")


def cut_points(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Pieces (start, length) of a document of ``n`` ids."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           json_path: str | None = None, rank_path: str | None = None) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32) of every document."""
    json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
    rank_path = rank_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_cache(f"{json_path} {rank_path}", lambda: Encoder(json_path, rank_path))
        for batch in batches:
            rows: list[list[int]] = [[], [], [], [], []]
            for i, b in enumerate(text_bytes(batch, "text")):
                ids = np.append(enc.ids(b), np.uint32(END_ID)).astype("<u4")
                for k, (start, n) in enumerate(cut_points(len(ids), capacity)):
                    for col, v in zip(rows, (i, k, start, n, zlib.crc32(ids[start:start + n].tobytes())), strict=True):
                        col.append(v)
            cols = [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in rows[2:])]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs, by dual-feasible functions."""
    if not len(lengths):
        return 0
    n = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((n * size).sum()) // capacity)
    # f(x) = floor((k + 1) x / c) c / k, or x where (k + 1) x / c is whole
    for k in range(1, 33):
        scaled = (k + 1) * size
        f = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)  # times k
        best = max(best, -(-int((n * f).sum()) // (k * capacity)))
    # f(x) = c above c - e, x from e to c - e, 0 below e
    weight = np.concatenate([[0], np.cumsum(n * size)])
    count = np.concatenate([[0], np.cumsum(n)])
    e = np.arange(1, capacity // 2 + 1)
    big = count[-1] - count[capacity - e + 1]
    middle = weight[capacity - e + 1] - weight[e]
    return max(best, int((big + -(-middle // capacity)).max()))


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: the sequence and offset of each piece, and how
    many sequences. Open sequences are held by free space, so the tightest
    that fits is found from a bit set."""
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = used = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = spaces >> need
        if fits:
            space = need + (fits & -fits).bit_length() - 1
            s = free[space].pop()
            if not free[space]:
                spaces ^= 1 << space
        else:
            space, s = capacity, used
            used += 1
        sequence[i], offset[i] = s, capacity - space
        left = space - need
        if left:
            if not free[left]:
                spaces |= 1 << left
            free[left].append(s)
    return sequence, offset, used


def _pack(pool: DataFrame, step: int, group_pieces: int, capacity: int) -> tuple[DataFrame, int]:
    """Deal the pool into partitions and pack each; also how many there are."""
    parts = max(1, -(-pool.count() // group_pieces))
    kept = [f for f in pool.schema.fields if f.name not in ("part", "sequence_id", "offset", "certified")]
    names = [f.name for f in kept]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("length", "descending"), ("uid", "ascending")])
        lengths = table.column("length").to_numpy().astype(np.int64)
        sequence, offset, used = best_fit(lengths, capacity)
        part = table.column("part").to_numpy()
        ids = (np.int64(step) << 56) + (part << 24) + sequence
        done = used <= lower_bound(lengths, capacity)
        return pa.table([*(table.column(c) for c in names), pa.array(part), pa.array(ids), pa.array(offset),
                         pa.array(np.full(len(ids), done))], names=[*names, "part", "sequence_id", "offset", "certified"])

    dealt = pool.select(names).withColumn("part", F.pmod(F.xxhash64("uid", F.lit(step)), F.lit(parts)))
    packed = dealt.groupBy("part").applyInArrow(
        run, f"{schema}, part long, sequence_id long, offset long, certified boolean")
    return cut(packed), parts


def _sequences(packed: DataFrame) -> int:
    """Sequences of packed pieces: each has one piece at offset 0."""
    return packed.where("offset = 0").count()


def pack(sized: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
         max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``sized`` (rows with a ``length`` of 1 to ``capacity``) with the
    sequence and offset of each row."""
    names = sized.columns
    pool = cut(sized.withColumn("uid", F.monotonically_increasing_id()))
    done: list[DataFrame] = []
    packed, parts = _pack(pool, 0, group_pieces, capacity)
    for step in range(1, max_rounds + 1):
        done.append(packed.where("certified"))
        gap = packed.where("not certified")
        before = _sequences(gap)
        if not before or parts < 2:
            packed = gap
            break
        again, parts = _pack(gap, step, group_pieces, capacity)
        if _sequences(again) >= before:
            packed = gap
            break
        packed = again
    else:
        done.append(packed.where("certified"))
        packed = packed.where("not certified")
    out = packed
    for d in done:
        out = out.unionByName(d)
    return out.select(*names, "sequence_id", "offset")


def packing(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
            group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    return pack(pieces(docs, id_col, text, capacity), capacity, group_pieces)
