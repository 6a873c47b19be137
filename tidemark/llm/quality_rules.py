"""Quality rules: fixed text rules, then a hashed n-gram log-likelihood ratio.

The raw corpus (every document) and a trusted target (documents that pass a
strict form of the rules) each give a multinomial over hashed word uni- and
bigrams. A document's verdict is the mean log ratio of the two over its
n-grams against a fixed threshold, so it does not depend on the length, on
chance or on the other documents of its partition.

Defined results: a null or empty text has no words and fails the base rules;
with no trusted document the ratio is 0 everywhere and only the base rules
decide; repeated rows get equal verdicts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, field, text_bytes, unused

BUCKETS = 1 << 15
# Below the ratio of every document labelled good (lowest: -0.10 on 100,000 x 0.1 documents)
# that passes the base rules, and above that of most labelled bad (their median: -0.40).
THRESHOLD = -0.18
SMOOTHING = 5.0
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def repeated_words(words: list[bytes], codes: np.ndarray, width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = h * _MIX + codes[k:k + n]
            h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    # windows with equal hashes are compared word by word
    at = np.flatnonzero(again)
    seen: dict[tuple, int] = {}
    twice = set()
    for i in at.tolist():
        key = tuple(words[i:i + width])
        if key in seen:
            twice.add(i)
            twice.add(seen[key])
        else:
            seen[key] = i
    cover = np.zeros(len(words) + 1, np.int64)
    for i in twice:
        cover[i] += 1
        cover[i + width] -= 1
    return int((np.cumsum(cover[:-1]) > 0).sum())


def text_rules(text: bytes) -> tuple[list[bytes], np.ndarray, int, int, int, int]:
    """Words, their codes, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    codes = word_codes(words)
    joined = np.frombuffer(b"".join(words), np.uint8)
    word_chars = int(((joined & 0xC0) != 0x80).sum())
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    n_dup_lines = 0
    if b"\n" in text:
        lines = [x for x in text.split(b"\n") if x.strip()]
        n_dup_lines = len(lines) - len(set(lines))
    return words, codes, word_chars, n_symbols, n_dup_lines, repeated_words(words, codes)


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PCT * n_words


def ngram_buckets(codes: np.ndarray) -> np.ndarray:
    """Buckets of the uni- and bigrams."""
    with np.errstate(over="ignore"):
        uni = codes * _MIX
        bi = (codes[:-1] * _MIX + codes[1:] + np.uint64(1)) * _MIX
    return (np.concatenate([uni, bi]) >> np.uint64(49)).astype(np.int64)


def trusted(text: bytes, n_words: int, n_symbols: int, n_dup_lines: int, n_repeat: int) -> bool:
    """The strict form of the rules: few symbols, shouts, repeats and copies."""
    return (n_words >= MIN_WORDS and 20 * n_symbols <= n_words and 20 * n_repeat <= n_words
            and 4 * n_dup_lines <= text.count(b"\n") and 10 * text.count(b"!") <= n_words
            and 4 * (len(text) - len(text.translate(None, _CAPITALS))) <= len(text))


def ratio_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log ratio per bucket, from all documents. The driver gets the summed
    counts only: at most ``BUCKETS`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for b in text_bytes(batch, "text"):
                words, codes, _, symbols, dup, repeat = text_rules(b)
                if words:
                    n = np.bincount(ngram_buckets(codes), minlength=BUCKETS) if len(words) > 2000 else None
                    at = None if n is not None else ngram_buckets(codes)
                    for into in (raw, target) if trusted(b, len(words), symbols, dup, repeat) else (raw,):
                        if n is not None:
                            into += n
                        else:
                            np.add.at(into, at, 1)
        hit = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(raw[hit]), pa.array(target[hit])],
                                         names=["bucket", "raw", "target"])

    rows = (docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas())
    raw, target = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    if not rows["target"].sum():
        return np.zeros(BUCKETS)
    raw[rows["bucket"]] += rows["raw"]
    target[rows["bucket"]] += rows["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


FIELDS = [field("n_words", "long"), field("word_chars", "long"), field("n_symbols", "long"),
          field("n_dup_lines", "long"), field("n_repeat_words", "long"), field("base_failed", "boolean"),
          field("llr", "double"), field("kept", "boolean")]


def _verdicts(table: np.ndarray, threshold: float):
    def compute(texts: list[bytes]) -> list[list]:
        out: list[list] = [[] for _ in FIELDS]
        for b in texts:
            words, codes, chars, symbols, dup, repeat = text_rules(b)
            failed = base_failed(len(words), repeat)
            llr = float(table[ngram_buckets(codes)].mean()) if words else 0.0
            for col, v in zip(out, (len(words), chars, symbols, dup, repeat, failed, llr,
                                    not failed and llr >= threshold), strict=True):
                col.append(v)
        return out

    return compute


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its id, the rule counts, the ratio, the verdict."""
    table = ratio_table(docs, text)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return add_columns(src, "text", FIELDS, _verdicts(table, threshold), drop=("text",))


def keep_quality(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with their own columns only."""
    compute = _verdicts(ratio_table(docs, text), threshold)
    flag = unused(docs, "rules_kept")
    return (add_columns(docs, text, [field(flag, "boolean")], lambda texts: [compute(texts)[-1]])
            .where(F.col(flag)).select(docs.columns))
