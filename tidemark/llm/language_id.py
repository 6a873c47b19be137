"""Language identification as a mixture of languages per document.

Learning counts hashed character trigrams (words padded with spaces) per
language over all learning documents. At most ``LANGUAGES`` languages are
learned (a documented bound: those of the most learning documents), so a
column of dirty tags makes neither the model nor the driver's counts grow. A word's likelihood under a language is
the product of its trigrams' smoothed probabilities. For each document,
expectation-maximisation estimates the share of every language over its
words; nested sets of the strongest languages are then refitted and the set
with the best penalised likelihood is taken. The prediction is the language
with the largest share in that set, the score its share.

Defined results: null texts and texts without a letter get ``und`` and 0;
without any learning document everything is ``und``; rows with a null
language are not learned from; ties go to the language that sorts first.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, field, text_bytes

BUCKETS = 1 << 15
LANGUAGES = 256
SMOOTHING = 0.5
MAX_STEPS = 30
TOLERANCE = 1e-4
# Penalty of each language in the set, in units of log(words).
PENALTY = 2.0
# Words handled at once; longer documents take several rounds.
CHUNK_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of `` word ``, and where each word's begin."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        h = (codes[:-2] * _M1 + codes[1:-1]) * _M2 + codes[2:]
        h = (h ^ (h >> np.uint64(31))) * _M1
    # a word of n letters has n trigrams; the next word's begin after the space
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    keep = np.ones(len(h), bool)
    keep[starts[1:] - 1] = False
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return (h[keep] >> np.uint64(49)).astype(np.int64), at


def words_of(text: bytes) -> list[str]:
    """Runs of letters (and of signs that count as such, like raised figures);
    none if there is no letter at all."""
    words = _WORD.findall(text.decode("utf-8", "replace").lower())
    return words if any(c.isalpha() for w in words for c in w) else []


class Model:
    """Log probabilities per bucket and language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        self.logp = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log likelihood of each word under each language."""
        at_codes, at = trigrams(words)
        return np.add.reduceat(self.logp[at_codes], at, axis=0).astype(np.float64)


def _learn(docs: DataFrame, lang: str, text: str) -> Model:
    src = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"),
                                                     F.col(text).alias("text"))
    tags = src.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(LANGUAGES).collect()
    src = src.where(F.col("lang").isin([r["lang"] for r in tags]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}

        def add(lang: str, n: Counter) -> None:
            if n:
                buckets, at = trigrams(list(n))
                each = np.diff(np.append(at, len(buckets)))
                weight = np.repeat(np.fromiter(n.values(), np.float64, len(n)), each)
                into = total.setdefault(lang, np.zeros(BUCKETS))
                into += np.bincount(buckets, weight, BUCKETS)
            else:
                total.setdefault(lang, np.zeros(BUCKETS))

        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, b in zip(batch.column(0).to_pylist(), text_bytes(batch, "text"), strict=True):
                n = seen.setdefault(lang, Counter())
                n.update(words_of(b))
                if len(n) > CHUNK_WORDS:
                    add(lang, seen.pop(lang))
            for lang, n in seen.items():
                add(lang, n)
        for lang, n in total.items():
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(hit), pa.string()), pa.array(hit), pa.array(n[hit].astype(np.int64))],
                names=["lang", "bucket", "n"])

    # the driver gets at most BUCKETS rows for each of the languages
    rows = (src.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((BUCKETS, len(languages)))
    counts[rows["bucket"], rows["lang"].map({v: i for i, v in enumerate(languages)})] = rows["n"]
    return Model(languages, counts)


def _em(p: np.ndarray, starts: np.ndarray, doc: np.ndarray, n: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shares per document from word likelihoods ``p`` (scaled per word)."""
    live, out = np.arange(len(starts)), share.copy()
    for _ in range(MAX_STEPS):
        r = p * share[doc]
        r /= r.sum(axis=1, keepdims=True)
        new = np.add.reduceat(r, starts, axis=0) / n[:, None]
        moves = np.abs(new - share).max(axis=1) > TOLERANCE
        out[live] = share = new
        if not moves.any():
            break
        if not moves.all():  # a document that has settled stays as it is, whatever its batch
            p, live, share, n = p[moves[doc]], live[moves], share[moves], n[moves]
            lengths = np.diff(np.append(starts, len(doc)))[moves]
            starts, doc = np.cumsum(lengths) - lengths, np.repeat(np.arange(len(live)), lengths)
    return out


def _loglik(p, top, starts, doc, share) -> np.ndarray:
    return np.add.reduceat(np.log(np.maximum((p * share[doc]).sum(axis=1), 1e-300)) + top, starts)


def mixture(scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Shares of the languages in each document. ``scores``: log likelihoods
    of the words (rows) of documents of ``lengths`` words (all over 0)."""
    n_docs, n_lang = len(lengths), scores.shape[1]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    doc = np.repeat(np.arange(n_docs), lengths)
    top = scores.max(axis=1)
    p = np.maximum(np.exp(scores - top[:, None]), 1e-30)
    n = lengths.astype(np.float64)
    full = _em(p, starts, doc, n, np.full((n_docs, n_lang), 1.0 / n_lang))
    order = np.argsort(-full, axis=1, kind="stable")
    best = np.zeros_like(full)
    best[np.arange(n_docs), order[:, 0]] = 1.0
    value = _loglik(p, top, starts, doc, best) - PENALTY * np.log(n + 1)
    live = np.arange(n_docs)
    for k in range(2, n_lang + 1):
        # a k-th language must hold at least one word's worth of the document
        live = live[np.take_along_axis(full[live], order[live, k - 1:k], axis=1)[:, 0] * n[live] >= 1.0]
        if not len(live):
            break
        rows = np.concatenate([np.arange(starts[i], starts[i] + lengths[i]) for i in live])
        s = np.concatenate([[0], np.cumsum(lengths[live])[:-1]])
        d = np.repeat(np.arange(len(live)), lengths[live])
        start = np.zeros((len(live), n_lang))
        np.put_along_axis(start, order[live, :k], np.take_along_axis(full[live], order[live, :k], axis=1) + 1e-9, axis=1)
        start /= start.sum(axis=1, keepdims=True)
        share = _em(p[rows], s, d, n[live], start)
        v = _loglik(p[rows], top[rows], s, d, share) - PENALTY * k * np.log(n[live] + 1)
        better = v > value[live]
        value[live[better]] = v[better]
        best[live[better]] = share[better]
    return best


def _predict(model: Model):
    def flush(held: list[tuple[int, list[str]]], out: list[list]) -> None:
        index: dict[str, int] = {}
        ids = [index.setdefault(w, len(index)) for _, words in held for w in words]
        scores = model.word_scores(list(index))[ids]
        shares = mixture(scores, np.array([len(words) for _, words in held]))
        for (row, _), share in zip(held, shares, strict=True):
            i = int(share.argmax())
            out[0][row], out[1][row] = model.languages[i], float(share[i])

    def compute(texts: list[bytes]) -> list[list]:
        out: list[list] = [["und"] * len(texts), [0.0] * len(texts)]
        held: list[tuple[int, list[str]]] = []
        size = 0
        for row, b in enumerate(texts):
            words = words_of(b) if model.languages else []
            if words:
                held.append((row, words))
                size += len(words)
            if size > CHUNK_WORDS:
                flush(held, out)
                held, size = [], 0
        if held:
            flush(held, out)
        return out

    return compute


def language_id(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text",
                lang: str = "lang") -> DataFrame:
    """One row per document: its id, whether it was held out, the predicted
    language and its share. ``learn`` marks the documents to learn from."""
    model = _learn(docs.where(learn), lang, text)
    src = docs.select(F.col(id_col).alias("doc_id"), (~learn).alias("held_out"), F.col(text).alias("text"))
    return add_columns(src, "text", [field("lang_pred", "string"), field("score", "double")], _predict(model),
                       drop=("text",))
