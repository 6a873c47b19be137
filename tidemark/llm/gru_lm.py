"""Language-model scoring with a gated recurrent unit, in numpy.

Counts of all tokens of all learning documents give the unigram base score
and the model's vocabulary: the most frequent words, an end token and a class
of rare-word buckets (words outside the vocabulary, by a hash of their last
bytes). The network is an embedding, one gated recurrent layer and an output
softmax factored into classes: P(class) * P(word | class); a rare word's
probability is its bucket's times its smoothed share of the bucket's counts.

Learning is truncated backpropagation through windows of ``WINDOW`` steps.
One task first learns from about ``WARM_TOKENS`` tokens (a documented bound:
documents of at most ``WARM_LONGEST`` tokens, chosen by a hash). From there
all learning documents are dealt by a hash of id and text to learners of
about ``LEARNER_TOKENS`` tokens each, ``MAX_LEARNERS`` at most; each starts
from the first network and learns from all its documents in the hash's order,
and the networks are averaged by their numbers of tokens. So the network does not depend on
the input's partitions or on retried tasks (scores do by the rounding of
their batches only), and what is shuffled for the average is one array for
each learner. Copies under one id go to one learner.
Scoring carries the state across windows, from a document's first token to
its end, so the log-likelihood is that of the whole document.

Frequent words' counts go to every task: a word is frequent with at least
1/``FREQUENT`` of all tokens, so there are at most ``FREQUENT`` of them.
Counts of the other words meet the documents in a shuffled join.

Defined results: a null or empty text is one end token; without learning
documents all counts are 0 and every token has the same base probability;
repeated rows get equal scores.
"""

from __future__ import annotations

import heapq
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import add_columns, cut, field, text_bytes, text_key, worker_cache

FREQUENT = 1_000_000
CLASSES = 32  # word classes; one more holds the rare-word buckets
CLASS_SIZE = 32
WORDS = CLASSES * CLASS_SIZE  # the end token and the most frequent words
SIZE = WORDS + CLASS_SIZE
EMBED = HIDDEN = 16
LANES = 256
WINDOW = 32
CHUNK = 2_000_000  # tokens handled at once
WARM_TOKENS = 500_000
WARM_LONGEST = WARM_TOKENS // 8
WARM_ROUNDS = 4
LEARNER_TOKENS = 1_700_000  # of a learner, on average; below CHUNK
MAX_LEARNERS = 8192
SUM_GROUPS = 128  # networks are summed within groups first
WARM_RATE, RATE = 0.01, 0.002
LIMIT = 3.0  # of an output weight
END = b"\n"  # not a word: words hold no white space
COUNT_FLUSH = 200_000


def tokens_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def bucket_of(word: bytes) -> int:
    """The rare-word bucket of a word."""
    return zlib.crc32(word[-2:]) % CLASS_SIZE


class Network:
    """Parameters in one flat vector, with named views."""

    SHAPES = (("embed", (SIZE, EMBED)), ("wx", (EMBED, 3 * HIDDEN)), ("wh", (HIDDEN, 3 * HIDDEN)),
              ("b", (3 * HIDDEN,)), ("oc", (HIDDEN, CLASSES + 1)), ("bc", (CLASSES + 1,)), ("ow", (SIZE, HIDDEN)),
              ("bw", (SIZE,)))

    def __init__(self, flat: np.ndarray | None = None):
        size = sum(int(np.prod(s)) for _, s in self.SHAPES)
        self.flat = np.zeros(size, np.float32) if flat is None else flat.astype(np.float32)
        at = 0
        for name, shape in self.SHAPES:
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at:at + n].reshape(shape))
            at += n

    @classmethod
    def fresh(cls, mass: np.ndarray) -> Network:
        """Small random weights; biases give the unigram probabilities."""
        net, rng = cls(), np.random.default_rng(7)
        for name, scale in (("embed", 0.3), ("wx", 0.3), ("wh", 0.2), ("oc", 0.1), ("ow", 0.1)):
            view = getattr(net, name)
            view[:] = rng.normal(0, scale, view.shape)
        by_class = np.maximum(mass, 1e-9).reshape(CLASSES + 1, CLASS_SIZE)
        net.bc[:] = np.log(by_class.sum(axis=1) / by_class.sum())
        net.bw[:] = np.log(by_class / by_class.sum(axis=1, keepdims=True)).ravel()
        return net


def lanes(docs: list[np.ndarray], width: int = LANES):
    """Documents laid end to end in at most ``width`` lanes of similar length,
    a window at a time, so that memory goes by the tokens and not by the longest
    lane. Yields arrays (steps, live lanes): inputs, targets (-1 for none),
    first-step marks, document numbers; and which of the lanes of the window
    before (at first: of all) are live."""
    if not docs:
        return
    width = min(width, len(docs))
    load = [(0, i) for i in range(width)]
    own: list[list[int]] = [[] for _ in range(width)]
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        n, lane = heapq.heappop(load)
        own[lane].append(i)
        heapq.heappush(load, (n + len(docs[i]), lane))
    left = np.array([n for _, n in sorted((lane, n) for n, lane in load)])  # tokens of each lane
    begin = np.cumsum(left) - left
    in_turn = [i for mine in own for i in mine]
    sizes = np.array([len(docs[i]) for i in in_turn])
    goal = np.concatenate([docs[i] for i in in_turn]).astype(np.int16, copy=False)
    fresh = np.zeros(len(goal), bool)
    fresh[np.cumsum(sizes) - sizes] = True
    given = np.roll(goal, 1)
    given[fresh] = 0
    which = np.repeat(np.array(in_turn, np.int32), sizes)
    longest = int(left.max())
    for s in range(0, longest, WINDOW):
        live = left > s
        left, begin = left[live], begin[live]
        step = np.arange(s, min(s + WINDOW, longest))[:, None]
        here = step < left
        at = np.minimum(step, left - 1) + begin
        yield np.where(here, given[at], 0), np.where(here, goal[at], -1), here & fresh[at], which[at], live


# Gates are 0.5 + 0.5 tanh(x / 2): the half goes into the weights of both gates.
_HALF = np.repeat(np.array([0.5, 0.5, 1.0], np.float32), HIDDEN)


def _states(net: Network, table: np.ndarray, inputs, first, h, keep: bool):
    """Hidden states over a window; with ``keep`` also what backward needs of
    all steps: the state before, both gates, the candidate, the recurrence."""
    steps, width = inputs.shape
    held = steps if keep else 1
    out = np.empty((steps, width, HIDDEN), np.float32)
    before = np.empty_like(out) if keep else None
    recur = np.empty((held, width, 3 * HIDDEN), np.float32)
    gates = np.empty((held, width, 2 * HIDDEN), np.float32)
    candidate = np.empty((held, width, HIDDEN), np.float32)
    x, wh = (table * _HALF)[inputs], net.wh * _HALF
    fresh = first.any(axis=1).tolist()
    for t in range(steps):
        if fresh[t]:
            h = np.where(first[t][:, None], np.float32(0), h)
        at = 0
        if keep:
            before[t], at = h, t
        u, g, c, new = recur[at], gates[at], candidate[at], out[t]
        np.matmul(h, wh, out=u)
        np.add(x[t, :, :2 * HIDDEN], u[:, :2 * HIDDEN], out=g)
        np.tanh(g, out=g)
        g *= np.float32(0.5)
        g += np.float32(0.5)
        np.multiply(g[:, HIDDEN:], u[:, 2 * HIDDEN:], out=c)
        c += x[t, :, 2 * HIDDEN:]
        np.tanh(c, out=c)
        np.subtract(h, c, out=new)
        new *= g[:, :HIDDEN]
        new += c
        h = new
    saved = (before, gates[:, :, :HIDDEN], gates[:, :, HIDDEN:], candidate, recur[:, :, 2 * HIDDEN:]) if keep else None
    return out, h.copy(), saved


def _output(net: Network, h: np.ndarray, target: np.ndarray, grad: Network | None = None):
    """Log probabilities of the targets from states ``h`` (rows). With
    ``grad``, adds the loss's gradients there and returns that of ``h``."""
    # the rows in the order of their classes, so that a class is a slice
    order = np.argsort(target // CLASS_SIZE, kind="stable")
    own, goal = h[order], target[order]
    cls = goal // CLASS_SIZE
    rows = np.arange(len(goal))
    ones = np.ones(CLASSES + 1, np.float32)  # sums of short rows are faster as products
    # |h| < 1 and weights within LIMIT keep every exponent in range
    e = own @ net.oc
    e += net.bc
    value = e[rows, cls]
    np.exp(e, out=e)
    total = e @ ones
    value = value - np.log(total)
    back = None
    if grad is not None:
        e /= total[:, None]
        e[rows, cls] -= 1
        grad.oc += own.T @ e
        grad.bc += e.sum(axis=0)
        back = e @ net.oc.T
    ends = np.searchsorted(cls, np.arange(CLASSES + 2)).tolist()
    for c in range(CLASSES + 1):
        at = slice(ends[c], ends[c + 1])
        if at.start == at.stop:
            continue
        block = slice(c * CLASS_SIZE, (c + 1) * CLASS_SIZE)
        mine, i = goal[at] - c * CLASS_SIZE, rows[:at.stop - at.start]
        e = own[at] @ net.ow[block].T
        e += net.bw[block]
        value[at] += e[i, mine]
        np.exp(e, out=e)
        total = e @ ones[:CLASS_SIZE]
        value[at] -= np.log(total)
        if grad is not None:
            e /= total[:, None]
            e[i, mine] -= 1
            grad.ow[block] += e.T @ own[at]
            grad.bw[block] += e.sum(axis=0)
            back[at] += e @ net.ow[block]
    out = np.empty(len(goal), np.float64)
    out[order] = value
    if back is not None:
        down = np.empty_like(back)
        down[order] = back
        back = down
    return out, back


def log_probabilities(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Natural-log probability of each document, state carried throughout."""
    total = np.zeros(len(docs))
    h = np.zeros((min(LANES, len(docs)), HIDDEN), np.float32)
    table = net.embed @ net.wx + net.b
    for inputs, targets, first, number, live in lanes(docs):
        if not live.all():  # lanes that have ended
            h = h[live]
        states, h, _ = _states(net, table, inputs, first, h, False)
        here = targets >= 0
        value, _ = _output(net, states[here], targets[here])
        total += np.bincount(number[here], value, len(docs))
    return total


class Learner:
    """Adam over truncated windows."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.steps, self.tokens = net, rate, 0, 0
        self.m, self.v = np.zeros_like(net.flat), np.zeros_like(net.flat)

    def learn(self, docs: list[np.ndarray]) -> None:
        h = np.zeros((min(LANES, len(docs)), HIDDEN), np.float32)
        for inputs, targets, first, _, live in lanes(docs):
            if not live.all():
                h = h[live]
            h = self._window(inputs, targets, first, h)

    def _window(self, inputs, targets, first, h):
        net, grad = self.net, Network()
        table = net.embed @ net.wx + net.b
        states, last, saved = _states(net, table, inputs, first, h, True)
        here = targets >= 0
        n = int(here.sum())
        _, back = _output(net, states[here], targets[here], grad)
        down = np.zeros_like(states)
        down[here] = back
        prev, z, r, c, uc = saved
        # what a unit of dh gives before the gates, all steps at once
        cand = (1 - z) * (1 - c * c)
        unit = np.empty((*z.shape[:2], 3, HIDDEN), np.float32)
        np.multiply((prev - c) * z, 1 - z, out=unit[:, :, 0])
        np.multiply(cand, r, out=unit[:, :, 2])
        np.multiply(unit[:, :, 2] * uc, 1 - r, out=unit[:, :, 1])
        dh = np.zeros_like(h)
        all_dh = np.empty_like(states)
        fresh = first.any(axis=1).tolist()
        wide = (len(h), 3 * HIDDEN)
        for t in range(len(inputs) - 1, -1, -1):
            dh = np.add(dh, down[t], out=all_dh[t])
            dh = dh * z[t] + (dh[:, None, :] * unit[t]).reshape(wide) @ net.wh.T
            if fresh[t]:
                dh[first[t]] = 0
        unit *= all_dh[:, :, None, :]
        flat = unit.reshape(-1, 3 * HIDDEN)
        grad.wh += prev.reshape(-1, HIDDEN).T @ flat
        # the input enters the candidate without the reset gate
        np.multiply(cand, all_dh, out=unit[:, :, 2])
        grad.b += flat.sum(axis=0)
        ids = inputs.ravel()
        grad.wx += net.embed[ids].T @ flat
        down_x = flat @ net.wx.T
        order = np.argsort(ids, kind="stable")
        cut_at = np.flatnonzero(np.diff(ids[order], prepend=-1))
        grad.embed[ids[order][cut_at]] += np.add.reduceat(down_x[order], cut_at, axis=0)
        g = grad.flat / max(1, n)
        norm = float(np.sqrt((g * g).sum()))
        if norm > 1:
            g /= norm
        self.steps += 1
        self.tokens += n
        self.m += 0.1 * (g - self.m)
        self.v += 0.01 * (g * g - self.v)
        scale = self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        net.flat -= np.float32(scale) * self.m / (np.sqrt(self.v) + np.float32(1e-8))
        for weights in (net.oc, net.ow):
            np.clip(weights, -LIMIT, LIMIT, out=weights)
        return last


class Vocabulary:
    """Counts of the frequent words and of the rare-word buckets."""

    def __init__(self, words: list[bytes], counts: np.ndarray, ends: int, bucket_tokens, bucket_words):
        """``words``: frequent ones by falling count, the end token left out."""
        self.words = words
        self.log_count = np.log10(counts + 0.5)
        self.end_log = float(np.log10(ends + 0.5))
        self.ends = ends
        model = np.arange(len(words)) < WORDS - 1
        buckets = np.fromiter(map(bucket_of, words), np.int64, len(words))
        self.model_id = np.where(model, np.arange(len(words)) + 1, WORDS + buckets).astype(np.int32)
        # log10 of a bucket's smoothed total: rare words divide their count by it
        self.bucket_log = np.log10(np.asarray(bucket_tokens, float) + 0.5 * (np.asarray(bucket_words, float) + 1))
        self.own_log = np.where(model, 0.0, self.log_count - self.bucket_log[buckets])
        mass = np.zeros(SIZE)
        mass[0] = ends
        np.add.at(mass, self.model_id[model], counts[model])
        mass[WORDS:] = bucket_tokens
        self.mass = mass

        self.key = uuid.uuid4().hex

    def index(self) -> dict[bytes, int]:
        return worker_cache(self.key, lambda: {w: i for i, w in enumerate(self.words)})

    def encode(self, words: list[bytes], index: dict[bytes, int]):
        """Model ids with the end; sums over the words: log10 counts of the
        frequent words, and their own log10 shares less the bucket totals of
        the others; how many words are frequent; the other words."""
        at = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
        ids = np.zeros(len(words) + 1, np.int16)
        known = at >= 0
        frequent = at[known]
        ids[:-1][known] = self.model_id[frequent]
        rare: list[bytes] = []
        other = 0.0
        if len(frequent) < len(words):
            rare = [words[i] for i in np.flatnonzero(~known).tolist()]
            buckets = np.fromiter(map(bucket_of, rare), np.int64, len(rare))
            ids[:-1][~known] = WORDS + buckets
            other = float(self.bucket_log[buckets].sum())
        return (ids, float(self.log_count[frequent].sum()), float(self.own_log[frequent].sum()) - other,
                len(frequent), rare)


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (word, c) over all ``docs``; the end token is among them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(n: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())],
                                              names=["word", "c"])

        n: Counter = Counter()
        for batch in batches:
            for b in text_bytes(batch, "text"):
                n.update(tokens_of(b))
                n[END] += 1
                if len(n) > COUNT_FLUSH:
                    yield rows(n)
                    n = Counter()
        if n:
            yield rows(n)

    return (docs.select(F.col(text).alias("text")).mapInArrow(count, "word binary, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def vocabulary(counts: DataFrame, total: int) -> Vocabulary:
    least = max(1, -(-total // FREQUENT))  # so at most FREQUENT words
    rows = (counts.where((F.col("c") >= least) & (F.col("word") != F.lit(END)))
            .orderBy(F.col("c").desc(), "word").limit(FREQUENT).toPandas())
    words = [bytes(w) for w in rows["word"]]
    c = rows["c"].to_numpy(np.float64)
    end = counts.where(F.col("word") == F.lit(END)).select("c").first()
    bucket = F.crc32(F.expr("substring(word, greatest(1, length(word) - 1), 2)")) % CLASS_SIZE
    per = (counts.where(F.col("word") != F.lit(END)).groupBy(bucket.alias("k"))
           .agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect())  # at most CLASS_SIZE rows
    tokens, kinds = np.zeros(CLASS_SIZE), np.zeros(CLASS_SIZE)
    for k, n_tokens, n_words in per:
        tokens[k], kinds[k] = n_tokens, n_words
    for w, n in zip(words[:WORDS - 1], c[:WORDS - 1], strict=True):  # the model's own words leave their buckets
        tokens[bucket_of(w)] -= n
        kinds[bucket_of(w)] -= 1
    return Vocabulary(words, c, end[0] if end else 0, tokens, kinds)


def encoded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``docs`` (doc_id, learn, key, text) with the text replaced by its model
    ids (16-bit, as bytes), the sums of ``Vocabulary.encode`` and its rare
    words with their numbers."""

    def encode(texts: list[bytes]) -> list[list]:
        index = vocab.index()
        out: list[list] = [[] for _ in range(7)]
        for b in texts:
            words = tokens_of(b)
            ids, logs, own, known, rare = vocab.encode(words, index)
            n = Counter(rare)
            for col, v in zip(out, (ids.tobytes(), len(ids), known + (vocab.ends > 0), logs + vocab.end_log, own,
                                    list(n), list(n.values())), strict=True):
                col.append(v)
        return out

    fields = [field("ids", "binary"), field("n_tokens", "long"), field("known", "long"), field("base", "double"),
              field("own", "double"), field("rare", "array:binary"), field("rare_n", "array:int")]
    return add_columns(docs, "text", fields, encode, drop=("text",))


def _chunks(texts: Iterable[bytes]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for b in texts:
        held.append(np.frombuffer(b, np.int16))
        size += len(held[-1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _first(texts: Iterable[bytes], most: int) -> Iterator[bytes]:
    """The first texts of at most ``most`` tokens together."""
    size = 0
    for b in texts:
        size += len(b) // 2
        if size > most:
            return
        yield b


NETWORKS = "learner int, flat array<double>, tokens double"


def _networks(flat: np.ndarray, rate: float, rounds: int = 1, most: int | None = None):
    """For rows (learner, ids) in the learners' order: one row (learner, sum,
    tokens) each, the network learned from ``flat`` times its tokens. With
    ``most``, from the first that many tokens, which are held for all rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for k, own in groupby(rows, itemgetter(0)):
            learner = Learner(Network(flat.copy()), rate)
            texts = map(itemgetter(1), own)
            kept = _chunks(texts) if most is None else list(_chunks(_first(texts, most)))
            for _ in range(rounds):
                for chunk in kept:
                    learner.learn(chunk)
            if learner.tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([learner.net.flat.astype(np.float64) * learner.tokens]),
                     pa.array([float(learner.tokens)])], names=["learner", "flat", "tokens"])

    return run


def _summed(networks: pa.Table) -> pa.Table:
    """One row: the sums of the arrays, in the learners' order, and of the tokens."""
    networks = networks.sort_by("learner")
    total = 0.0
    for flat in networks.column("flat"):
        total = total + flat.values.to_numpy()
    return pa.table({"learner": pa.array([networks.column("learner")[0].as_py()], pa.int32()),
                     "flat": pa.array([total]), "tokens": pa.array([sum(networks.column("tokens").to_pylist())])})


def _averaged(networks: DataFrame, before: np.ndarray) -> np.ndarray:
    """The mean network; ``before`` if there is none. Arrays are summed within
    groups of learners, then over the groups; one reaches the driver."""
    for groups in (SUM_GROUPS, 1):
        networks = networks.groupBy(F.pmod("learner", F.lit(groups))).applyInArrow(_summed, NETWORKS)
    got = networks.first()
    return before if got is None else np.array(got["flat"]) / got["tokens"]


def train(coded: DataFrame, vocab: Vocabulary, tokens: int) -> Network:
    """The network learned from all rows of ``coded`` (doc_id, n_tokens, ids),
    which hold ``tokens`` tokens."""
    flat = Network.fresh(vocab.mass).flat
    if not vocab.ends:
        return Network(flat)
    at = F.xxhash64("doc_id", "ids")  # of id and ids, so that copies are chosen like any other
    short = coded.where(F.col("n_tokens") <= WARM_LONGEST)
    size = short.agg(F.sum("n_tokens")).first()[0] or 0
    share = int((1 << 40) * min(1.0, WARM_TOKENS / max(1, size)))
    few = (short.where(F.pmod(at, F.lit(1 << 40)) < F.lit(share)).select(F.lit(0).alias("learner"), "ids", "doc_id")
           .coalesce(1).sortWithinPartitions(at, "doc_id", "ids").select("learner", "ids"))
    # about WARM_TOKENS by their share; a little more by chance
    flat = _averaged(few.mapInArrow(_networks(flat, WARM_RATE, WARM_ROUNDS, WARM_TOKENS * 5 // 4), NETWORKS), flat)
    n = max(1, min(MAX_LEARNERS, -(-tokens // LEARNER_TOKENS)))
    dealt = (coded.select(F.pmod(at, F.lit(n)).cast("int").alias("learner"), at.alias("at"), "doc_id", "ids")
             .repartitionById(n, "learner").sortWithinPartitions("learner", "at", "doc_id", "ids"))
    return Network(_averaged(dealt.select("learner", "ids").mapInArrow(_networks(flat, RATE), NETWORKS), flat))


def _model_scores(coded: DataFrame, net: Network) -> DataFrame:
    """``coded`` without its ids and rare words, with ``score``: the log10
    probability, but for the counts of rare words."""
    flat = net.flat.copy()
    keep = ["doc_id", "learn", "key", "n_tokens", "known", "base"]
    schema = T.StructType([coded.schema[c] for c in keep] + [field("model", "double")])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network(flat)
        for batch in batches:
            docs = [np.frombuffer(b, np.int16) for b in batch.column("ids").to_pylist()]
            value = batch.column("own").to_numpy().copy()
            at = 0
            while at < len(docs):  # a chunk of documents at a time
                stop, size = at, 0
                while stop < len(docs) and size < CHUNK:
                    size += len(docs[stop])
                    stop += 1
                value[at:stop] += log_probabilities(model, docs[at:stop]) / np.log(10)
                at = stop
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(value)],
                                             names=[*keep, "model"])

    return coded.select(*keep, "ids", "own").mapInArrow(score, schema)


def lm_scores(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score. ``learn`` marks the learning documents."""
    src = docs.select(F.col(id_col).alias("doc_id"), learn.alias("learn"), F.col(text).alias("text"))
    counts = cut(token_counts(src.where("learn")))
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    vocab = vocabulary(counts, total)
    coded = cut(encoded(src.select("doc_id", "learn", text_key("text").alias("key"), "text"), vocab))
    heads = _model_scores(coded, train(coded.where("learn"), vocab, total))
    rare = coded.select("doc_id", "key", F.posexplode(F.arrays_zip("rare", "rare_n")).alias("at", "r")).select(
        F.col("doc_id").alias("r_id"), F.col("key").alias("r_key"), F.col("r.rare").alias("word"),
        F.col("r.rare_n").alias("n"), (F.col("at") == 0).cast("int").alias("lead"))
    c = F.coalesce("c", F.lit(0))
    # rows with the same id and text meet in one group: `copies` of them
    tails = (rare.join(counts, "word", "left").groupBy("r_id", "r_key")
             .agg(F.sum(F.col("n") * F.log10(c + 0.5)).alias("logs"), F.sum("lead").alias("copies"),
                  F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("seen")))
    whole = F.lit(float(np.log10(total + 0.5 * (kinds + 1))))
    logs = F.coalesce(F.col("logs") / F.col("copies"), F.lit(0.0))
    joined = heads.join(tails, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")), "left")
    return joined.select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce(F.expr("seen div copies"), F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * whole).alias("base_score"), (F.col("model") + logs).alias("score"))
