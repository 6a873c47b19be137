"""Secret scan: candidates, then a random forest that removes false positives.

Candidates are known key formats, values assigned to a credential-like name,
and long unbroken tokens. A random forest scores each from its length,
character transitions, dictionary coverage, path shape and neighbouring
words; candidates at or above the cutoff are findings.

The forest learns from labelled findings. Where none are given it labels
candidates of the corpus itself by distant supervision: a known key format or
a value assigned to a credential name that mixes letters and digits is a
secret; tokens of letters only, numbers and values named as digests are not;
other candidates are not learned from. The kind of a candidate is not a
feature; the words before it are, as the method asks, and they hold the credential or digest name that
the label came from. So without given findings the forest generalises the rules to
candidates that they leave open (long tokens, letters-only values), and is no independent judge of them.
At most about ``SAMPLE_ROWS`` findings (a documented bound, chosen by hash)
are learned from. The dictionary is corpus-wide: words that make up at least
1/``DICTIONARY`` of all dictionary-like words, so at most that many.

Defined results: a null or empty text has no finding; without learned
findings (or of one class only) the distant label itself decides; spans are
code points, end exclusive, and never overlap; repeated rows get equal
results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, cut, field, text_bytes, unused

SAMPLE_ROWS = 20_000
DICTIONARY = 20_000
TREES = 24
DEPTH = 8
BINS = 16
CUTOFF = 0.5
MIN_TOKEN = 16
MASK = "[SECRET]"

# Published key formats.
FORMATS = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|glpat-[A-Za-z0-9_-]{20,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})(?![A-Za-z0-9])"
    r"|-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")
# Names that hold credentials, names that hold digests, mock values.
_NAMES = r"password|passwd|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|private[_-]?key|credential|auth"
# Every format holds one of these, and every assignment one of the signs.
FORMAT_MARKS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "xox", "sk_live_", "AIza",
                "glpat-", "eyJ", "-----BEGIN ")
_SIGN = re.compile("[:=]")
_NAMED = re.compile(rf"(?i)(?:{_NAMES})[A-Za-z0-9_-]{{0,20}}[\"']?[ \t]{{0,3}}$")
# A quoted value goes to its closing quote on the line, any other to white space.
_VALUE = re.compile(r"""(?::=|=>|=|:)[ \t]{0,3}(?:"((?:[^"\\\r\n]|\\.)+)"|'((?:[^'\\\r\n]|\\.)+)'|["']?([^\s"']\S*))""")
TOKEN = re.compile(rf"[A-Za-z0-9_+/-]{{{MIN_TOKEN},}}={{0,2}}")
_NAME = re.compile(rf"(?i)(?:{_NAMES})")
_DIGEST = re.compile(r"(?i)sha-?\d*|md5|hash|digest|checksum|commit|uuid|revision|etag")
_MOCK = re.compile(r"(?i)example|sample|dummy|placeholder|changeme|your|xxxx|\*\*\*|test")
_LETTERS = re.compile(r"[a-z]{3,}")
FEATURES = ("length", "transitions", "digits", "upper", "hex", "entropy", "coverage", "word_run", "slashes", "dots",
            "name_before", "digest_before", "assigned", "quoted", "mock", "distinct", "vowels")


def _bare(value: str) -> str:
    """An unquoted value without the punctuation of the text around it: stops, quotes and
    closing brackets that it does not open."""
    while value:
        last = value[-1]
        opened = {")": "(", "]": "[", "}": "{", ">": "<"}.get(last)
        if last in ".,;\"'" or (opened and value.count(last) > value.count(opened)):
            value = value[:-1]
        else:
            break
    return value


def candidates(text: str) -> list[tuple[int, int, str, int]]:
    """Spans (start, end, kind, distant label); label -1 is unlabelled."""
    found: list[tuple[int, int, str, int]] = []
    if any(mark in text for mark in FORMAT_MARKS):
        found += [(m.start(), m.end(), "format", 1) for m in FORMATS.finditer(text)]
    after = 0
    for sign in _SIGN.finditer(text):
        at = sign.start()
        if at < after or not _NAMED.search(text[max(after, at - 48):at]):
            continue
        m = _VALUE.match(text, at)
        value = _bare(m[3]) if m and m[3] else m[m.lastindex] if m else ""
        if len(value) >= 6:
            after = m.start(m.lastindex) + len(value)
            mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
            mock = _MOCK.search(value) is not None
            plain = any(c.isspace() for c in value)
            found.append((m.start(m.lastindex), after, "assigned",
                          0 if mock else 1 if mixed and len(value) >= 8 and not plain else -1))
    if max(map(len, text.split()), default=0) >= MIN_TOKEN:
        for m in TOKEN.finditer(text):
            value = m.group()
            digest = _DIGEST.search(text[max(0, m.start() - 24):m.start()]) is not None
            plain = value.isalpha() or value.strip("=+/-_").isdigit()
            found.append((m.start(), m.end(), "token", 0 if plain or digest else -1))
    found.sort(key=lambda c: (("format", "assigned", "token").index(c[2]), c[0]))
    if len(found) < 2:
        return found
    taken: list[tuple[int, int, str, int]] = []
    covered: list[tuple[int, int]] = []
    for c in found:  # stronger kinds first; later overlaps go
        if not _overlaps(covered, c[0], c[1]):
            taken.append(c)
            _insert(covered, (c[0], c[1]))
    return sorted(taken)


def _at(spans: list[tuple[int, int]], start: int) -> int:
    lo, hi = 0, len(spans)
    while lo < hi:
        mid = (lo + hi) // 2
        if spans[mid][0] < start:
            lo = mid + 1
        else:
            hi = mid
    return lo


def _overlaps(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    i = _at(spans, start)
    return (i < len(spans) and spans[i][0] < end) or (i > 0 and spans[i - 1][1] > start)


def _insert(spans: list[tuple[int, int]], span: tuple[int, int]) -> None:
    spans.insert(_at(spans, span[0]), span)


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def coverage(value: str, dictionary: frozenset[str]) -> float:
    """Share of the characters in dictionary words, longest words first."""
    hit = 0
    for run in _LETTERS.findall(value.lower()):
        i = 0
        while i < len(run):
            step = next((k for k in range(min(12, len(run) - i), 2, -1) if run[i:i + k] in dictionary), 0)
            hit += step
            i += step or 1
    return hit / len(value)


def describe(text: str, start: int, end: int, dictionary: frozenset[str]) -> list[float]:
    """The features of a candidate."""
    v = text[start:end]
    n = len(v)
    kinds = [_kind(c) for c in v]
    counts = np.array(list(Counter(v).values()), float) / n
    before = text[max(0, start - 32):start]
    near = before.rsplit("\n", 1)[-1]
    runs = _LETTERS.findall(v.lower())
    letters = sum(c.isalpha() for c in v)
    return [
        min(n, 200), sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, len(kinds) - 1),
        sum(c.isdigit() for c in v) / n, sum(c.isupper() for c in v) / n,
        sum(c in "0123456789abcdefABCDEF" for c in v) / n, float(-(counts * np.log2(counts)).sum()),
        coverage(v, dictionary), max(map(len, runs), default=0) / n, v.count("/") / n, v.count(".") / n,
        float(_NAME.search(near) is not None), float(_DIGEST.search(near) is not None),
        float(near.rstrip(" \"'").endswith(("=", ":", "=>"))), float(before.endswith(("\"", "'"))),
        float(_MOCK.search(v) is not None), len(set(v)) / min(n, 64),
        sum(c in "aeiouAEIOU" for c in v) / max(1, letters),
    ]


class Forest:
    """Random forest of binned, flat trees."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
        b = self._bins(x)
        self.trees = []
        for _ in range(TREES):
            rows = rng.integers(0, len(y), len(y))
            nodes: list[list[float]] = []
            self._grow(b[rows], y[rows], rng, nodes, 0)
            self.trees.append(np.array(nodes))

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def _grow(self, b, y, rng, nodes, depth) -> int:
        """Appends the subtree: rows (feature or -1, bin, left, right, share)."""
        me = len(nodes)
        nodes.append([-1, 0, 0, 0, (y.sum() + 0.5) / (len(y) + 1)])
        if depth == DEPTH or len(y) < 4 or y.min() == y.max():
            return me
        best = (1e-9, -1, 0)
        for j in rng.permutation(b.shape[1])[:max(2, int(b.shape[1] ** 0.5) + 1)]:
            m = len(self.edges[j]) + 1
            n, s = np.cumsum(np.bincount(b[:, j], minlength=m)), np.cumsum(np.bincount(b[:, j], y, m))
            n, s, total, ones = n[:-1], s[:-1], len(y), y.sum()
            ok = (n > 0) & (n < total)
            if not ok.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = s * s / n + (ones - s) ** 2 / (total - n) - ones * ones / total
            gain = np.where(ok, gain, 0)
            if gain.max() > best[0]:
                best = (float(gain.max()), int(j), int(gain.argmax()))
        if best[1] >= 0:
            left = b[:, best[1]] <= best[2]
            lo = self._grow(b[left], y[left], rng, nodes, depth + 1)
            hi = self._grow(b[~left], y[~left], rng, nodes, depth + 1)
            nodes[me][:4] = [best[1], best[2], lo, hi]
        return me

    def score(self, x: np.ndarray) -> np.ndarray:
        """Mean share of secrets over the trees, by vectorised descent."""
        b = self._bins(x)
        rows = np.arange(len(x))
        total = np.zeros(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = tree[at, 0].astype(np.int64)
                left = b[rows, np.maximum(f, 0)] <= tree[at, 1]
                at = np.where(f < 0, at, np.where(left, tree[at, 2], tree[at, 3]).astype(np.int64))
            total += tree[at, 4]
        return total / len(self.trees)


def dictionary(docs: DataFrame, text: str = "text") -> frozenset[str]:
    """Lower-case words of three to twelve letters that make up at least
    1/``DICTIONARY`` of all such words of the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(n: Counter) -> pa.RecordBatch:
            own = [(w.decode("ascii"), c) for w, c in n.items() if 3 <= len(w) <= 12 and w.isalpha() and w.islower()]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in own], pa.string()),
                                               pa.array([c for _, c in own], pa.int64())], names=["word", "c"])

        n: Counter = Counter()
        for batch in batches:
            for b in text_bytes(batch, "text"):
                n.update(b.split())
                if len(n) > 200_000:
                    yield rows(n)
                    n = Counter()
        if n:
            yield rows(n)

    counts = (docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, c long")
              .groupBy("word").agg(F.sum("c").alias("c")))
    counts = cut(counts)
    total = counts.agg(F.sum("c")).first()[0] or 0
    return frozenset(r[0] for r in counts.where(F.col("c") >= max(2, -(-total // DICTIONARY))).select("word").collect())


def labelled_findings(docs: DataFrame, words: frozenset[str], text: str = "text") -> DataFrame:
    """Rows (x, label) of all candidates that distant supervision labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = [], []
            for b in text_bytes(batch, "text"):
                value = b.decode("utf-8", "replace")
                for start, end, _, label in candidates(value):
                    if label >= 0:
                        x.append(describe(value, start, end, words))
                        y.append(label)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float32())), pa.array(y, pa.int32())],
                                             names=["x", "label"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "x array<float>, label int")


def fit(findings: DataFrame) -> Forest | None:
    """The forest from labelled findings (x, label); None if one class lacks.
    Equal findings count once, so a hot group of copies weighs as one."""
    rows = cut(findings.where(F.col("label").isin(0, 1)).distinct())  # candidates are looked for once
    sizes = dict(rows.groupBy("label").count().collect())
    if len(sizes) < 2:
        return None
    half = SAMPLE_ROWS // 2
    keep = F.lit(False)
    for label, n in sizes.items():
        share = int(1_000_000 * min(1.0, half / n)) + 1
        keep = keep | ((F.col("label") == label) & (F.pmod(F.xxhash64("x"), F.lit(1_000_000)) < share))
    got = rows.where(keep).orderBy(F.xxhash64("x", "label")).limit(2 * SAMPLE_ROWS).toPandas()
    return Forest(np.array(got["x"].tolist(), np.float32), got["label"].to_numpy(np.float64))


def find(value: str, words: frozenset[str], forest: Forest | None,
         cutoff: float = CUTOFF) -> tuple[int, list[tuple[int, int, str, float]]]:
    """How many candidates, and the findings (start, end, kind, score)."""
    found = candidates(value)
    if not found:
        return 0, []
    if forest is None:
        scores = [1.0 if label == 1 else 0.0 for *_, label in found]
    else:
        scores = forest.score(np.array([describe(value, a, b, words) for a, b, *_ in found], np.float32)).tolist()
    return len(found), [(a, b, k, s) for (a, b, k, _), s in zip(found, scores, strict=True) if s >= cutoff]


def _model(docs: DataFrame, text: str, findings: DataFrame | None) -> tuple[frozenset[str], Forest | None]:
    words = dictionary(docs, text)
    return words, fit(findings if findings is not None else labelled_findings(docs, words, text))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", findings: DataFrame | None = None,
                cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: its id, candidates, findings, their spans
    (kind:start:end, comma-joined) and the highest score of a finding."""
    words, forest = _model(docs, text, findings)

    def compute(texts: list[bytes]) -> list[list]:
        out: list[list] = [[], [], [], []]
        for b in texts:
            n, kept = find(b.decode("utf-8", "replace"), words, forest, cutoff)
            out[0].append(n)
            out[1].append(len(kept))
            out[2].append(",".join(f"{k}:{a}:{e}" for a, e, k, _ in kept))
            out[3].append(max((s for *_, s in kept), default=0.0))
        return out

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    fields = [field("n_candidates", "long"), field("n_secrets", "long"), field("spans", "string"),
              field("score", "double")]
    return add_columns(src, "text", fields, compute, drop=("text",))


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars",
           findings: DataFrame | None = None, cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` with every finding replaced by ``MASK``; ``length`` (a column
    of code-point counts, if there is one) follows the changed texts."""
    words, forest = _model(docs, text, findings)

    def compute(texts: list[bytes]) -> list[list]:
        out: list = []
        for b in texts:
            value = b.decode("utf-8", "replace")
            kept = find(value, words, forest, cutoff)[1]
            parts, at = [], 0
            for a, e, *_ in kept:
                parts += [value[at:a], MASK]
                at = e
            out.append("".join([*parts, value[at:]]) if kept else None)
        return [out]

    name = unused(docs, "redacted")
    changed = F.col(name).isNotNull()
    new = add_columns(docs, text, [field(name, "string")], compute)
    cols = []
    for c in docs.columns:
        if c == text:
            cols.append(F.coalesce(F.col(name), F.col(text)).alias(c))
        elif c == length:
            cols.append(F.when(changed, F.length(name).cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return new.select(cols)
