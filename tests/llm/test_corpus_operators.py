"""Operators on whole corpora against brute force, round trips and held-out
rows, and the odd cases of each."""

from __future__ import annotations

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from oracle import compare
from pyspark.sql import functions as F
from tidemark.llm import decontaminate, gru_lm, language_id, packing, quality_gam, simhash
from tidemark.llm.common import id_remainder
from tidemark.llm.queries import ORACLE, REGISTRY
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def remainder(doc_id, n: int) -> int:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % n


# languages

def test_language_held_out(spark, sf_small):
    rows = REGISTRY["op2_language"](spark, sf_small).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_mixture_recovers_shares():
    rng = np.random.default_rng(1)
    words = np.full((100, 3), -20.0)
    words[np.arange(100), np.where(np.arange(100) < 70, 0, 2)] = -10.0
    words += rng.normal(0, 0.1, words.shape)
    shares = language_id.mixture(np.concatenate([words, words[:30]]), np.array([100, 30]))
    assert shares[0] == pytest.approx([0.7, 0, 0.3], abs=0.01) and shares[1].tolist() == [1, 0, 0]


def test_language_odd_rows(spark, odd, none):
    rows = language_id.language_id(odd, id_remainder(4) != 2).collect()
    assert len(rows) == 11
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in rows if r["doc_id"] in (2, 3, 4, 6))
    assert language_id.language_id(none, F.lit(True)).count() == 0
    figures = odd.where("doc_id = 8").withColumn("text", F.lit("\u00b2 \u00bd 3"))
    rows = language_id.language_id(odd.unionByName(figures), F.col("doc_id") != 8).collect()
    assert sorted(r["lang_pred"] for r in rows if r["doc_id"] == 8)[-1] == "und"
    unlearned = language_id.language_id(odd, F.lit(False))
    assert unlearned.where("lang_pred = 'und' and held_out").count() == 11


# quality

def test_quality_held_out(spark, sf_small):
    rows = REGISTRY["op3_quality"](spark, sf_small).collect()
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held) >= 0.85


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((4000, 16))
    y = ((x[:, 3] > 0.5) ^ (x[:, 7] > 0.4)).astype(float)
    model = quality_gam.Gam(x[:3000], y[:3000])
    assert (3, 7) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.9


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (7, None), (99, 0)], "doc_id long, quality int")
    rows = quality_gam.quality_gam(odd, labels, F.lit(True)).collect()
    assert len(rows) == 11 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}) == 1
    empty = quality_gam.quality_gam(odd, labels.limit(0), F.lit(True)).collect()
    assert all(r["score"] == 0.5 for r in empty)
    assert quality_gam.quality_gam(none, labels, F.lit(True)).count() == 0


# decontamination

def brute_contamination(docs, items) -> dict:
    windows = defaultdict(set)
    for item_id, text in items:
        w = ALNUM.findall(ascii_lower(text or ""))
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[i:i + m])].add(str(item_id))
    out = {}
    for doc_id, text in docs:
        w = ALNUM.findall(ascii_lower(text or ""))
        hit, found = set(), set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in windows:
                    hit.update(range(i, i + m))
                    found |= windows[tuple(w[i:i + m])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.fixture(scope="module")
def contaminated(spark):
    item = " ".join(f"w{i}" for i in range(20))
    items = [(1, item), (2, "Short ITEM, here!"), (3, None), (4, ""), (10, item), (5, "é É ñ"), (6, "a " * 30)]
    docs = [(1, f"start {item} end"), (2, " ".join(f"w{i}" for i in range(12))), (3, "a short-item here, short item here"),
            (4, None), (5, ""), (6, "x " * 500 + item.upper()), (7, "é É ñ"), (8, "É é ñ"), (9, "a " * 14), (9, "a " * 14),
            (11, "\x00a\x7f" + item.replace(" ", "--") + " z")]
    return docs, items


def test_contamination_brute_force(spark, contaminated):
    docs, items = contaminated
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("w", "key", "hash")})
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("len", F.lit(1))
    rows = decontaminate.contamination_report(d, b).collect()
    want = brute_contamination(docs, items)
    assert len(rows) == len(docs)
    assert {r[0]: tuple(r[1:]) for r in rows} == want
    kept = decontaminate.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in docs if not want[i][4])
    cleaned = {r["doc_id"]: r["text"] for r in decontaminate.cut_spans(d, b).collect()}
    assert cleaned[1] == "start end" and cleaned[2] == docs[1][1] and cleaned[4] is None
    assert all(w[1] == 0 for w in brute_contamination(cleaned.items(), items).values())


def test_contamination_shuffled_join_agrees(spark, contaminated, monkeypatch):
    docs, items = contaminated
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, decontaminate.contamination_report(d, b).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, decontaminate.contamination_report(d, b).collect())) == want


def test_contamination_of_long_texts_and_shared_templates(spark, monkeypatch):
    """Windows over chunk borders, a text much longer than a chunk, and items that share windows or differ in one."""
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(300)]
    long = " ".join(rng.choice(words, 5000))
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    docs = [(k, " ".join(["x"] * k + [item, "and more"])) for k in range(0, 140, 7)]
    docs += [(500, f"{long} {item} {long}"), (501, long), (502, None), (503, "")]
    items = [(k, item) for k in range(30)] + [(100, item + " pi"), (101, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu rho"),
                                              (102, "w1 w2"), (103, " ".join(long.split()[70:90])), (104, None), (5, "nu xi")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute_contamination(docs, items)
    for rows, size in ((10**6, 64 << 20), (0, 64 << 20), (10**6, 10)):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", size)
        got = {r[0]: tuple(r)[1:] for r in decontaminate.contamination_report(d, b).collect()}
        assert got == want


def test_contamination_cost_is_linear(spark):
    """Rows that the scan makes: one a window and document, each with the words of a chunk at most, and
    one hit a window however many items are equal."""
    text = " ".join(f"w{k}" for k in range(4000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    src = docs.select("doc_id", decontaminate.text_key("text").alias("key"), decontaminate.normalised_words("text").alias("w"))
    src = src.withColumn("n", F.size("w"))
    rows = decontaminate._scanned(decontaminate._chunks(src), [13])
    assert rows.count() == 4000 - 13 + 1 + 1 and rows.agg(F.max(F.size("c"))).first()[0] <= decontaminate.CHUNK + 12
    items = spark.createDataFrame([(k, " ".join(f"w{k}" for k in range(20))) for k in range(500)], "item_id long, text string")
    side, members = decontaminate._item_sets(decontaminate.test_windows(items))
    assert side.count() == 8 and side.select("items").distinct().count() == 1 and members.count() == 500
    assert decontaminate._by_broadcast(src, side, [13]).where("span is not null").count() == 8


def test_contamination_oracle_and_odd_rows(spark, sf_small, odd, none):
    s, d, *_ = compare(spark, sf_small, REGISTRY["op5_decontamination"], ORACLE["op5_decontamination"])
    assert s == d
    items = spark.createDataFrame([(1, "the cat sat on the mat")], "item_id long, text string")
    rows = decontaminate.contamination_report(odd, items).collect()
    assert len(rows) == 11 and sum(r["contaminated"] for r in rows) == 3
    assert decontaminate.drop_contaminated(odd, items).count() == 8
    assert decontaminate.contamination_report(odd, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination_report(none, items).count() == 0


def test_contamination_is_native(spark, sf_small):
    docs, items = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    side, _ = decontaminate._item_sets(decontaminate.test_windows(items))
    src = docs.select("doc_id", decontaminate.text_key("text").alias("key"), decontaminate.normalised_words("text").alias("w"))
    scan = decontaminate._by_broadcast(src.withColumn("n", F.size("w")), side, [13])
    plans = [df._jdf.queryExecution().toString() for df in (REGISTRY["op5_decontamination"](spark, sf_small), scan)]
    assert not any(re.search("Python|Arrow|Pandas", p) for p in plans) and "BroadcastHashJoin" in plans[1]


# near-duplicates

def brute_fingerprint(text: str) -> int:
    w = WORD.findall(ascii_lower(text))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(prints: list[int], max_bits: int = 2) -> dict[int, int]:
    nodes = sorted(set(prints))
    root = {p: p for p in nodes}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in nodes}


def test_simhash_query_brute_force(spark, sf_small):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    prints = {i: brute_fingerprint(t or "") for i, t in docs}
    roots = brute_components(list(prints.values()))
    low: dict = {}
    for i, p in prints.items():
        low[roots[p]] = min(i, low.get(roots[p], i))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in REGISTRY["op6_simhash"](spark, sf_small).collect()}
    assert got == {i: (f"{p:016x}", low[roots[p]]) for i, p in prints.items()}


def test_simhash_links_lose_nothing(spark):
    rng = np.random.default_rng(5)
    seeds = [int(x) for x in rng.integers(0, 2**63, 40)] + [0, 2**64 - 1, 1 << 63]
    prints = set()
    for s in seeds:  # chains, stars and a dense ball around each seed
        prints.add(s)
        p = s
        for _ in range(12):
            p ^= 1 << int(rng.integers(0, 64))
            p ^= 1 << int(rng.integers(0, 64))
            prints.add(p)
        prints |= {s ^ (1 << b) for b in range(0, 64, 3)}
    prints |= {i for i in range(400)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r["fp"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    want = brute_components(list(prints))
    groups = defaultdict(set)
    for p, r in want.items():
        groups[r].add(p - (1 << 64) if p >> 63 else p)
    for g in groups.values():
        assert len(g) == 1 and not g & set(got) or {got[p] for p in g} == {min(g)}


def test_simhash_odd_rows(spark, odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 11
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append((r["fingerprint"], r["component_id"]))
    assert {x[1] for x in by[1] + by[7]} == {1} and {by[i][0] for i in (2, 3, 4)} == {("0" * 16, 2)}
    assert {x[1] for x in by[None]} == {None}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert Counter(ids) == Counter([1, 2, None, 5, 6, 8])
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_simhash_hot_group(spark, monkeypatch):
    rows = [(i, "one hot text of many copies") for i in range(3000)] + [(i, f"text number {i} alone {i * 7}") for i in range(3000, 3500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(df)
    assert got.where("component_id = 0").count() == 3000 and got.count() == 3500
    assert simhash.keep_one(df).where("doc_id < 3000").count() == 1


def test_language_shares_depend_on_the_text_alone():
    """Closely mixed texts beside others that settle sooner or later."""
    rng = np.random.default_rng(3)
    lengths = np.array([40, 3, 200, 1, 15, 90, 7, 60])
    scores = -rng.random((int(lengths.sum()), 4)) * np.repeat(rng.choice([0.1, 1.0, 30.0], len(lengths)), lengths)[:, None]
    starts = np.cumsum(lengths) - lengths
    together = language_id.mixture(scores, lengths)
    for i, (s, n) in enumerate(zip(starts, lengths)):
        assert (language_id.mixture(scores[s:s + n], lengths[i:i + 1])[0] == together[i]).all()


# language model

def test_lm_counts_and_base(spark, sf_small):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    tokens = {i: [*WORD.findall(ascii_lower(t or "")), None] for i, t in docs}
    c = Counter(w for i, ts in tokens.items() if remainder(i, 5) != 1 for w in ts)
    n, v = sum(c.values()), len(c)
    rows = REGISTRY["op9_lm"](spark, sf_small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ts = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ts), sum(c[w] > 0 for w in ts), n)
        assert r["held_out"] == (remainder(r["doc_id"], 5) == 1)
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def tiny_vocabulary():
    words = [f"w{i}".encode() for i in range(2000)]
    counts = np.arange(2000, 0, -1).astype(float)
    rare = [(gru_lm.bucket_of(w), c) for w, c in zip(words, counts)][gru_lm.WORDS - 1:]
    tokens, kinds = np.zeros(gru_lm.CLASS_SIZE), np.zeros(gru_lm.CLASS_SIZE)
    for b, n in rare:
        tokens[b] += n
        kinds[b] += 1
    return gru_lm.Vocabulary(words, counts, 50, tokens, kinds)


def test_lm_is_a_distribution():
    net = gru_lm.Network.fresh(tiny_vocabulary().mass)
    docs = [np.array([5, i], np.int32) for i in range(gru_lm.SIZE)]
    first = gru_lm.log_probabilities(net, [np.array([5], np.int32)])[0]
    assert np.exp(gru_lm.log_probabilities(net, docs) - first).sum() == pytest.approx(1, abs=1e-3)


def test_lm_carries_state_and_gradients(monkeypatch):
    net = gru_lm.Network.fresh(tiny_vocabulary().mass)
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, gru_lm.SIZE, n).astype(np.int32) for n in (1, 3, 90, 31, 64, 7)]
    together = gru_lm.log_probabilities(net, docs)
    assert together == pytest.approx([gru_lm.log_probabilities(net, [d])[0] for d in docs], rel=1e-4)
    # gradients of one whole window against finite differences
    docs, grads = [d[:20] for d in docs], []
    plain = gru_lm._output
    monkeypatch.setattr(gru_lm, "_output", lambda n, h, t, g=None: (grads.append(g), plain(n, h, t, g))[1])
    gru_lm.Learner(gru_lm.Network(net.flat.copy()), 0.0).learn(docs[:1] + docs[3:4])
    monkeypatch.setattr(gru_lm, "_output", plain)
    grad = grads[0].flat
    for i in np.argsort(-np.abs(grad))[:40:4].tolist():
        step = np.zeros_like(net.flat)
        step[i] = 0.01
        up, down = (gru_lm.log_probabilities(gru_lm.Network(net.flat + s), docs[:1] + docs[3:4]).sum() for s in (step, -step))
        assert grad[i] == pytest.approx(-(up - down) / 0.02, rel=0.05, abs=1e-3)


def test_lm_training_is_not_cut():
    """Four warm rounds; 1536 texts of one window in 256 lanes are six updates."""
    learner = gru_lm.Learner(gru_lm.Network.fresh(tiny_vocabulary().mass), gru_lm.RATE)
    learner.learn([np.full(gru_lm.WINDOW, i % 50, np.int16) for i in range(1536)])
    assert learner.steps == 6 and learner.tokens == 1536 * gru_lm.WINDOW
    assert gru_lm.WARM_ROUNDS == 4


def test_lm_does_not_depend_on_the_partitions(spark, small, monkeypatch):
    """Several learners; their average equals that of learners run one by one."""
    monkeypatch.setattr(gru_lm, "LEARNER_TOKENS", 40_000)
    learn = F.col("doc_id") % 5 != 1
    runs = [gru_lm.lm_scores(small.repartition(n), learn).select("doc_id", "score").collect() for n in (1, 7)]
    one, other = (dict(map(tuple, r)) for r in runs)
    assert len(one) == small.count() and one == pytest.approx(other, rel=1e-6)  # batches of scoring round differently


def test_lm_average_against_plain(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "SUM_GROUPS", 2)
    rng = np.random.default_rng(6)
    texts = [(k, rng.integers(0, gru_lm.SIZE, 3 + 40 * k).astype(np.int16).tobytes()) for k in (0, 0, 1, 2, 2, 4)]
    flat = gru_lm.Network.fresh(tiny_vocabulary().mass).flat
    rows = spark.createDataFrame(texts, "learner int, ids binary").coalesce(1).sortWithinPartitions("learner")
    got = gru_lm._averaged(rows.mapInArrow(gru_lm._networks(flat, 0.01), gru_lm.NETWORKS), flat)
    total, tokens = 0, 0
    for k in (0, 1, 2, 4):
        learner = gru_lm.Learner(gru_lm.Network(flat.copy()), 0.01)
        learner.learn([np.frombuffer(b, np.int16) for i, b in texts if i == k])
        total, tokens = total + learner.net.flat.astype(float) * learner.tokens, tokens + learner.tokens
    assert tokens == sum(len(b) // 2 for _, b in texts)
    assert got == pytest.approx(total / tokens, rel=1e-5, abs=1e-6)


def test_lm_first_texts_go_by_tokens():
    texts = [np.zeros(n, np.int16).tobytes() for n in (4, 5, 1, 90)]
    assert list(gru_lm._first(texts, 10)) == texts[:3] and list(gru_lm._first(texts, 9)) == texts[:2]
    assert gru_lm.WARM_TOKENS == 500_000 and gru_lm.LEARNER_TOKENS < gru_lm.CHUNK


def test_lm_memory_goes_by_tokens():
    """A long text beside 255 short ones: dense lanes would be 92 MB and more."""
    docs = [np.full(40_000, 3, np.int16), *[np.full(2, 5, np.int16)] * 255]
    net = gru_lm.Network.fresh(tiny_vocabulary().mass)
    tracemalloc.start()
    try:
        scores = gru_lm.log_probabilities(net, docs)
        gru_lm.Learner(net, 0.0).learn(docs)
        assert tracemalloc.get_traced_memory()[1] < 30e6
    finally:
        tracemalloc.stop()
    assert np.isfinite(scores).all() and np.ptp(scores[1:]) < 1e-4


def test_lm_odd_rows(odd, none):
    rows = gru_lm.lm_scores(odd, id_remainder(5) != 1).collect()
    assert len(rows) == 11 and all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (2, 3, 4))
    assert len({(r["score"], r["base_score"]) for r in rows if r["doc_id"] == 1}) == 1
    assert all(np.isfinite(r["score"]) for r in rows)
    unlearned = gru_lm.lm_scores(odd, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in unlearned)
    assert all(r["base_score"] == pytest.approx(0.0) for r in unlearned)
    assert gru_lm.lm_scores(none, F.lit(True)).count() == 0


def test_lm_rare_words_meet_their_counts(spark, monkeypatch):
    """With (almost) no broadcast word all counts come through the join."""
    docs = spark.createDataFrame([(i, f"common common rare{i} rare{i % 3}") for i in range(12)] + [(3, "common common rare3 rare0")],
                                 "doc_id long, text string")
    want = sorted((r["doc_id"], r["n_known"], round(r["base_score"], 9)) for r in gru_lm.lm_scores(docs, F.col("doc_id") < 9).collect())
    monkeypatch.setattr(gru_lm, "FREQUENT", 2)
    got = sorted((r["doc_id"], r["n_known"], round(r["base_score"], 9)) for r in gru_lm.lm_scores(docs, F.col("doc_id") < 9).collect())
    assert got == want


# packing

def check_packing(rows: pd.DataFrame, capacity: int) -> int:
    for _, s in rows.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *s["length"].cumsum()[:-1]] and s["length"].sum() <= capacity
    return rows["sequence_id"].nunique()


def test_packing_round_trip(spark, sf_small):
    docs = {r[0]: r[1] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()}
    rows = REGISTRY["op10_packing"](spark, sf_small).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc_id, own in rows.sort_values("start").groupby("doc_id"):
        ids = np.array([*tok.encode(docs.pop(doc_id), add_special_tokens=False).ids, 0], "<u4")
        assert own["piece"].tolist() == list(range(len(own)))
        assert own["start"].tolist() == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() == len(ids)
        assert len(ids) > 2048 or len(own) == 1
        assert (own["length"].tolist()[1:]) == [2048] * (len(own) - 1)
        for s, n, crc in own[["start", "length", "ids_crc32"]].itertuples(index=False):
            assert zlib.crc32(ids[s:s + n].tobytes()) == crc
    assert not docs
    used = check_packing(rows, 2048)
    assert used <= packing.lower_bound(rows["length"].to_numpy()) * 1.01 + 1


def test_ids_are_the_plain_tokenizers():
    """The contract's call on an unchanged tokenizer, special tokens' strings included."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, encoder = Tokenizer.from_file(path), packing.Encoder(path, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for text in ("a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext", "plain text\n\n  é", ""):
        assert encoder.ids(text.encode()).tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_both_tokenizer_forms_agree():
    enc = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = ["", " ", "a  b\n\n c", "<|endoftext|> x", "ñandú über \U0001F600‍", "don't I'LL", "x" * 3000, " " * 3000, "\n" * 900 + "é",
             "１２３ ²³ ٣", "a b c", "\x00\x01"]
    for t in texts:
        want = enc.whole.encode(t, add_special_tokens=False).ids
        assert enc.ids(t.encode()).tolist() == want, t[:20]
        if len(t) < 300 and not any(s in t for s in enc.special):
            assert enc.fast.encode_ordinary(t) == want


def test_bounds_hold_and_best_fit_is_tight():
    rng = np.random.default_rng(6)
    for trial in range(40):
        lengths = rng.integers(1, 60, 14)
        bound, (_, _, used) = packing.lower_bound(lengths, 60), packing.best_fit(lengths, 60)
        best = exact_bins(sorted(lengths.tolist(), reverse=True), 60)
        assert bound <= best <= used
    assert packing.lower_bound(np.array([], np.int64)) == 0
    assert packing.lower_bound(np.array([1025] * 7)) == 7 and packing.lower_bound(np.array([700] * 5)) == 3


def exact_bins(lengths: list[int], capacity: int) -> int:
    best = [len(lengths)]

    def place(i: int, bins: list[int]) -> None:
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        tried = set()
        for k, b in enumerate(bins):
            if b >= lengths[i] and b not in tried:
                tried.add(b)
                bins[k] -= lengths[i]
                place(i + 1, bins)
                bins[k] += lengths[i]
        place(i + 1, [*bins, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_partitions_with_gaps_exchange(spark):
    rng = np.random.default_rng(8)
    sized = spark.createDataFrame([(int(n),) for n in rng.integers(300, 1100, 3000)], "length long")
    rows = packing.pack(sized, 2048, group_pieces=200, max_rounds=3).toPandas()
    assert len(rows) == 3000
    alone = packing.pack(sized, 2048, group_pieces=200, max_rounds=0).toPandas()
    assert check_packing(rows, 2048) <= check_packing(alone, 2048)


def test_packing_odd_rows(odd, none):
    rows = packing.packing(odd).toPandas()
    assert len(rows[rows["doc_id"] == 1]) == 2 and rows["doc_id"].isna().sum() == 2
    assert (rows[rows["doc_id"].isin([2, 3])]["length"] == 1).all()
    check_packing(rows, 2048)
    assert packing.packing(none).count() == 0
