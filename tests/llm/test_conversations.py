"""Conversation repair against exhaustive search and a plain damage, sort and count."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_repair as cr

SHAPE = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_cheapest(rows):
    """(cost, audit) of the cheapest repair by a shortest-path search over (rows done, roles so far); ``rows`` are
    (initial, must go, truncated). Roles so far are kept as their last letter, checked with SHAPE."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        tail = roles if len(roles) < 2 else ("S" if roles[0] == "s" else "") + roles[-1]
        if i == len(rows) and SHAPE.fullmatch(roles):
            return cost, audit
        if (i, tail) in done:
            continue
        done.add((i, tail))

        def go(edit, add, letter, step, cost=cost, audit=audit, i=i, roles=roles):
            new = roles + letter
            if letter and not any(SHAPE.fullmatch(new + end) for end in ("", "a", "ua")):
                return
            if len(new) > 4:  # only the start and the end of the roles matter
                new = new[:1] + new[-3:] if new[0] == "s" and new[-3] == "u" else new[:2] + new[-2:] \
                    if new[0] != "s" and new[-2] == "u" else new
            heapq.heappush(heap, (cost + add, audit + edit, i + step, new))

        for letter in "ua":
            go("I", 5, letter, 0)
        if i < len(rows):
            initial, must_go, cut = rows[i]
            go("D", 2, "", 1)
            if not must_go:
                if initial in "sua" and initial:
                    go("K", 5 * cut, initial, 1)
                for letter in "ua":
                    go("R", 1 + 5 * cut, letter, 1)
    return None


def by_program(rows):
    p = cr.Program()
    table, cost, codes = p.start, 0, []
    for initial, must_go, cut in rows:
        table, rise, code = p.step(table, initial, must_go, cut)
        cost, codes = cost + rise, [*codes, code]
    state, more, tail = p.end(table)
    audit = [tail]
    for code in reversed(codes):
        state, token = p.back[code][state]
        audit.append(token)
    return cost + more, "".join(reversed(audit))


def every_repair(rows):
    """All edits of a short conversation, without any program."""
    best = None

    def walk(i, roles, audit, cost, inserted):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(rows) and SHAPE.fullmatch(roles) and (best is None or (cost, audit) < best):
            best = cost, audit
        if inserted < 3:
            for letter in "ua":
                walk(i, roles + letter, audit + "I", cost + 5, inserted + 1)
        if i < len(rows):
            initial, must_go, cut = rows[i]
            walk(i + 1, roles, audit + "D", cost + 2, inserted)
            if not must_go:
                if initial:
                    walk(i + 1, roles + initial, audit + "K", cost + 5 * cut, inserted)
                for letter in "ua":
                    walk(i + 1, roles + letter, audit + "R", cost + 1 + 5 * cut, inserted)

    walk(0, "", "", 0, 0)
    return best


def some_rows(rnd, n):
    out = []
    for _ in range(n):
        must = rnd.random() < 0.2
        out.append((rnd.choice(["s", "u", "u", "a", "a", ""]), must, not must and rnd.random() < 0.3))
    return out


def test_program_against_every_repair():
    rnd = random.Random(1)
    for _ in range(400):
        rows = some_rows(rnd, rnd.randrange(5))
        assert by_program(rows) == every_repair(rows), rows


def test_program_against_search_on_longer_ones():
    rnd = random.Random(2)
    for _ in range(400):
        rows = some_rows(rnd, rnd.randrange(6, 14))
        assert by_program(rows) == plain_cheapest(rows), rows
    long = some_rows(rnd, 20_000)
    assert len(by_program(long)[1].replace("I", "")) == 20_000


def plain_report(rows):
    """The contract, a conversation at a time."""
    space, out = " \t\n\x0b\x0c\r", []
    for conv in {r[0] for r in rows}:
        after = []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            after += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in after:
            end = text.rstrip(space)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else
                          "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        first = [r[1][:1] for r in after]
        cost, audit = plain_cheapest([(i if i in ("s", "u", "a") else "", f in ("blank", "duplicate"), f == "truncated")
                                      for i, f in zip(first, faults)])
        turns = {r[0] for r in after if r[0] is not None}
        texts, state, left = [], "", list(after)
        for edit in audit:
            role, text = ("", "") if edit == "I" else left.pop(0)[1:]
            if edit == "D":
                continue
            if edit in "IR":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            texts.append(f"{role}:{text}")
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
                    hashlib.sha256("\n".join(texts).encode()).hexdigest()))
    return sorted(out, key=str)


def report(df):
    return sorted((tuple(r) for r in cr.repair_report(cr.damaged(df), copies="copies").collect()), key=str)


def test_report_against_plain(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/conversations.parquet")
    assert report(df) == plain_report([tuple(r) for r in df.collect()])


@pytest.fixture(scope="module")
def strange(spark):
    rnd = random.Random(4)
    texts = ["Yes.", "No!", "and so", "", " \n", None, "ünï?", "Yes. ", "a" * 200_000 + "."]
    rows = [(rnd.choice([1, 2, 3, 4, 5, 6, None]), rnd.choice([None, *range(-1, 9), 10**16 + 1]),
             rnd.choice(["system", "user", "user", "assistant", "tool", "", None, "assistant"]), rnd.choice(texts))
            for _ in range(90)]
    rows += [(50 + k, 0, "user", "Hi.") for k in range(60)] + rows[:10]  # some lose their only row; repeated rows
    return spark.createDataFrame(rows, SCHEMA)


def test_strange_rows(spark, strange):
    extra = strange.withColumns({c: F.lit("x") for c in ("copies_", "early_", "conv", "place", "edit", "seen_")})
    got = report(extra)
    assert got == plain_report([tuple(r) for r in strange.collect()])
    assert any(r[7] == "" for r in got) and report(strange.limit(0)) == []


def test_small_batches_and_spool(spark, strange, monkeypatch):
    want = report(strange)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    monkeypatch.setattr(cr, "SPOOL_BYTES", 10)
    try:
        assert report(strange) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_giant_conversation(spark):
    n = 30_000
    df = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                               F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                               F.concat(F.lit("Line "), "id", F.lit(".")).alias("text"))
    r = cr.repair_report(df).collect()[0]
    assert (r["cost"], r["audit"], r["illegal"]) == (0, "K" * n, 0)


def test_repaired_rows_are_the_digests_texts(spark, strange):
    rows = cr.repaired_rows(cr.damaged(strange), copies="copies").collect()
    by = {}
    for r in sorted(rows, key=lambda r: (str(r["conv_id"]), r["place"])):
        by.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in report(strange):
        assert hashlib.sha256("\n".join(by.get(r[0], [])).encode()).hexdigest() == r[8]
