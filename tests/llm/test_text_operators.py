"""Operators on single texts against brute force, and the odd cases of each."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from conftest_llm import texts_of
from tidemark.llm import license_scan, pii, quality_rules, secrets
from tidemark.llm.queries import REGISTRY

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def base_spans(text: str) -> dict:
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = {"email": [m.span() for m in EMAIL.finditer(text)],
           "ip": [m.span() for m in IP.finditer(text) if all(int((p.lstrip("0") or "0")[:4]) <= 255 for p in m[0].split("."))],
           "card": [m.span() for m in CARD.finditer(text)
                    if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
           "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]}
    return {k: v for k, v in out.items() if v}


def luhn(s: str) -> bool:
    double = [int(c) for c in s[-2::-2]]
    return (sum(int(c) for c in s[::-2]) + sum(2 * d if d < 5 else 2 * d - 9 for d in double)) % 10 == 0


TRICKY = [
    "a@b.c@d.ef x@y..z a.@b-.c. @x.y é@b.cd", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3 .1.2.3.4. 01.002.0.255",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 4111  1111", "+1 (800) 555-1234 +12 +1() +1.2.3.4.5.6.7.8.9 +4912345678901234567",
    "++1 234 567 890- a+b@c.de 4111111111111111.1.1.1", "x@y.z" * 5, "1-2 3-4 5-6 7-8 9-0 1-2 3-4 5-6",
    "0" * 5000 + ".1.2.00300 " + "0" * 5000 + "7.1.2.255 " + "1" * 5000 + ".1.2.3",
]


def test_pii_spans_match_the_patterns(spark, sf_small):
    rng = np.random.default_rng(3)
    noise = ["".join(rng.choice(list("0123456789 .-+()@ab%_é\n"), 300)) for _ in range(300)]
    for text in [*TRICKY, *noise, *texts_of(spark, sf_small)]:
        got = {k: v for k, v in pii.find_spans(text).items() if k in pii.BASE}
        assert got == base_spans(text), text[:200]


def test_pii_query_digest(spark, sf_small):
    want = {}
    for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect():
        spans = base_spans(r["text"] or "")
        flat = ",".join(f"{k}:{a}:{b}" for k in pii.BASE for a, b in spans.get(k, ()))
        want[r["doc_id"]] = (*(len(spans.get(k, ())) for k in pii.BASE), hashlib.sha256(flat.encode()).hexdigest())
    got = {r[0]: tuple(r[1:6]) for r in REGISTRY["op1_pii"](spark, sf_small).collect()}
    assert got == want


def test_pii_adds_validated_kinds():
    found = pii.find_spans("IBAN: GB82 WEST 1234 5698 7654 32, IBAN GB82 WEST 1234 5698 7654 33; ssn 123-45-6789, "
                           "ssn 000-12-3456; https://joe:pw@host.example/x https://host.example/ "
                           "lives at 12 Old Mill Road, not Road")
    assert [len(found.get(k, ())) for k in ("iban", "ssn", "login", "street")] == [1, 1, 1, 1]


def test_pii_odd_rows(odd, none):
    rows = pii.pii(odd).collect()
    assert len(rows) == 11 and all(r["n_email"] == 0 for r in rows)
    assert pii.mask(odd).columns == odd.columns and pii.mask(odd).where("text is null").count() == 1
    assert pii.pii(none).count() == 0


def brute_rules(text: str) -> tuple:
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)} if len(words) < 3000 else None
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup,
            len(hit) if hit is not None else None)


def test_quality_rules_counts(spark, sf_small):
    texts = [*texts_of(spark, sf_small), "a b c d e a b c d e f", "x\n\nx\nx \n x", "é ü a b c é ü a b c", "a " * 12, ""]
    for text in texts:
        words, _, *rest = quality_rules.text_rules(text.encode())
        want = brute_rules(text)
        assert (len(words), *rest[:3]) == want[:4]
        assert want[4] is None or rest[3] == want[4], text[:100]


def test_quality_rules_query(spark, sf_small):
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    rows = REGISTRY["op7_rules"](spark, sf_small).collect()
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    clean = [r for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert all(r["kept"] for r in clean)


def test_quality_rules_odd_rows(odd, none):
    rows = quality_rules.quality_rules(odd).collect()
    assert len(rows) == 11 and all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (2, 3, 4, 6))
    kept = quality_rules.keep_quality(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 1").count() == 2
    assert quality_rules.keep_quality(none).count() == 0


def brute_places(text: str) -> list:
    words = ALNUM.findall(ascii_lower(text))
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    return [(i, label) for i in range(len(words)) for p, label in phrases.items()
            if words[i:i + len(p.split())] == p.split()], len(words)


def test_license_places(spark, sf_small):
    for text in [*texts_of(spark, sf_small), "MIT License mit license", "cc by cc by-sa", "xmit license", "", "CC\nBY"]:
        places, n = brute_places(text)
        got_n, got, *_ = license_scan.scan(text.encode())
        assert (got_n, got) == (n, sorted(places)), text[:100]


@pytest.mark.parametrize("expression,must,every", [
    ("MIT OR Apache-2.0", set(), {"MIT", "Apache-2.0"}), ("MIT AND (GPL-2.0 OR ISC)", {"MIT"}, {"MIT", "GPL-2.0", "ISC"}),
    ("GPL-2.0 WITH Classpath-exception-2.0 OR MIT */", set(), {"GPL-2.0", "MIT"}), ("MIT AND ISC OR MIT", {"MIT"}, {"MIT", "ISC"}),
])
def test_license_expressions(expression, must, every):
    assert license_scan.evaluate(license_scan.to_postfix(expression)) == (must, every)


def brute_meaning(tree):
    """Alternatives of an expression tree as a list of sets of licences."""
    if isinstance(tree, str):
        return [{tree}]
    op, left, right = tree
    a, b = brute_meaning(left), brute_meaning(right)
    return a + b if op == "OR" else [x | y for x in a for y in b]


def test_license_meaning_against_every_alternative():
    rng = np.random.default_rng(4)
    ids = ["MIT", "GPL-2.0-only", "Apache-2.0", "ISC", "MPL-2.0"]

    def grow(depth):
        if depth == 0 or rng.random() < 0.3:
            return str(rng.choice(ids))
        return (str(rng.choice(["AND", "OR"])), grow(depth - 1), grow(depth - 1))

    def write(tree):
        return tree if isinstance(tree, str) else f"({write(tree[1])} {tree[0]} {write(tree[2])})"

    for _ in range(200):
        tree = grow(4)
        ways = brute_meaning(tree)
        got = license_scan.scan(f"# SPDX-License-Identifier: {write(tree)}".encode())
        must, every = set.intersection(*ways), set.union(*ways)
        assert got[2] == {license_scan.family(x) for x in every}
        assert got[4] == {license_scan.family(x) for x in must} and got[3] == (1.0 if must else 0.95)
        assert got[5] == len(ways)
        # the normalised expression means the same, and is its own normal form
        again = license_scan.to_postfix(got[6])
        assert license_scan.evaluate(again) == ({x.lower() for x in must}, {x.lower() for x in every})
        assert license_scan.meaning(again)[0] == got[6]


def test_license_choice_differs_from_conjunction(spark):
    texts = ["MIT OR GPL-2.0-only", "MIT AND GPL-2.0-only", "gpl-2.0-only or (mit)", "GPL-2.0 WITH Classpath-exception-2.0",
             "MIT OR ISC\nSPDX-License-Identifier: Apache-2.0", "MIT AND"]
    df = spark.createDataFrame([(k, f"SPDX-License-Identifier: {t}") for k, t in enumerate(texts)], "doc_id long, text string")
    rows = [r[-5:] for r in sorted(map(tuple, license_scan.license_scan(df).collect()))]
    assert rows == [("gpl,mit", 0.95, "", 2, "gpl-2.0-only OR mit"), ("gpl,mit", 1.0, "gpl,mit", 1, "gpl-2.0-only AND mit"),
                    ("gpl,mit", 0.95, "", 2, "gpl-2.0-only OR mit"),
                    ("gpl", 1.0, "gpl", 1, "gpl-2.0 WITH classpath-exception-2.0"),
                    ("apache,isc,mit", 1.0, "apache", 2, "(isc OR mit) AND apache-2.0"), ("", 0.0, "", 0, "")]


def test_license_tags_and_odd_rows(odd, none):
    n, base, own, score, *_ = license_scan.scan(b"// SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode")
    assert (base, own, score) == ([], {"mit", "apache"}, 0.95)
    assert all(license_scan.to_postfix(x) is None for x in ("", "OR MIT", "MIT AND", "(MIT", "()"))
    assert license_scan.license_scan(odd).where("labels = '' and score = 0").count() == 11
    assert license_scan.license_scan(none).count() == 0


def test_secrets_are_found_and_words_are_not(spark, sf_small):
    rows = {r["doc_id"]: r for r in REGISTRY["op4_secrets"](spark, sf_small).collect()}
    for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect():
        planted = re.findall(r"AKIA[A-Z0-9]{16}|password=[0-9a-f]{18}|token = \"[0-9a-f]{40}\"", r["text"])
        assert rows[r["doc_id"]]["n_secrets"] == len(planted), r["doc_id"]


def test_assigned_values_are_read_whole():
    for text, value in (('password = "ab,cD3(f9!xQ;77"', "ab,cD3(f9!xQ;77"), ("db_password: pa;ss9word2x", "pa;ss9word2x"),
                        ("passwd=Zx9(kL2m", "Zx9(kL2m"), ('"client_secret": "a1b2{c3}d4e5"', "a1b2{c3}d4e5"),
                        ('password = "abcdef12,cD3(f9!xQ"', "abcdef12,cD3(f9!xQ"), ("(token=abc12345xyz).", "abc12345xyz"),
                        ("f(secret='a\\'b12345c', x)", "a\\'b12345c"), ("password=Zx9(kL2m) and", "Zx9(kL2m)"),
                        ('pwd: "no end 12345', "no"), ("auth_token := q1w2e3r4;", "q1w2e3r4")):
        spans = [(a, b) for a, b, kind, _ in secrets.candidates(text) if kind == "assigned"]
        if len(value) < 6:
            assert spans == [], text
        else:
            assert [text[a:b] for a, b in spans] == [value], text
            assert secrets.find(text, frozenset(), None)[1][0][:2] == spans[0], text


def test_held_out_secrets(spark, sf_small):
    """Precision and recall on texts that the forest has not learned from: planted keys, and digests,
    commits and long words that are none."""
    rng = np.random.default_rng(12)
    hexed = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    key = lambda n: "".join(rng.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZ23456789"), n))
    rows = []
    for k, text in enumerate(texts_of(spark, sf_small)):
        text = text[:600]
        secret = [f"AKIA{key(16)}", f"password={hexed(18)}", f'token = "{hexed(40)}"', ""][k % 4]
        other = [f"sha256: {hexed(64)}", f"commit {hexed(40)}", "internationalisationwise", f"md5={hexed(32)}"][k // 4 % 4]
        rows.append((k, f"{text[:300]} {secret} {text[300:]} {other}", secret.split("=")[-1].strip(' "')))
    learn = spark.createDataFrame([r[:2] for r in rows if r[0] // 16 % 2], "doc_id long, text string")
    words = secrets.dictionary(learn)
    forest = secrets.fit(secrets.labelled_findings(learn, words))
    hit = wrong = missed = 0
    for _, text, value in (r for r in rows if not r[0] // 16 % 2):
        found = [text[a:b] for a, b, *_ in secrets.find(text, words, forest)[1]]
        hit += value in found if value else 0
        missed += value not in found if value else 0
        wrong += sum(f != value for f in found)
    print(f"held out: {hit} found, {missed} missed, {wrong} wrong")
    assert hit > 60 and hit >= 0.95 * (hit + missed) and hit >= 0.95 * (hit + wrong)


def test_secret_redaction_and_odd_rows(spark, odd, none):
    docs = spark.createDataFrame(
        [(1, f"my password={'a1b2c3d4e5f6a7b8' + str(i)} and the configuration word internationalisation {i}", 5)
         for i in range(30)] + [(2, "clean text", 10), (3, None, None)], "doc_id long, text string, n_chars long")
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    assert out.where("text like '%[SECRET]%' and n_chars = length(text)").count() == 30
    assert out.where("text = 'clean text' and n_chars = 10").count() == 1 and out.where("text is null").count() == 1
    assert secrets.redact(odd).columns == odd.columns and secrets.secret_scan(odd).count() == 11
    assert secrets.secret_scan(none).count() == 0


def test_forest_learns_from_given_findings():
    rng = np.random.default_rng(0)
    x = rng.random((400, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.7)).astype(float)
    forest = secrets.Forest(x[:300], y[:300])
    assert ((forest.score(x[300:]) > 0.5) == (y[300:] > 0.5)).mean() > 0.9
