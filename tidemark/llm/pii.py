"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, plus signs, digits, URL
schemes and cues of identifiers and addresses. Around each anchor a
deterministic parser expands to the longest valid form and validates it.

Kinds: email, ip, card, phone (the base kinds), then the method's own:
login (a URL with user information), iban (after a cue, mod-97 valid),
ssn (after a cue), street (house number, capitalised words, street word).
Within a kind spans never overlap; the leftmost wins.

Defined results: a null or empty text has no span; offsets are code points,
the end is exclusive; repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, field, unused, worker_cache

KINDS = ("email", "ip", "card", "phone", "login", "iban", "ssn", "street")
BASE = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
_DIGITS = frozenset("0123456789")
_PHONE = frozenset(" ().0123456789-")
_USER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+:!~-")

# The cues of each parser.
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
IBAN_CUES = ("IBAN", "iban", "Iban", "account", "Account", "Konto", "compte", "cuenta")
SSN_CUES = ("SSN", "ssn", "social security", "Social Security", "Social security")
STREET_CUES = (" Street", " Avenue", " Road", " Lane", " Boulevard", " Drive")


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", ("@", 1))
    a.add_word("+", ("+", 1))
    for d in "0123456789":
        a.add_word(d, ("0", 1))
    for kind, cues in (("login", SCHEMES), ("iban", IBAN_CUES), ("ssn", SSN_CUES), ("street", STREET_CUES)):
        for cue in cues:
            a.add_word(cue, (kind, len(cue)))
    a.make_automaton()
    return a


def _run(text: str, at: int, chars: frozenset) -> int:
    """End of the run of ``chars`` that begins at ``at``."""
    n = len(text)
    while at < n and text[at] in chars:
        at += 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``, not before ``floor``."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    end = _run(text, at + 1, _LABEL)
    if end == at + 1:
        return None
    labels = 1
    while end + 1 < len(text) and text[end] == ".":
        nxt = _run(text, end + 1, _LABEL)
        if nxt == end + 1:
            break
        end, labels = nxt, labels + 1
    return (start, end) if labels > 1 else None


def _is_octet(digits: str) -> bool:
    """Whether a number of any length is at most 255."""
    value = digits.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def _dotted(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """Runs of digits joined by single dots from ``at``; the chain's end."""
    parts, end = [], at
    while True:
        stop = _run(text, end, _DIGITS)
        parts.append((end, stop))
        if stop + 1 < len(text) and text[stop] == "." and text[stop + 1] in _DIGITS:
            end = stop + 1
        else:
            return parts, stop


def _spaced(text: str, at: int) -> int:
    """End of the digits from ``at`` that at most one space or hyphen parts."""
    n = len(text)
    end = at + 1
    while end < n:
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    return end


def _phone(text: str, at: int) -> tuple[int, int] | None:
    """The form after the plus sign at ``at``: a digit, a body, a last digit."""
    if at + 1 >= len(text) or text[at + 1] not in _DIGITS:
        return None
    end = _run(text, at + 2, _PHONE)
    while end > at + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    return (at, end) if end > at + 3 else None


_IBAN = re.compile(r"[ :=#.]{0,4}(?:(?:no|nr|number|IBAN)[ :=#.]{0,3})?([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(r"[ :=#.]{0,4}(?:(?:no|number)[ :=#.]{0,3})?([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_HOUSE = re.compile(r"(?<![A-Za-z0-9])([0-9]{1,5} (?:[A-Z][a-z]+ ?){0,2}[A-Z][a-z]+)$")


def _iban(text: str, at: int) -> tuple[int, int] | None:
    m = _IBAN.match(text, at)
    if not m:
        return None
    v = m[1].replace(" ", "")
    number = int("".join(str(int(c, 36)) for c in v[4:] + v[:4]))
    return m.span(1) if number % 97 == 1 and len(v) <= 34 else None


def _ssn(text: str, at: int) -> tuple[int, int] | None:
    m = _SSN.match(text, at)
    if not m:
        return None
    area, group, serial = m[1].split("-")
    ok = area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"
    return m.span(1) if ok else None


def _login(text: str, start: int, at: int) -> tuple[int, int] | None:
    """scheme://user[:password]@host"""
    end = _run(text, at, _USER)
    if end == at or end >= len(text) or text[end] != "@":
        return None
    host = end + 1
    stop = _run(text, host, _LABEL | {"."})
    return (start, stop) if stop > host else None


def _street(text: str, start: int, end: int) -> tuple[int, int] | None:
    if end < len(text) and text[end].isalpha():
        return None
    m = _HOUSE.search(text, max(0, start - 60), start)
    return (m.start(1), end) if m else None


def find_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of every kind, in order of their starts."""
    automaton = worker_cache("pii", _automaton)
    out: dict[str, list[tuple[int, int]]] = {}
    email_end = dots_end = card_end = 0
    own_end = dict.fromkeys(KINDS, 0)
    for last, (cue, size) in automaton.iter(text):
        start = last + 1 - size
        if cue == "0":
            # the chain of a digit is parsed once, from its first digit
            if start >= dots_end:
                parts, dots_end = _dotted(text, start)
                for i in range(0, len(parts) - 3, 4):
                    quad = parts[i:i + 4]
                    if all(_is_octet(text[a:b]) for a, b in quad):
                        out.setdefault("ip", []).append((quad[0][0], quad[3][1]))
            if start >= card_end:
                card_end = _spaced(text, start)
                if card_end - start >= 13:
                    digits = text[start:card_end].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        out.setdefault("card", []).append((start, card_end))
            continue
        if cue == "@":
            span, kind = _email(text, start, email_end), "email"
            if span:
                email_end = span[1]
        elif cue == "+":
            span, kind = _phone(text, start), "phone"
            if span and not 9 <= sum(c in _DIGITS for c in text[span[0]:span[1]]) <= 15:
                span = None
        else:
            kind = cue
            span = {"login": lambda: _login(text, start, last + 1), "iban": lambda: _iban(text, last + 1),
                    "ssn": lambda: _ssn(text, last + 1), "street": lambda: _street(text, start, last + 1)}[cue]()
            if span and span[0] < own_end[kind]:
                span = None
        if span:
            own_end[kind] = span[1]
            out.setdefault(kind, []).append(span)
    return out


def _joined(spans: dict, kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans.get(k, ()))


_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _compute(texts: list[bytes]) -> list[list]:
    out: list[list] = [[] for _ in range(6)]
    for b in texts:
        spans = find_spans(b.decode("utf-8", "replace"))
        for i, k in enumerate(BASE):
            out[i].append(len(spans.get(k, ())))
        out[4].append(hashlib.sha256(_joined(spans, BASE).encode()).hexdigest() if spans else _EMPTY_SHA)
        out[5].append(_joined(spans, KINDS) if spans else "")
    return out


def pii(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, digest and all spans."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    fields = [*(field(f"n_{k}", "long") for k in BASE), field("base_sha256", "string"), field("spans", "string")]
    return add_columns(src, "text", fields, _compute, drop=("text",))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping
    spans of several kinds become one, named after the first. Null stays null."""

    def masked(value: str) -> str:
        spans = sorted((a, b, k) for k, v in find_spans(value).items() for a, b in v)
        parts, at = [], 0
        for a, b, k in spans:
            if a >= at:
                parts += [value[at:a], f"[{k.upper()}]"]
            at = max(at, b)
        return "".join([*parts, value[at:]])

    name = unused(docs, "masked")
    new = add_columns(docs, text, [field(name, "string")],
                      lambda texts: [[masked(b.decode("utf-8", "replace")) for b in texts]])
    cols = [F.when(F.col(text).isNotNull(), F.col(name)).alias(text) if c == text else F.col(c) for c in docs.columns]
    return new.select(cols)
