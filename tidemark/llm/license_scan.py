"""Licence scan: Aho-Corasick over words and tags, expressions by shunting-yard.

The automaton runs over the text's normalised words (joined by one space, so
a phrase is found only as whole consecutive words) and finds the base phrases
and the method's notice phrases. Identifier tags are found the same way and
the expression that follows in the original text is parsed: a shunting-yard
parser orders AND, OR, WITH and parentheses and evaluates the expression.

An expression says which licences hold whichever alternative is taken
(``required``), how many alternatives there are (``choices``, products of AND and sums of
OR; several tags of a text all hold) and reads, normalised, as ``expression``.

Score: 1.0 with a tag expression that requires a licence, 0.95 with one that only
offers a choice, 0.9 with a base phrase, 0.7 with one
of the method's notice phrases only, 0.0 otherwise. Defined results: a null or
empty text has no word and no label; an expression that does not parse adds
no label, requires nothing and offers no choice; repeated rows get equal results.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ALNUM_TABLE, add_columns, field, worker_cache

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notice phrases of other licences, as normalised words.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx license identifier",)
# Families of licence identifiers, by their lower-case beginning.
FAMILIES = (
    ("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("apache", "apache"), ("mit", "mit"), ("mpl", "mpl"),
    ("epl", "epl"), ("bsd", "bsd"), ("isc", "isc"), ("bsl", "bsl"), ("cc0", "cc0"), ("cc-by", "cc-by"),
    ("unlicense", "unlicense"),
)
_RANK = {"or": 1, "and": 2, "with": 3}
_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.I)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+-]+")


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE_PHRASES), ("notice", NOTICE_PHRASES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in phrases.items():
            a.add_word(f" {phrase} ", (kind, label, len(phrase) + 2))
    a.make_automaton()
    return a


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard: operands and operators in evaluation order, or None if
    the expression's beginning is not a licence expression. Reading ends
    where the expression does, so a comment's end may follow it."""
    out: list[str] = []
    held: list[str] = []
    operand = True  # an operand is due
    depth = 0
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if token == "(":
            if not operand:
                break
            held.append(token)
            depth += 1
        elif token == ")":
            if operand or not depth:
                break
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
            depth -= 1
        elif low in _RANK:
            if operand:
                return None
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[low]:
                out.append(held.pop())
            held.append(low)
            operand = True
        else:
            if not operand:
                break
            out.append(token)
            operand = False
    if operand or depth:
        return None
    return out + held[::-1]


def evaluate(postfix: list[str]) -> tuple[frozenset[str], frozenset[str]]:
    """The licences of an expression: those that hold whichever alternative
    is taken, and all of them. WITH keeps its licence (the exception only
    widens it)."""
    stack: list[tuple[frozenset[str], frozenset[str]]] = []
    for token in postfix:
        if token not in _RANK:
            one = frozenset([token])
            stack.append((one, one))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "or":
            stack.append((left[0] & right[0], left[1] | right[1]))
        elif token == "and":
            stack.append((left[0] | right[0], left[1] | right[1]))
        else:
            stack.append(left)
    return stack[0]


class _Part:
    """A subexpression: its operator, the readings of its distinct operands, and how many alternatives it has."""

    def __init__(self, reading: str) -> None:
        self.op, self.readings, self.ways = "", {reading}, 1

    def read(self, outer: str) -> str:
        text = f" {self.op.upper()} ".join(sorted(self.readings))
        return f"({text})" if self.op == "or" and outer == "and" and len(self.readings) > 1 else text

    def join(self, op: str, other: _Part) -> None:
        readings: set[str] = set()
        for part in (self, other):
            readings |= part.readings if part.op in ("", op) else {part.read(op)}
        self.ways = self.ways * other.ways if op == "and" else self.ways + other.ways
        self.op, self.readings = op if len(readings) > 1 else "", readings


def meaning(postfix: list[str]) -> tuple[str, int]:
    """The expression normalised (operands sorted, repeated ones once, no
    needless parentheses) and its number of alternatives."""
    stack: list[_Part] = []
    for token in postfix:
        if token not in _RANK:
            stack.append(_Part(token.lower()))
            continue
        right = stack.pop()
        if token == "with":
            left = stack[-1]
            left.readings = {f"{left.read('and')} WITH {right.read('and')}"}
            left.op = ""
        else:
            stack[-1].join(token, right)
    return stack[0].read(""), stack[0].ways


def family(identifier: str) -> str:
    low = identifier.lower()
    return next((label for start, label in FAMILIES if low.startswith(start)), low)


def scan(text: bytes) -> tuple[int, list[tuple[int, str]], set[str], float, set[str], int, str]:
    """n_words, base places (word index, label), the method's labels, score; of the tags: the labels
    required, the number of alternatives and the normalised expression."""
    automaton = worker_cache("license", _automaton)
    words = text.translate(ALNUM_TABLE).split()
    flat = (b" " + b" ".join(words) + b" ").decode("utf-8", "replace")
    base: list[tuple[int, str]] = []
    own: set[str] = set()
    tagged = False
    at = index = 0  # spaces before `at`: the index of the word that starts after it
    for last, (kind, label, size) in automaton.iter(flat):
        if kind == "tag":
            tagged = True
        elif kind == "notice":
            own.add(label)
        else:
            start = last + 1 - size
            if start >= at:
                index += flat.count(" ", at, start)
            else:
                index -= flat.count(" ", start, at)
            at = start
            base.append((index, label))
    score = 0.9 if base else 0.7 if own else 0.0
    required: set[str] = set()
    whole: _Part | None = None
    if tagged:
        for m in _TAG.finditer(text.decode("utf-8", "replace")):
            postfix = to_postfix(m[1])
            if postfix:
                must, named = evaluate(postfix)
                own |= {family(x) for x in named}
                required |= {family(x) for x in must}
                reading, ways = meaning(postfix)
                part = _Part(reading if " OR " not in reading or reading[0] == "(" else f"({reading})")
                part.ways = ways
                if whole is None:
                    whole, single = part, reading
                elif part.readings != whole.readings:
                    whole.join("and", part)
        if whole is not None:
            score = 1.0 if required else 0.95
    expression = "" if whole is None else single if len(whole.readings) == 1 else whole.read("")
    return len(words), sorted(base), own, score, required, whole.ways if whole else 0, expression


def _compute(texts: list[bytes]) -> list[list]:
    out: list[list] = [[] for _ in range(10)]
    for b in texts:
        n, base, own, score, required, choices, expression = scan(b)
        labels = {label for _, label in base}
        for col, v in zip(out, (n, len(base), base[0][0] if base else None, base[-1][0] if base else None,
                                ",".join(sorted(labels)), ",".join(sorted(labels | own)), score,
                                ",".join(sorted(required)), min(choices, 2**63 - 1), expression), strict=True):
            col.append(v)
    return out


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, base places and labels, all labels, score; required labels, choices, expression."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    fields = [*(field(n, "long") for n in ("n_words", "n_base", "first_word", "last_word")),
              field("base_labels", "string"), field("labels", "string"), field("score", "double"),
              field("required", "string"), field("choices", "long"), field("expression", "string")]
    return add_columns(src, "text", fields, _compute, drop=("text",))
