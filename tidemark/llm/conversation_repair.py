"""Conversation structure repair by a streamed dynamic program.

A repaired conversation's roles are ``s?(ua)+`` (an optional system turn, then
user and assistant in turns) or nothing. Each row is kept (cost 0), reroled to
user or assistant (1) or deleted (2, required for blank and duplicate rows);
an empty user or assistant turn may be inserted anywhere (5); a truncated row
that stays adds 5. The cheapest edits win, among equals the audit string of
initials (D, I, K, R) that is least in ASCII.

Rows are repartitioned by conversation and sorted by turn; ``mapInPandas``
carries the program's state (four costs and their string order) across Arrow
batches. What has to wait for a conversation's end, one code a row for the
way back and the rows' texts, goes to a spool that spills to the task's own
temporary file, so a giant conversation takes disk of its task, not memory
(its audit string, one letter an edit, is a result and is held). Earlier copies
of a row are found before the stream by an aggregate on (conversation, role,
digest of the text), so no set of seen texts is held.

Defined cases: null role or text is one space; a null conversation is a
conversation; a null turn comes first; rows of one turn go by role, then by
the text's digest; an unknown or empty role has to be reroled or deleted; a
conversation whose ``copies`` are all 0 is reported with zeros; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import field, worker_cache

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPOOL_BYTES = 1 << 20  # a spool stays in memory up to this size
# White space of the faults: space and tab to carriage return (fixed values).
SPACE = " \t\n\x0b\x0c\r"

# States: what the repaired roles so far end with (0: nothing yet).
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_WANTS = {0: "u", 1: "u", 2: "a", 3: "u"}  # the role that an insert or a rerole has to give
_ROLE = {"u": "user", "a": "assistant"}
# No state's best future costs over 10 more than another's (two inserts at most, or a
# deleted system turn), so a state that far behind can't be part of a cheapest repair.
_BEHIND = 10


def _inserts(state: int, n: int) -> int:
    for _ in range(n):
        state = _NEXT[state, _WANTS[state]]
    return state


class Program:
    """The dynamic program over one row after another.

    A row's token is up to two inserts and the row's edit. ``best`` holds, for
    each state, the cost above the cheapest state and the rank of its string
    among the states'; as strings of the same number of tokens never extend one
    another, rank and token decide ties. Costs are bounded (see _BEHIND), so there
    are few such tables: steps are kept in ``steps`` and read back by number.
    """

    def __init__(self) -> None:
        self.tables: dict[tuple, int] = {}
        self.numbered: list[tuple] = []
        self.steps: dict[tuple, tuple] = {}
        self.backs: dict[tuple, int] = {}
        self.back: list[tuple] = []
        self.start = self._table(((0, 0), None, None, None))

    def _table(self, table: tuple) -> int:
        if table not in self.tables:
            self.tables[table] = len(self.numbered)
            self.numbered.append(table)
        return self.tables[table]

    def step(self, table: int, initial: str, must_go: bool, cut: bool) -> tuple[int, int, int]:
        """(next table, what the cheapest state's cost rose by, code of the way back)."""
        key = (table, initial, must_go, cut)
        if key not in self.steps:
            self.steps[key] = self._step(self.numbered[table], initial, must_go, cut)
        return self.steps[key]

    def _step(self, best: tuple, initial: str, must_go: bool, cut: bool) -> tuple[int, int, int]:
        found: dict[int, tuple] = {}
        for state, entry in enumerate(best):
            if entry is None:
                continue
            for n in range(3):
                at = _inserts(state, n)
                ways = [("D", at, DELETE)]
                if not must_go:
                    stays = TRUNCATED if cut else 0
                    if (at, initial) in _NEXT:
                        ways.append(("K", _NEXT[at, initial], KEEP + stays))
                    ways.append(("R", _NEXT[at, _WANTS[at]], REROLE + stays))
                for edit, to, cost in ways:
                    way = (entry[0] + n * INSERT + cost, entry[1], "I" * n + edit, state)
                    if to not in found or way < found[to]:
                        found[to] = way
        least = min(w[0] for w in found.values())
        live = sorted((w[1:3], s) for s, w in found.items() if w[0] - least <= _BEHIND)
        rank = {s: k for k, (_, s) in enumerate(live)}
        table = tuple((found[s][0] - least, rank[s]) if s in rank else None for s in range(4))
        back = tuple((found[s][3], found[s][2]) if s in rank else None for s in range(4))
        if back not in self.backs:
            self.backs[back] = len(self.back)
            self.back.append(back)
        return self._table(table), least, self.backs[back]

    def end(self, table: int) -> tuple[int, int, str]:
        """(state, cost above the cheapest, last inserts) of the best end."""
        ends = []
        for state, entry in enumerate(self.numbered[table]):
            if entry is not None:
                n = {0: 0, 1: 2, 2: 1, 3: 0}[state]
                ends.append((entry[0] + n * INSERT, entry[1], "I" * n, state))
        cost, _, tail, state = min(ends)
        return state, cost, tail


class Conversation:
    """State of the conversation that the stream is in."""

    def __init__(self, key, program: Program) -> None:
        self.key, self.program = key, program
        self.codes = tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)
        self.texts = tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.first = self.last = self.before = self.role = None
        self.table = program.start

    def add(self, known: bool, turn: int, role: str, text: str, blank: bool, closed: bool, seen: bool,
            digest: str) -> None:
        if known and (self.first is None or turn != self.last):
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        same = (known, turn, role, digest)
        seen = seen or same == self.before
        self.before = same
        duplicate, cut = not blank and seen, not (blank or seen or closed)
        initial = role[:1]
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        if self.rows and self.role + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.role, self.rows = initial, self.rows + 1
        kind = initial if initial in ("s", "u", "a") else ""
        self.table, rise, code = self.program.step(self.table, kind, blank or duplicate, cut)
        self.cost += rise
        self.codes.write(code.to_bytes(4, "little"))
        for value in (role, text):
            raw = value.encode()
            self.texts.write(len(raw).to_bytes(8, "little"))
            self.texts.write(raw)

    def close(self) -> str:
        """Ends the program; the audit string."""
        state, more, tail = self.program.end(self.table)
        self.cost += more
        back, parts, block = self.program.back, [tail], 1 << 16
        for start in range((self.rows - 1) // block * block, -1, -block) if self.rows else ():
            self.codes.seek(4 * start)
            for code in reversed(array("I", self.codes.read(4 * min(block, self.rows - start)))):
                state, token = back[code][state]
                parts.append(token)
        self.codes.close()
        return "".join(reversed(parts))

    def repaired(self, audit: str) -> Iterator[tuple[str, str, bytes, bytes]]:
        """(edit, audit letter's role state, role, text) of each row that stays or is inserted."""
        self.texts.seek(0)
        state = 0
        for edit in audit:
            if edit == "I":
                role, text = _ROLE[_WANTS[state]].encode(), b""
            else:
                role, text = (self.texts.read(int.from_bytes(self.texts.read(8), "little")) for _ in range(2))
                if edit == "D":
                    continue
                if edit == "R":
                    role = _ROLE[_WANTS[state]].encode()
            state = _NEXT[state, role[:1].decode()]
            yield edit, role, text
        self.texts.close()

    def drop(self) -> None:
        self.codes.close()
        self.texts.close()


_REPORT = [("conv", "string"), ("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"),
           ("illegal", "long"), ("cost", "long"), ("audit", "string"), ("repaired_sha256", "string")]
_ROWS = [("conv", "string"), ("place", "long"), ("edit", "string"), ("role", "string"), ("text", "string")]


def _report(c: Conversation) -> Iterator[tuple]:
    audit, whole = c.close(), hashlib.sha256()
    for k, (_, role, text) in enumerate(c.repaired(audit)):
        whole.update((b"\n" if k else b"") + role + b":")
        whole.update(text)
    gaps = 0 if c.first is None else c.last - c.first + 1 - c.turns
    yield (c.key, gaps, c.blank, c.duplicate, c.truncated, c.illegal, c.cost, audit, whole.hexdigest())


def _rows(c: Conversation) -> Iterator[tuple]:
    for k, (edit, role, text) in enumerate(c.repaired(c.close())):
        yield c.key, k, edit, role.decode(), text.decode()


_COLUMNS = ["conv_", "known_", "turn_", "role_", "text_", "copies_", "blank_", "closed_", "seen_", "digest_"]


def _streamed(emit: Callable, names: list[str], out_rows: int = 1000, out_bytes: int = 1 << 22) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        program = worker_cache("conversation-program", Program)
        now, out, held = None, [], 0
        try:
            for batch in batches:
                for conv, known, turn, role, text, copies, blank, closed, seen, digest in zip(
                        *(batch[c].tolist() for c in _COLUMNS)):
                    conv = conv if isinstance(conv, str) else None
                    if now is None or now.key != conv:
                        for row in emit(now) if now is not None else ():
                            out.append(row)
                            held += sum(len(v) for v in row if isinstance(v, str))
                            if len(out) >= out_rows or held >= out_bytes:
                                yield pd.DataFrame(out, columns=names)
                                out, held = [], 0
                        now = Conversation(conv, program)
                    for k in range(copies):
                        now.add(known, turn, role, text, blank, closed, seen or k > 0, digest)
            for row in emit(now) if now is not None else ():
                out.append(row)
                if len(out) >= out_rows:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)
        finally:
            if now is not None:
                now.drop()

    return run


def _prepared(df: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """Rows with the faults that need no order of a whole conversation, in the stream's partitions and order."""
    blankless = F.rtrim(F.col("text_"), F.lit(SPACE))
    rows = df.select(
        F.col(conv).cast("string").alias("conv_"), F.col(turn).isNotNull().alias("known_"),
        F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn_"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role_"), F.coalesce(F.col(text), F.lit(" ")).alias("text_"),
        (F.col(copies).cast("int") if copies else F.lit(1)).alias("copies_"))
    rows = rows.withColumns({"blank_": blankless == "", "closed_": F.substring(blankless, -1, 1).isin(".", "!", "?"),
                             "digest_": F.sha2("text_", 256)})
    # the earliest turn of each text said more than once; a null turn is the earliest
    same = ["conv_", "role_", "digest_"]
    early = rows.where("copies_ > 0 and not blank_").groupBy(*same).agg(
        F.count("*").alias("n_"), F.min(F.struct("known_", "turn_")).alias("early_")).where("n_ > 1")
    early = early.select(*(F.col(c).alias(f"e{c}") for c in same), "early_")
    rows = rows.join(early, F.col("conv_").eqNullSafe(F.col("econv_")) & (F.col("role_") == F.col("erole_"))
                     & (F.col("digest_") == F.col("edigest_")), "left")
    rows = rows.withColumn("seen_", F.coalesce(F.col("early_") < F.struct("known_", "turn_"), F.lit(False)))
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(*_COLUMNS).repartition(width, "conv_").sortWithinPartitions(
        "conv_", "known_", "turn_", "role_", "digest_")


def _repair(df: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None, emit: Callable,
            fields: list[tuple[str, str]]) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType([field(n, k) for n, k in fields])
    out = _prepared(df, conv, turn, role, text, copies).mapInPandas(_streamed(emit, [n for n, _ in fields]), schema)
    return out.select(F.col("conv").cast(df.schema[conv].dataType).alias(conv), *(n for n, _ in fields[1:]))


def repair_report(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  copies: str | None = None) -> DataFrame:
    """One row per conversation: gaps in its turns, faulty rows by first fault, illegal neighbours, and the
    cheapest repair's cost, audit string and digest. ``copies``: a column saying how often a row stands (0: only
    its conversation counts)."""
    return _repair(df, conv, turn, role, text, copies, _report, _REPORT)


def repaired_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  copies: str | None = None) -> DataFrame:
    """The repaired conversations: conversation, place (from 0), edit (K, R or I), role, text."""
    return _repair(df, conv, turn, role, text, copies, _rows, _ROWS)


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with the test damage: by crc32 of ``conv_id:turn`` mod 20 a row is dropped (``copies`` 0),
    emptied, stripped of its full stops, repeated (``copies`` 2) or given to the user."""
    one = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(one["conv_id"], F.lit(":"), one["turn"]).cast("binary")) % 20
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(one["role"]).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(one["text"], ".!?", "")).otherwise(one["text"]).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
