"""Repair of the turn structure of conversations by weighted interval parsing.

The grammar of repairs has a symbol X[p,q] for each pair of states: a span of rows that leads a conversation from
state p to state q, after its edits. Its rules are in Chomsky normal form, X[p,r] -> X[p,q] X[q,r] and
X[p,q] -> row, and insertions (symbols over an empty span) are closed over beforehand. A cell holds the least
(cost, audit) of its symbol; the audit is the string of the edits' initials.

Every split of a span gives a symbol the same least cell: X[p,q] passes some state at each place. And of two audits
of one span and cost none begins the other (it would need more insertions), so the lesser one stays the lesser
whatever is put before or after it. Hence one split of each span is enough, and spans are combined bottom-up by doubling
length: first inside pieces of bounded size, then piece by piece, wherever the pieces of a long conversation lie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a piece; a bound on memory and on the size of a record.
PIECE = 1024
KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 3, 4, 3, 3
#: States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = range(4)
#: What may come next, by the initial of its role: a system row first, users and assistants in turn.
_NEXT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
_BLANKS = " \t\n\x0b\x0c\r"

Cell = tuple[int, str]
Cells = dict[tuple[int, int], Cell]


def combine(left: Cells, right: Cells) -> Cells:
    """Cells of two neighbouring spans as one."""
    out: Cells = {}
    for (p, q), (cost, audit) in left.items():
        for r in _STATES:
            other = right.get((q, r))
            if other is not None:
                cell = (cost + other[0], audit + other[1])
                if (p, r) not in out or cell < out[p, r]:
                    out[p, r] = cell
    return out


def insertions() -> Cells:
    """Closure of the insertions: the cells of an empty span."""
    cells: Cells = {(p, p): (0, "") for p in _STATES}
    step = {(p, q): (INSERT, "I") for initial in "ua" for p, q in _NEXT[initial].items()}
    while True:
        more = combine(cells, {**{(p, p): (0, "") for p in _STATES}, **step})
        if more == cells:
            return cells
        cells = more


_EMPTY = insertions()


@lru_cache(maxsize=None)
def row_cells(initial: str, must_go: bool, broken: bool) -> tuple[tuple[tuple[int, int], Cell], ...]:
    """Cells of one row: an edit with insertions before and after it. ``initial`` is s, u, a or empty for others."""
    edits: Cells = {(p, p): (DELETE, "D") for p in _STATES}
    if not must_go:
        extra = BROKEN if broken else 0
        for role in "ua":
            for p, q in _NEXT[role].items():
                edits[p, q] = min(edits.get((p, q), (REROLE + extra, "R")), (REROLE + extra, "R"))
        for p, q in _NEXT.get(initial, {}).items():
            edits[p, q] = min(edits.get((p, q), (KEEP + extra, "K")), (KEEP + extra, "K"))
    return tuple(combine(combine(_EMPTY, edits), _EMPTY).items())


def parse(spans: list[Cells]) -> Cells:
    """Cells of neighbouring spans as one, bottom-up: each round joins neighbours, so spans double."""
    spans = list(spans) or [_EMPTY]
    while len(spans) > 1:
        spans = [combine(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def best(cells: Cells) -> Cell:
    """The cheapest edits that leave nothing, or whole turns of user and assistant."""
    return min(cells[START, q] for q in (START, ASSISTANT) if (START, q) in cells)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn``, remainder by 20.

    0 drops a row (``copies`` 0), 1 empties its text, 2 removes full stops, exclamation and question marks, 3 repeats it
    (``copies`` 2), 4 makes it the user's. Nulls count as one space, in the key too; ``turn`` stays null.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(key.cast("binary")) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


_CELL = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_PIECES = pa.schema(
    [
        ("conv_id", pa.int64()), ("piece", pa.int64()), ("cells", pa.list_(_CELL)),
        ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ]
)
_PIECES_SQL = (
    "conv_id long, piece long, cells array<struct<p: int, q: int, cost: long, audit: string>>, blank long, duplicate long, truncated long"
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of runs of at most ``PIECE`` rows of a conversation; rows come in order."""
    first = TaskContext.get().partitionId() << 40
    done: list[tuple] = []
    conv, spans, counts, n, open_ = None, [], [0, 0, 0], 0, False

    def close() -> None:
        nonlocal spans, counts, n
        cells = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in parse(spans).items()]
        done.append((conv, first + n, cells, *counts))
        spans, counts, n = [], [0, 0, 0], n + 1

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "initial", "blank", "again", "broken", "copies"))
        for own, initial, blank, again, broken, copies in zip(*columns):
            if open_ and own != conv:
                close()
            conv, open_ = own, True
            for copy in range(copies):
                repeated = not blank and (again or copy > 0)
                counts[0] += blank
                counts[1] += repeated
                counts[2] += broken and not blank and not repeated
                spans.append(dict(row_cells(initial if initial in ("s", "u", "a") else "", blank or repeated, broken and not repeated)))
                if len(spans) >= PIECE:
                    close()
        if done:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done), _PIECES)], schema=_PIECES)
            done = []
    if open_:
        close()
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done), _PIECES)], schema=_PIECES)


class _Conversation:
    """One conversation as its pieces, then its rows, come in order; holds its cells and audit, never its texts."""

    def __init__(self, conv_id):
        self.conv_id, self.pieces, self.counts = conv_id, [], [0, 0, 0]
        self.audit = None
        self.at, self.state, self.places = 0, START, 0
        self.digest = hashlib.sha256()
        self.turns, self.lowest, self.turn, self.initial, self.illegal = 0, None, None, None, 0

    def piece(self, row: dict) -> None:
        self.pieces.append({(c["p"], c["q"]): (c["cost"], c["audit"]) for c in row["cells"]})
        self.counts = [a + row[c] for a, c in zip(self.counts, ("blank", "duplicate", "truncated"))]

    def settle(self) -> None:
        self.cost, self.audit = best(parse(self.pieces))
        self.pieces = []

    def _put(self, edit: str, role: str, text: str) -> tuple:
        if edit != "K":
            role = "assistant" if self.state == USER else "user"
        self.state = _NEXT[role[0]][self.state]
        self.digest.update((("\n" if self.places else "") + f"{role}:{text}").encode())
        self.places += 1
        return (self.conv_id, self.places - 1, edit, role, text)

    def _inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._put("I", "", "")

    def row(self, turn, role: str, text: str, copies: int) -> Iterator[tuple]:
        if copies and turn is not None and (self.lowest is None or turn != self.turn):
            self.lowest = turn if self.lowest is None else self.lowest
            self.turn, self.turns = turn, self.turns + 1
        for _ in range(copies):
            if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = role[:1]
            yield from self._inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                yield self._put(edit, role, text)

    def end(self) -> Iterator[tuple]:
        yield from self._inserted()

    def summary(self) -> tuple:
        gaps = 0 if self.lowest is None else min(self.turn - self.lowest + 1 - self.turns, (1 << 63) - 1)
        return (self.conv_id, gaps, *self.counts, self.illegal, self.cost, self.audit, self.digest.hexdigest())


_SUMMARY = pa.schema(
    [
        ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
        ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ]
)
_SUMMARY_SQL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROWS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_ROWS_SQL = "conv_id long, place long, edit string, role string, text string"


def _repaired(batches: Iterator[pa.RecordBatch], rows: bool) -> Iterator[pa.RecordBatch]:
    schema = _ROWS if rows else _SUMMARY
    out: list[tuple] = []
    size = 0
    current: _Conversation | None = None

    def flush() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def finished() -> None:
        ended = list(current.end())
        out.extend(ended if rows else [current.summary()])

    for batch in batches:
        for row in batch.to_pylist():
            if current is None or current.conv_id != row["conv_id"]:
                if current is not None:
                    finished()
                current = _Conversation(row["conv_id"])
            if row["cells"] is not None:
                current.piece(row)
                continue
            if current.audit is None:
                current.settle()
            for put in current.row(row["turn"], row["role"], row["text"], row["copies"]):
                if rows:
                    out.append(put)
                    size += len(put[4])
            if size > 1 << 22 or len(out) > 1 << 14:
                yield flush()
                out.clear()
                size = 0
    if current is not None:
        finished()
    if out:
        yield flush()


def _parts(conversations: DataFrame) -> DataFrame:
    """Pieces and rows of each conversation in order, pieces first, each conversation in one partition."""
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    rows = conversations.select("conv_id", "turn", "role", "text", "copies", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    marks = (
        rows.select(
            "conv_id", turn.alias("turn"), "role", "digest", "copies",
            (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("broken"),
        )
        .groupBy("conv_id", "turn", "role", "digest", "blank", "broken")
        .agg(F.sum("copies").alias("copies"))
    )
    seen = (
        marks.where("copies > 0")
        .groupBy("conv_id", "role", "digest")
        .agg(F.min("turn").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    again: Column = F.coalesce(F.col("turn") > F.col("first"), F.lit(False))
    flagged = marks.join(seen, same, "left").select(
        "conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "blank", again.alias("again"), "broken", "copies"
    )
    order = ("conv_id", "turn", "role", "digest")
    pieces = flagged.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, _PIECES_SQL)
    none = F.lit(None)
    parts = pieces.withColumns({c: none.cast(t) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("copies", "long"), ("digest", "binary"))})
    texts = rows.withColumns({c: none.cast(pieces.schema[c].dataType) for c in ("piece", "cells", "blank", "duplicate", "truncated")})
    both = parts.unionByName(texts)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("cells").isNull(), "piece", "turn", "role", "digest")


def _with_copies(conversations: DataFrame) -> DataFrame:
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("text", "role"))
    copies = F.col("copies").cast("long") if "copies" in conversations.columns else F.lit(1).cast("long").alias("copies")
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text, copies)


def repairs(conversations: DataFrame) -> DataFrame:
    """One row for each conversation: its faults, the cheapest edits and the digest of what they leave.

    Rows are ``conv_id``, ``turn``, ``role``, ``text`` and, where it is there, ``copies`` (how often a row comes, 0 for a
    dropped one); other columns are not read. They are taken by turn, nulls first, and within a turn by role and by the
    SHA-256 of the text. Each row's first fault counts: ``blank``, ``duplicate`` (role and text came before in the
    conversation), ``truncated`` (the last character that is not blank is no full stop, exclamation or question mark).

    Edits: keep a row (0), give it the role user or assistant (3), delete it (4; blank and duplicate rows must go),
    insert an empty row of user or assistant (3); a truncated row that stays costs 3 more. What is left begins with at
    most one system row and goes on in turns of user and assistant, or is empty. ``audit`` has the edits' initials; of equal
    costs the least string. Roles go by their first letter; others than s, u and a cannot be kept.

    Null roles and texts count as one space, a null ``conv_id`` is a conversation of its own, and one without rows (all
    dropped) has no faults and an empty audit. An empty table gives no rows. Conversations of any length are parsed in
    pieces wherever they lie; the last step streams a conversation's rows through one task, as one digest covers
    them all, and holds its audit but not its texts.
    """
    return _parts(_with_copies(conversations)).mapInArrow(lambda batches: _repaired(batches, rows=False), _SUMMARY_SQL)


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """The rows that ``repairs`` leaves: ``conv_id``, ``place`` (from 0), ``edit`` (K, R or I), ``role`` and ``text``."""
    return _parts(_with_copies(conversations)).mapInArrow(lambda batches: _repaired(batches, rows=True), _ROWS_SQL)
