"""Packing of tokenized documents into sequences of even attention cost."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import tokenizers
from orderflow.llm.batches import even_batches

#: Cost of a piece of n tokens in a sequence that masks attention between documents: n + n * n / this.
QUADRATIC_FROM = 512.0
#: Sequences that are filled together: bounds memory, and the choice a piece has.
WINDOW = 256

SCHEMA = pa.schema(
    [
        ("id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("sequence_tokens", pa.int64()),
    ]
)


class Piece(NamedTuple):
    """``length`` ids of a document from ``start`` on; ``ids`` are those of the whole document, packed."""

    doc_id: int | None
    ids: bytes
    start: int
    length: int

    def head(self, n: int) -> Piece:
        return self._replace(length=n)

    def tail(self, n: int) -> Piece:
        return self._replace(start=self.start + n, length=self.length - n)

    def packed(self) -> bytes:
        return self.ids[4 * self.start : 4 * (self.start + self.length)]


def cost(n: int) -> float:
    return n + n * n / QUADRATIC_FROM


def fill(pieces: list[Piece], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Fills as many whole sequences as the pieces give; returns them and the pieces left over.

    The longest piece comes first and goes to the sequence of the lowest cost that has room for it. If
    none has, it is cut: the cheapest sequence with any room takes what fits, and the rest waits for its
    turn by its own length. Every sequence returned is full.
    """
    count = sum(p.length for p in pieces) // capacity
    sequences: list[list[Piece]] = [[] for _ in range(count)]
    costs, room = np.zeros(count), np.full(count, capacity)
    waiting: list[tuple[int, int, Piece]] = []
    for order, piece in enumerate(pieces):
        while piece.length > capacity:
            heapq.heappush(waiting, (-capacity, order, piece.head(capacity)))
            piece = piece.tail(capacity)
        heapq.heappush(waiting, (-piece.length, order, piece))
    left: list[Piece] = []
    order = len(pieces)
    while waiting:
        _, place, piece = heapq.heappop(waiting)
        open_costs = np.where(room >= piece.length, costs, np.inf)
        at = int(open_costs.argmin()) if count else -1
        if at < 0 or open_costs[at] == np.inf:
            open_costs = np.where(room > 0, costs, np.inf)
            at = int(open_costs.argmin()) if count else -1
            if at < 0 or open_costs[at] == np.inf:
                left.append(piece)
                continue
            rest = piece.tail(int(room[at]))
            heapq.heappush(waiting, (-rest.length, order, rest))
            order += 1
            piece = piece.head(int(room[at]))
        sequences[at].append(piece)
        room[at] -= piece.length
        costs[at] += cost(piece.length)
    return sequences, left


def powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Cuts what is left at the end of a task into sequences whose lengths are powers of two."""
    total = sum(p.length for p in pieces)
    waiting = list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        room, sequence = total & 1 << bit, []
        while room:
            piece = waiting.pop()
            if piece.length > room:
                waiting.append(piece.tail(room))
                piece = piece.head(room)
            sequence.append(piece)
            room -= piece.length
        if sequence:
            yield sequence


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 2048,
    end_id: int = 1,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece of a document: where it starts there, and its sequence and offset there.

    A document is its tokens and ``end_id``. Each task packs its own rows in windows of ``WINDOW``
    sequences; what a window leaves over (less than one sequence) goes to the next one. Only at the end of a
    task are there shorter sequences, with lengths that are powers of two, so that nothing is padded. No
    shuffle and no global order; the number of tasks adds at most one such tail each.

    ``sequence_id`` is the task's partition number times 2^33 plus a count, so a repeated task gives the
    same ids. ``with_ids`` adds the ids themselves as ``ids`` (array of int).

    A null text is an empty document (``end_id`` alone); a null id stays null; repeated rows are packed
    each for itself; equal lengths keep the order of their rows; an empty table gives no rows; other columns
    are not read. A long text is tokenized in parts and cut into as many sequences as it needs.
    """
    shared = tokenizers.shipped(docs.sparkSession, tokenizer)
    end = tokenizers.pack([end_id])
    schema = SCHEMA.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else SCHEMA

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
        memo = tokenizers.per_worker("ids", shared, tokenizers.id_memo)
        encode = None if memo else tokenizers.batch_ids(*shared.value)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            row, held = 0, []
            for part in even_batches(batch.column(1), cut=memo is not None):
                only = [text for _, text in part]
                values = memo.split_and_encode(only) if memo else [[tokenizers.pack(i)] for i in encode(only)]
                for (at, _), packed in zip(part, values):
                    if at != row:
                        ids = b"".join([*held, end])
                        yield Piece(doc_ids[row], ids, 0, len(ids) // 4)
                        row, held = at, []
                    held += packed
            if doc_ids:
                ids = b"".join([*held, end])
                yield Piece(doc_ids[row], ids, 0, len(ids) // 4)

    def rows(sequences: list[list[Piece]], first: int) -> pa.RecordBatch:
        out: list[tuple] = []
        for number, sequence in enumerate(sequences):
            offset, tokens = 0, sum(p.length for p in sequence)
            for piece in sequence:
                digest = zlib.crc32(piece.packed())
                row = (piece.doc_id, piece.start, piece.length, digest, len(piece.ids) // 4, first + number, offset, tokens)
                out.append((*row, np.frombuffer(piece.packed(), "<u4").astype(np.int32)) if with_ids else row)
                offset += piece.length
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 33
        window: list[Piece] = []
        size = 0
        for piece in tokenized(batches):
            window.append(piece)
            size += piece.length
            if size >= WINDOW * capacity:
                full, window = fill(window, capacity)
                size = sum(p.length for p in window)
                yield rows(full, next_id)
                next_id += len(full)
        full, left = fill(window, capacity)
        full += powers(left)
        if full:
            yield rows(full, next_id)

    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    columns = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
    packed = narrow.mapInArrow(pack, columns + ", ids array<int>" * with_ids)
    return packed.withColumnRenamed("id", id_column)
