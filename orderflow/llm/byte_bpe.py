"""Byte-level BPE by ranks, encoded in linear time and decoded again.

A pre-token is covered greedily with the longest tokens. Each choice must be compatible with the token before
it: the two, written together, must be merged to just these two. Where no choice is, the last token is taken
back and its next shorter one is tried; positions that have failed are never entered again. A row of tokens
whose neighbours are all compatible is the result of the merges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import tokenizers
from orderflow.llm.batches import even_batches
from orderflow.llm.piece_memo import PieceMemo

#: Pairs of tokens whose compatibility a worker remembers; the memory is emptied when full.
PAIRS = 1_000_000


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The merges taken literally: always the leftmost pair of the lowest rank. For short pieces."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
        if rank == 1 << 40:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


class ByteBpe:
    """Encoder and decoder for one table of ranks; ``pattern`` gives the pre-tokens of a text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._ranks = ranks
        self._find = regex.compile(pattern).findall
        self._bytes = {rank: token for token, rank in ranks.items()}
        # A token that the merges don't build can't be part of a longer piece.
        built = {token: rank for token, rank in ranks.items() if merged(token, ranks) == [rank]}
        self._built = built
        # The automaton takes strings, so bytes are written as the Latin-1 characters of the same numbers.
        self._automaton = ahocorasick.Automaton()
        for token, rank in built.items():
            self._automaton.add_word(token.decode("latin-1"), rank)
        self._automaton.make_automaton()
        self.decimal = {rank: str(rank) for rank in self._bytes}
        self._length = {rank: len(token) for token, rank in built.items()}
        self._shorter: dict[int, int] = {}
        self._pairs: dict[tuple[int, int], bool] = {}

    def _next_shorter(self, rank: int) -> int:
        """The longest built token that begins this one; -1 if there is none."""
        known = self._shorter.get(rank)
        if known is None:
            token = self._bytes[rank]
            known = next((self._built[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self._built), -1)
            self._shorter[rank] = known
        return known

    def _compatible(self, left: int, right: int) -> bool:
        pair = (left, right)
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            known = merged(self._bytes[left] + self._bytes[right], self._ranks) == [left, right]
            self._pairs[pair] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self._ranks.get(piece)
        if whole is not None:
            return [whole]
        longest: list[int] = [-1] * len(piece)
        # Matches come in order of their ends, so the last one of a start is its longest.
        for end, rank in self._automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - self._length[rank]] = rank
        failed = bytearray(len(piece) + 1)
        ids: list[int] = []
        at, rank = 0, longest[0]
        while at < len(piece):
            while rank >= 0:
                end = at + self._length[rank]
                if not failed[end] and (not ids or self._compatible(ids[-1], rank)):
                    break
                rank = self._next_shorter(rank)
            if rank >= 0:
                ids.append(rank)
                at = end
                rank = longest[at] if at < len(piece) else -1
            else:
                failed[at] = 1
                if not ids:
                    raise ValueError("these ranks can't encode every byte")
                rank = ids.pop()
                at -= self._length[rank]
                rank = self._next_shorter(rank)
        return ids

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.encode_piece(p.encode("utf-8", "replace")) for p in self._find(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids))


def _worker(shared, pattern: str):
    """The encoder of this worker and its memory of pieces."""

    def make(shared):
        bpe = ByteBpe(tokenizers.read_ranks(shared.value[1]), pattern)
        return bpe, PieceMemo(lambda texts: [tokenizers.pack(bpe.encode(text)) for text in texts])

    return tokenizers.per_worker(f"bpe {pattern}", shared, make)


def _encoded(batches: Iterator[pa.RecordBatch], shared, pattern: str) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """For each batch its ids of rows and the token ids of their texts."""
    bpe, memo = _worker(shared, pattern)
    cuttable = pattern == public_tokenizers.PATTERN
    for batch in batches:
        parts: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
        for part in even_batches(batch.column(1), cut=cuttable):
            only = [text for _, text in part]
            values = memo.split_and_encode(only) if cuttable else [[tokenizers.pack(bpe.encode(t))] for t in only]
            for (row, _), packed in zip(part, values):
                parts[row] += packed
        yield batch.column(0), [np.frombuffer(b"".join(p), "<u4") for p in parts]


def _narrow(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))


def bpe_encode(
    docs: DataFrame,
    ranks: str,
    *,
    pattern: str = public_tokenizers.PATTERN,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs`` with its id and ``ids`` (array of int).

    ``ranks`` names a ``.tiktoken`` file. Each match of ``pattern`` is encoded for itself; there are no special
    tokens. No shuffle. A null text is empty and has no ids; a null id stays null; repeated rows give repeated
    rows; an empty table gives none; other columns are not read. Long texts are encoded in parts (with another
    pattern than the usual one: whole).
    """
    shared = tokenizers.shipped(docs.sparkSession, ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows in _encoded(batches, shared, pattern):
            ids = pa.array([row.astype(np.int32) for row in rows], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([keys, ids], ["id", "ids"])

    encoded = _narrow(docs, id_column, text_column).mapInArrow(encode, "id long, ids array<int>")
    return encoded.withColumnRenamed("id", id_column)


def bpe_decode(encoded: DataFrame, ranks: str, *, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """One row per row of ``encoded`` with its id and ``decoded`` (binary).

    Null ids give null, no ids give no bytes; an id that the ranks don't have is an error.
    """
    shared = tokenizers.shipped(encoded.sparkSession, ranks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokenizers.per_worker("ranks", shared, lambda s: {i: t for t, i in tokenizers.read_ranks(s.value[1]).items()})
        for batch in batches:
            rows = [None if ids is None else b"".join(map(token.__getitem__, ids)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["id", "decoded"])

    narrow = encoded.select(F.col(id_column).cast("long").alias("id"), F.col(ids_column).alias("ids"))
    return narrow.mapInArrow(decode, "id long, decoded binary").withColumnRenamed("id", id_column)


def bpe_digests(
    docs: DataFrame,
    ranks: str,
    *,
    pattern: str = public_tokenizers.PATTERN,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``bpe_encode`` and ``bpe_decode`` in one pass that returns digests, not ids and texts.

    Columns: the id, ``n_tokens``, ``ids_sha256`` (of decimal ids joined by commas) and ``decoded_sha256`` (of the
    bytes that the ids decode to). Cases as in ``bpe_encode``; an empty text gives the digest of nothing.
    """
    shared = tokenizers.shipped(docs.sparkSession, ranks)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = _worker(shared, pattern)
        for keys, rows in _encoded(batches, shared, pattern):
            counts, of_ids, of_bytes = [], [], []
            for row in rows:
                ids = row.tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            columns = [keys, pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    digests = _narrow(docs, id_column, text_column).mapInArrow(
        digest, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return digests.withColumnRenamed("id", id_column)
