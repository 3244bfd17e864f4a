"""Tokenizer files of the public libraries, loaded once per Python worker.

The driver reads a file (a few MB, fixed) and broadcasts its bytes, so that executors need no copy of
it on their own disks.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

from orderflow.llm.piece_memo import PieceMemo
from orderflow.llm.worker_memory import remembered, small_batches


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a tokenizer file with its kind, broadcast."""
    small_batches(spark)
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast((os.path.splitext(path)[1], file.read()))


def per_worker(kind: str, shared: Broadcast, make: Callable[[Broadcast], object]):
    """``make(shared)``, once per Python worker and content (see ``worker_memory``)."""
    return remembered((kind, hashlib.blake2b(shared.value[1]).digest()), lambda: make(shared))


@lru_cache(maxsize=2)
def _json_tokenizer(data: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data.decode("utf-8"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: Pieces that are encoded as one text, with line feeds between them.
JOINED = 200

_PLAIN_PIECE = re.compile(r" ?\S+")


def _joined_ids(data: bytes, pieces: list[str]) -> list[bytes]:
    """The packed ids of each piece of a cuttable tokenizer, many pieces to a call of the library.

    A line feed between two pieces that hold no blank but one in front is always a token of its own, which no
    piece has, so the ids between line feeds are those of the pieces. Other pieces are encoded one by one.
    """
    tokenizer = _json_tokenizer(data)
    if hasattr(tokenizer.model, "_resize_cache"):
        tokenizer.model._resize_cache(0)  # distinct pieces only come here
    feed = tokenizer.encode("\n", add_special_tokens=False).ids
    out: list[bytes | None] = [None] * len(pieces)
    plain = [n for n, piece in enumerate(pieces) if _PLAIN_PIECE.fullmatch(piece)] if len(feed) == 1 else []
    groups = [plain[n : n + JOINED] for n in range(0, len(plain), JOINED)]
    texts = ["\n".join([pieces[n] for n in group]) for group in groups]
    for group, encoding in zip(groups, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
        ids = np.array(encoding.ids, "<u4")
        ends = [*(4 * np.flatnonzero(ids == feed[0])).tolist(), 4 * len(ids)]
        if len(ends) == len(group):
            packed, begin = ids.tobytes(), 0
            for n, end in zip(group, ends):
                out[n] = packed[begin:end]
                begin = end + 4
    rest = [n for n, value in enumerate(out) if value is None]
    for n, encoding in zip(rest, tokenizer.encode_batch_fast([pieces[n] for n in rest], add_special_tokens=False)):
        out[n] = pack(encoding.ids)
    return out


def cuttable(kind: str, data: bytes) -> bool:
    """Whether cutting at safe places leaves the tokens of a text as they are.

    So it is for byte-level tokenizers with the usual pattern, no normalizer, no added first blank and
    added tokens that neither hold nor swallow blanks. Others get their texts whole.
    """
    if kind != ".json":
        return False
    spec = json.loads(data)
    first = spec.get("pre_tokenizer") or {}
    return (
        first.get("type") == "ByteLevel"
        and first.get("use_regex", True)
        and not first.get("add_prefix_space", True)
        and not spec.get("normalizer")
        and all(
            not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not any(c.isspace() for c in t["content"])
            for t in spec.get("added_tokens") or []
        )
    )


def batch_ids(kind: str, data: bytes) -> Callable[[list[str]], list]:
    """A function from texts to their lists of ids, with nothing added before or after them."""
    if kind == ".json":
        tokenizer = _json_tokenizer(data)
        return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    if kind == ".model":
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda texts: processor.encode(texts, num_threads=1, add_bos=False, add_eos=False)
    if kind == ".tiktoken":
        import public_tokenizers
        import tiktoken

        encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(data), special_tokens={}
        )
        return lambda texts: [encoding.encode_ordinary(text) for text in texts]
    raise ValueError(f"no tokenizer library for {kind} files")


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def count_memo(shared: Broadcast) -> PieceMemo | None:
    """Token counts of pieces; None if texts of this tokenizer can't be cut."""
    kind, data = shared.value
    if not cuttable(kind, data):
        return None
    return PieceMemo(lambda pieces: [len(packed) // 4 for packed in _joined_ids(data, pieces)])


def id_memo(shared: Broadcast) -> PieceMemo | None:
    """Ids of pieces as little-endian unsigned 32-bit numbers; None if texts can't be cut."""
    kind, data = shared.value
    if not cuttable(kind, data):
        return None
    return PieceMemo(lambda pieces: _joined_ids(data, pieces))


def pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()
