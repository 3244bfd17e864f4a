"""Even batches of text inside a task: rows grouped by bytes, long texts cut where it is safe."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

#: Characters of text handled at a time; a bound on memory, not on the length of a text.
BATCH_CHARS = 1 << 20
#: Texts beyond this are cut (at safe places only) before they are batched.
LONG_CHARS = 1 << 19

_SAFE_CUT = re.compile(r"(?<=\w)(?=[ \n\t\r])")


def safe_parts(text: str, limit: int = LONG_CHARS) -> Iterator[str]:
    """Cuts a text into parts of about ``limit`` characters.

    A cut lies between a word character and a blank. Byte-level pre-tokenizers start a new match there
    whatever stands around it, so that the tokens of the parts are the tokens of the text. A text
    without such a place stays whole.
    """
    start = 0
    while len(text) - start > limit:
        cut = _SAFE_CUT.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def even_batches(texts: pa.Array, limit: int = BATCH_CHARS, cut: bool = True) -> Iterator[list[tuple[int, str]]]:
    """(row, part) pairs in row order, in lists of about ``limit`` characters; null counts as empty."""
    batch: list[tuple[int, str]] = []
    size = 0
    for row, value in enumerate(texts):
        text = value.as_py() or ""
        for part in safe_parts(text) if cut and len(text) > LONG_CHARS else (text,):
            if batch and size + len(part) > limit:
                yield batch
                batch, size = [], 0
            batch.append((row, part))
            size += len(part)
    if batch:
        yield batch
