"""Remembered tokenizations of short pieces of text, kept by each Python worker.

Prose repeats its words. A text is cut in front of the blanks that follow a non-blank, and of the stops that follow
a letter or number, where byte-level pre-tokenizers always start a new match; each distinct piece goes through the tokenizer
library once (in batches) and its ids are looked up from then on. The results are those of the whole
text, as the tests verify against the library.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from itertools import chain

#: Entries of a memo, in two generations: when the younger one is full it becomes the older, and what is used again
#: moves back. Forgetting costs time and changes no result.
MEMO_ENTRIES = 750_000
#: Longer pieces are not remembered.
MEMO_CHARS = 48

#: All blanks but the four plain ones; none lies beyond U+3000.
RARE_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n\t\r"]
_RARE_ASCII = [c for c in RARE_BLANKS if c.isascii()]
_PIECE = re.compile(r"\s*+(?:[^\s,.;:!?]++(?<=[^\W_])(?=[,.;:!?])|\S++)|\s++")
_SAFE_CUT = re.compile(r"(?<=\w)(?=[ \n\t\r])")


def has_rare_blank(text: str) -> bool:
    """Looks for one blank after the other, which is much faster than a pattern that tries every character."""
    return any(blank in text for blank in (_RARE_ASCII if text.isascii() else RARE_BLANKS))


def pieces(text: str) -> list[str]:
    """The text cut at safe places: between a non-blank and a blank, or a letter or number and a stop.

    Libraries differ in what they take for a blank beyond the four plain ones. A text that has any of
    those is cut only between word characters and plain blanks, which all of them agree on.
    """
    return _SAFE_CUT.split(text) if has_rare_blank(text) else _PIECE.findall(text)


class PieceMemo:
    """``encode`` maps a list of pieces to a value for each: packed ids, or a count."""

    def __init__(self, encode: Callable[[list[str]], Iterable], entries: int = MEMO_ENTRIES):
        self._encode = encode
        self._entries = entries
        self._known: dict = {}
        self._older: dict = {}

    def split_and_encode(self, texts: Sequence[str]) -> list[list]:
        """For each text the values of its pieces, in order."""
        split = [pieces(text) for text in texts]
        if len(self._known) > self._entries // 2:
            self._older, self._known = self._known, {}
        known, older = self._known, self._older
        unknown = set(chain.from_iterable(split)).difference(known)
        again = unknown & older.keys()
        known.update((piece, older[piece]) for piece in again)
        missing = list(unknown - again)
        known.update(zip(missing, self._encode(missing)))
        values = [list(map(known.__getitem__, parts)) for parts in split]
        for piece in missing:
            if len(piece) > MEMO_CHARS:
                del known[piece]
        return values
