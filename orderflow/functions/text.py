"""Text helpers. All of them are plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# What counts as white space, and the characters that trimming removes.
_BLANK = r"^[\x09-\x0D\x1C-\x20\u1680\u2000-\u2006\u2008-\u200A\u2028\u2029\u205F\u3000]*$"
_TRIMMED = "".join(map(chr, range(0x21)))


def is_blank(text: Column) -> Column:
    """Null, empty or white space only (no-break spaces are content).

    Texts that begin with a plain visible character are settled without the pattern.
    """
    return text.isNull() | (((text < "!") | (text >= "\u1680")) & text.rlike(_BLANK))


def trimmed(text: Column) -> Column:
    """Without spaces, tabs and other control characters at both ends (``trim`` strips spaces alone)."""
    return F.btrim(text, F.lit(_TRIMMED))


def shortened(text: Column, limit: int = 1000) -> Column:
    """Cuts to ``limit`` characters and marks the cut with three dots."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def capped(text: Column, limit: int = 900) -> Column:
    """Cuts to ``limit`` characters; null becomes the empty text."""
    return F.coalesce(F.substring(text, 1, limit), F.lit(""))


def set_text(values: tuple[str, ...]) -> str:
    """An enumeration as it is printed in problem texts, in sorted order."""
    return "[" + ", ".join(sorted(values)) + "]"


def json_of(value: Column) -> Column:
    """JSON text of a struct; null fields are left out, a null struct stays null."""
    return F.when(value.isNotNull(), F.to_json(value))


def json_of_map(value: Column) -> Column:
    """JSON text of a string map without null values; a null map counts as empty."""
    present = F.map_filter(value, lambda _, v: v.isNotNull())
    return F.coalesce(F.to_json(present), F.lit("{}"))
