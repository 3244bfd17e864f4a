"""License scans: phrases, and an exact containment join of word windows with notices. DataFrame functions only."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters of a word, and the phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

THRESHOLD = 0.8

_VERSION = "(?:version |ver |v )?v?"
#: Notices as they are commonly written. Label, text, and what tells the licence from others: a pattern that must be found
#: in the window's words, which have one blank between them, before the first and after the last.
NOTICES = (
    ("apache-2", "Licensed under the Apache License, Version 2.0", rf" apache (?:license )?{_VERSION}2 "),
    ("mit", "Released under the MIT License", r" mit licen[cs]e "),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        r" free of charge to any person obtaining a copy of this software ",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", rf" cc by nc {_VERSION}4 "),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        rf" creative commons attribution {_VERSION}4 ",
    ),
    *(
        (f"gpl-{n}", text.format(n), pattern.format(n))
        for n in (2, 3)
        for text, pattern in (
            ("This work is licensed under the GNU General Public License, version {}", rf" gnu general public license {_VERSION}{{}} "),
            (
                "This program is free software under the GNU General Public License, version {}",
                rf" gnu general public license {_VERSION}{{}} ",
            ),
            (
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version {} of the License",
                rf" gnu general public license as published by the free software foundation (?:either )?{_VERSION}{{}} ",
            ),
        )
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        r" redistribution and use in source and binary forms (?:[^\n]* )?modification are permitted ",
    ),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
        rf" mozilla public license {_VERSION}2 ",
    ),
    ("all-rights-reserved", "All rights reserved", r" all rights (?:are )?reserved "),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def _split(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(_UPPER, _LOWER)))


def _places(words: Column, phrase: list[str]) -> Column:
    """Where the phrase's words stand one after the other, counted from 0; only texts with all its words are searched."""

    def here(word: Column, i: Column) -> Column:
        same = word == phrase[0]
        for n, later in enumerate(phrase[1:], 1):
            same = same & (F.get(words, i + n) == later)
        return F.when(same, i)

    every = reduce(and_, (F.array_contains(words, word) for word in phrase))
    return F.when(every, F.array_compact(F.transform(words, here))).otherwise(F.array().cast("array<int>"))


def _needed(tokens: list[str], threshold: float) -> int:
    return max(1, math.ceil(threshold * len(tokens) - 1e-9))


def _prefix(ranked: list[str], threshold: float) -> list[str]:
    return ranked[: len(ranked) - _needed(ranked, threshold) + 1]


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shows(window: Column, pattern: Column) -> Column:
    return F.regexp_like(F.concat(F.lit(" "), F.array_join(window, " "), F.lit(" ")), pattern)


def width_of(tokens: list[str], threshold: float) -> int:
    """The words of a window for a notice of these words."""
    return math.ceil(len(tokens) / threshold - 1e-9)


def held_notices(words: Column, notices: list[tuple[str, list[str], str]], frequency: dict[str, int], threshold: float) -> Column:
    """Label and ``containment`` (array of structs) of each notice that some window of the words holds.

    A window has as many words as the notice has, divided by the threshold; a shorter text is one window. It holds the
    notice if it has the threshold's share of the notice's words (as sets) and the notice's pattern is found in it. The words
    of notices are ordered by ``frequency``, rare ones first. A window that has ``need`` of a notice's n words has
    one of its first n - need + 1 (prefix), so only the windows around each place of one are looked at; those words must hold
    ``need`` of the notice's words at all (length) and from the word that met on (position). What passes is verified,
    window by window. The notices are a parameter of a few entries, so their index is a constant of the plan.
    """
    order = {t: n for n, t in enumerate(sorted(frequency, key=lambda t: (frequency[t], t)))}
    index, heads = [], set()
    for label, tokens, pattern in notices:
        ranked = sorted(set(tokens), key=order.__getitem__)
        prefix = _prefix(ranked, threshold)
        heads |= set(prefix)
        for n, token in enumerate(prefix):
            entry = {"token": token, "label": label, "need": _needed(ranked, threshold), "width": width_of(tokens, threshold), "pattern": pattern}
            lists = {"tokens": ranked, "rest": ranked[n:]}
            index.append(
                F.struct(
                    *(F.lit(v).alias(k) for k, v in entry.items()), *(F.array(*map(F.lit, v)).alias(k) for k, v in lists.items())
                )
            )
    first = F.array(*(F.lit(t) for t in sorted(heads)))

    def tested(notice: Column, near: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(near) - notice["width"] + 1, F.lit(1)))

        def shared(start: Column) -> Column:
            window = F.slice(near, start, notice["width"])
            return F.when(_shows(window, notice["pattern"]), F.size(F.array_intersect(notice["tokens"], window)))

        may = (F.size(F.array_intersect(notice["rest"], near)) >= notice["need"]) & _shows(near, notice["pattern"])
        best = F.when(may, F.array_max(F.transform(starts, shared)))
        found = lambda n: F.when(
            n >= notice["need"], F.struct(notice["label"].alias("label"), (n / F.size(notice["tokens"])).alias("containment"))
        )
        return _bound(best, found)

    def around(place: Column) -> Column:
        def of(notice: Column) -> Column:
            begin = F.greatest(place - notice["width"] + 1, F.lit(0))
            return _bound(F.slice(words, begin + 1, place - begin + notice["width"]), lambda near: tested(notice, near))

        return F.transform(F.filter(F.array(*index), lambda notice: notice["token"] == F.get(words, place)), of)

    places = F.array_compact(F.transform(words, lambda w, i: F.when(F.array_contains(first, w), i)))
    some = F.when(F.arrays_overlap(words, first), places).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.array_compact(F.flatten(F.transform(some, around))))


def _frequency(with_words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """The number of texts that each word of the vocabulary is in."""
    known = F.array(*(F.lit(t) for t in vocabulary)).cast("array<string>")
    seen = with_words.select(F.explode(F.array_intersect(known, "words")).alias("token")).groupBy("token").count()
    return dict.fromkeys(vocabulary, 0) | {r.token: r["count"] for r in seen.collect()}


def license_scan(
    docs: DataFrame,
    notices: tuple[tuple[str, str, str], ...] = NOTICES,
    *,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    Base: the places of ``PHRASES``. ``labels`` adds those of the notices that a window of the text's words holds (see
    ``held_notices``), wherever the notice stands: line breaks don't matter, words that are scattered over a long text are
    no notice, and the name and version of the licence must be there, in order and next to each other. ``score`` is 1
    where a phrase stands, else the best containment of a notice that is held, else 0. Two passes over the
    texts: in how many of all documents each of the notices' words is, and the scan itself, which needs no shuffle.

    A null text is empty: no words, no labels (empty strings), score 0. A null id stays null; repeated rows give
    repeated rows; equal containments keep the label once; an empty table gives no rows; other columns are not
    read, whatever their names. Notices without a word are left out.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    known = [(label, tokens, pattern) for label, tokens, pattern in ((label, _split(t), p) for label, t, p in notices) if tokens]
    with_words = narrow.select("id", words_of(F.col("text")).alias("words"))
    held = F.array().cast("array<struct<label:string,containment:double>>")
    if known:
        frequency = _frequency(with_words, sorted({t for _, tokens, _ in known for t in tokens}))
        held = held_notices(F.col("words"), known, frequency, threshold)
    phrases = [(phrase.split(), label) for phrase, label in PHRASES.items()]
    found = with_words.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        *(_places(F.col("words"), phrase).alias(f"at{n}") for n, (phrase, _) in enumerate(phrases)),
        held.alias("held"),
    )
    base = F.array_compact(F.array(*(F.when(F.size(f"at{n}") > 0, F.lit(label)) for n, (_, label) in enumerate(phrases))))
    every = F.concat(*(F.col(f"at{n}") for n in range(len(phrases))))
    found = found.select("id", "n_words", every.alias("places"), base.alias("base"), "held")
    return found.select(
        F.col("id").alias(id_column),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.col("held.label"))), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("held.containment"), F.lit(0.0))).alias("score"),
    )
