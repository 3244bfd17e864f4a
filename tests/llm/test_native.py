"""Fingerprints and license scans against brute force and SQL."""

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from orderflow.llm import licenses
from orderflow.llm.fingerprints import K, S, _bucket, compare_with_next, fingerprints
from orderflow.llm.licenses import license_scan
from orderflow.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.oracle_check import connect, normal, rows_of

SF_DIR = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i * 7 % 501} of" for i in range(4000))
ROWS = [
    (5, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (1, None),
    (2, ""),
    (3, "One, two. THREE four five six seven eight nine ten eleven twelve thirteen fourteen!"),
    (4, "!!! ... ???"),
    (7, LONG),
    (9, "漢字とかなの文章です。漢字とかなの文章です。" * 3),
    (8, "short text"),
    (None, "no id here at all"),
    (3, "a second text of one id"),
    (3, "a second text of one id"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("anchors", F.lit("clash")).repartition(3)


def chained(a: int, b: int) -> int:
    """Spark's xxhash64 of two longs."""
    first = xxhash.xxh64(a.to_bytes(8, "little", signed=True), seed=42).intdigest()
    second = xxhash.xxh64(b.to_bytes(8, "little", signed=True), seed=first).intdigest()
    return second - (1 << 64) if second >> 63 else second


def signed(word: str) -> int:
    value = xxhash.xxh64(word.encode(), seed=42).intdigest()
    return value - (1 << 64) if value >> 63 else value


def syncmers(words: list[str]) -> set:
    hashes = [signed(w) for w in words]
    pairs = [chained(a, b) for a, b in zip(hashes, hashes[1:])]
    found = set()
    for i in range(len(words) - K + 1):
        inner = pairs[i : i + K - S + 1]
        if min(inner) in (inner[0], inner[-1]):
            found.add(tuple(words[i : i + K]))
    return found


@pytest.mark.parametrize("text", [ROWS[0][1], LONG, " ".join("abcdefg"[i % 7] for i in range(90))])
def test_anchors_are_the_closed_syncmers(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert len(fingerprints(df).first().anchors) == len(syncmers(text.split()))


def test_anchors_of_a_passage_do_not_depend_on_its_place(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage, "before it " * 9 + passage, passage + " and after", "x " + passage + " y"]
    rows = fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    own = set(next(r.anchors for r in rows if r.doc_id == 0))
    assert len(own) > 10 and all(own <= set(r.anchors) for r in rows)


def test_fingerprint_cases(docs):
    rows = compare_with_next(docs).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == "" == by_id[2].fingerprint and by_id[1].near_next == 1.0
    assert by_id[4].fingerprint and by_id[8].fingerprint and by_id[4].near_next == 0.0
    ordered = sorted((r for r in ROWS if r[0] is not None), key=lambda r: (r[0], r[1] or ""))
    want = []
    for n, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(n + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    half = len("no id here at all") // 2
    want.append((None, 17, hashlib.sha256("no id here at all"[: 17 - half].encode()).hexdigest()))
    assert sorted(want, key=str) == sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in rows), key=str)


def test_successors_across_buckets(spark):
    ids = [3, 4, 10**12, -5, 77, *range(1000, 4000, 3)]
    df = spark.createDataFrame([(i, f"text number {i} stands here") for i in ids], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.edited_sha256 for r in compare_with_next(df).collect()}
    ordered = sorted(ids)
    for n, i in enumerate(ordered):
        text, after = f"text number {i} stands here", f"text number {ordered[(n + 1) % len(ids)]} stands here"
        half = len(text) // 2
        assert got[i] == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()


def test_bucket_search(spark):
    bounds = sorted({n * n for n in range(1500)})
    df = spark.range(0, 50_000, 37).withColumn("b", _bucket(bounds, F.col("id")))
    assert all(bounds[r.b] <= r.id and (r.b + 1 == len(bounds) or bounds[r.b + 1] > r.id) for r in df.collect())


def test_likeness_follows_the_texts(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = compare_with_next(df).collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    ids = sorted(texts)
    for r in rows:
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        following = texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        a, b = (syncmers(re.findall(r"[^\W_]+", t.lower())) for t in (texts[r.doc_id], following))
        if a and b:
            assert abs(r.near_next - len(a & b) / len(a | b)) < 0.02
    assert 0.2 < sum(r.near_edited for r in rows) / len(rows) < 0.6
    by_text: dict = {}
    for r in rows:
        by_text.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())


def test_short_texts_are_like_their_edits(spark):
    pool = "amber basil cedar delta ember fjord grape hazel ivory jolly koala lemon mango noble ocean piano quilt raven solar tulip".split()
    texts = [" ".join(pool[(5 * n + i) % 20] for i in range(n)) for n in range(3, 21)]
    # One long word, scripts without blanks, and texts that are equal to each other.
    texts += ["".join(pool), "ភាសាខ្មែរជាភាសាមួយ" * 3, "ພາສາລາວເປັນພາສາ" * 2, "a few words", "a few words"]
    # Every other document is of other words.
    rows = [row for n, t in enumerate(texts) for row in ((2 * n, t), (2 * n + 1, " ".join(str(n * 1000 + i * 7) for i in range(30))))]
    got = {r.doc_id: r for r in compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n, text in enumerate(texts):
        r = got[2 * n]
        assert 0 < r.near_edited < 0.9 and r.near_next < 0.05, (text, r)
    assert got[2 * len(texts) - 2].fingerprint == got[2 * len(texts) - 4].fingerprint != got[0].fingerprint
    long_word = set(got[2 * texts.index("".join(pool))].fingerprint.split(","))
    assert len(long_word) > 20


def test_empty_tables(docs):
    empty = docs.where("false")
    assert compare_with_next(empty).count() == 0 and license_scan(empty).count() == 0


LICENSED = [
    (1, "Under the MIT license. under the mit LICENSE, cc by-nc CC BY NC"),
    (2, "x\nReleased under the MIT Licence and License\ny"),
    (3, None),
    (4, ""),
    (5, "Licensed under the GNU General Public\nLicense version 3"),
    (6, "This work is licensed under GNU General Public License, version 3."),
    (7, "apache license version 2.0 apache license version 22"),
    (8, "all\nrights\nreserved ÀLL rights reserved"),
    (9, ("filler words " * 3000) + "\nAll rights, reserved\n" + "cc by nc " * 5),
    (None, "cc by nc"),
    (6, "This work is licensed under GNU General Public License, version 3."),
    (10, "all rights reserved"),
]


def agrees(spark, frame, name, tables: dict) -> bool:
    connection = connect("/nowhere")
    for table, df in tables.items():
        connection.register(table, df.toArrow())
    cursor = connection.execute(LLM_ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    return rows_of(columns, cursor.fetchall()) == rows_of(frame.columns, frame.collect())


def test_licenses_against_sql(spark):
    docs = spark.createDataFrame(LICENSED, "doc_id long, text string").withColumn("words", F.lit(1)).repartition(3)
    assert agrees(spark, license_scan(docs), "op7_license_scan", {"documents": docs})
    rows = {r.doc_id: r for r in license_scan(docs).collect()}
    assert rows[1].n_base == 4 and rows[1].base_labels == "cc-by-nc,mit" and rows[1].first_word == 0
    assert rows[7].n_base == 1 and rows[7].labels == "apache-2"
    assert rows[6].labels == "gpl-3" and rows[6].base_labels == "" and rows[5].labels == ""
    assert rows[3].labels == "" and rows[3].first_word is None and rows[10].labels == "all-rights-reserved"
    assert rows[8].labels == "all-rights-reserved" and rows[2].labels == "mit"


@pytest.mark.parametrize("name", ["op7_license_scan", "op10_topk"])
def test_sql(spark, name):
    cursor = connect(SF_DIR).execute(LLM_ORACLES[name])
    columns = [d[0] for d in cursor.description]
    frame = LLM_QUERIES[name](spark, SF_DIR)
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(columns, cursor.fetchall()) == rows_of(frame.columns, frame.collect())


def held_by_brute_force(words: list[str], notices, threshold: float) -> dict[str, float]:
    out: dict[str, float] = {}
    for label, tokens, pattern in notices:
        width = -(-len(tokens) * 10 // round(threshold * 10))
        for start in range(max(1, len(words) - width + 1)):
            window = words[start : start + width]
            share = len(set(window) & set(tokens)) / len(set(tokens))
            if share >= threshold - 1e-9 and re.search(pattern, f" {' '.join(window)} "):
                out[label] = max(out.get(label, 0), share)
    return out


@pytest.mark.parametrize("seed,threshold", [(4, 0.7), (5, 0.8), (6, 0.5), (7, 1.0)])
def test_held_notices_against_brute_windows(spark, seed, threshold):
    import random

    rng = random.Random(seed)
    pool = [f"t{i}" for i in range(14)]
    texts = [(i, [rng.choice(pool) for _ in range(rng.choice((0, 1, 3, 8, 30, 60)))]) for i in range(300)]
    notices = []
    for i in range(10):
        tokens = [rng.choice(pool) for _ in range(rng.randint(1, 7))]
        notices.append((f"l{i}", tokens, rng.choice(("", f" {tokens[0]} ", f" {tokens[0]} (?:[^\\n]* )?{tokens[-1]} "))))
    frequency = {t: sum(t in words for _, words in texts) for t in pool}
    df = spark.createDataFrame(texts, "id long, words array<string>").repartition(3)
    got = df.select("id", licenses.held_notices(F.col("words"), notices, frequency, threshold).alias("held")).collect()
    assert len(got) == len(texts) and any(r.held for r in got)
    for r in got:
        best: dict = {}
        for label, share in r.held:
            best[label] = max(best.get(label, 0), share)
        assert best == pytest.approx(held_by_brute_force(texts[r.id][1], notices, threshold)), texts[r.id]
    assert normal(1.0) == "1.0"


BSD = "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that"
GPL = (
    "# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public "
    "License as published by\n# the Free Software Foundation; either version {} of the License, or\n# (at your option) any later version."
)
NOTICE_CASES = [
    # Broken over lines, in usual and in unusual places.
    (BSD, "bsd"),
    (BSD.replace(" ", "\n"), "bsd"),
    ("x " * 5000 + BSD + " y" * 5000, "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy", "mpl-2"),
    (GPL.format(2), "gpl-2"),
    (GPL.format(3), "gpl-3"),
    ("This program is free software under the GNU General\nPublic License,\nversion 2", "gpl-2"),
    ("Licensed under the Apache License,\r\n\tVersion 2.0 (the License)", "apache-2"),
    ("Released under the\nMIT License", "mit"),
    ("all\nrights\nreserved", "all-rights-reserved"),
    (BSD + "\n\n" + GPL.format(3), "bsd,gpl-3"),
    # One word more or less than the notice.
    ("This work is licensed under GNU General Public License, version 3.", "gpl-3"),
    ("It is released under MIT License", "mit"),
    # Near misses: the word that tells licences apart is another one.
    ("Licensed under the GNU General Public License, Version 2.0", ""),
    ("This work is licensed under the GNU General Public License, version 2.", "gpl-2"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", ""),
    ("Released under the BSD License", ""),
    ("Released under the GNU General Public License", ""),
    ("Licensed under CC BY 4.0", ""),
    ("Licensed under CC BY-SA 4.0", ""),
    ("Licensed under the Apache License, Version 1.1, see part 2", ""),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ""),
    ("The album was released under the Island label after the band signed a distribution license in 1998.", ""),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of this software", ""),
    # Words of a notice that are scattered over one long line.
    ("released " + "word " * 30 + "under the " + "word " * 30 + "mit license", ""),
    ("all " + "word " * 9 + "rights " + "word " * 9 + "reserved", ""),
    ("", ""),
    (None, ""),
]


def test_notices(spark):
    cases = [(n, text) for n, (text, _) in enumerate(NOTICE_CASES)] + [(None, BSD), (0, BSD)]
    docs = spark.createDataFrame(cases, "doc_id long, text string").withColumns({"held": F.lit("clash"), "id": F.lit(3)}).repartition(3)
    assert agrees(spark, license_scan(docs), "op7_license_scan", {"documents": docs})
    rows = license_scan(docs).collect()
    assert len(rows) == len(cases)
    got = {r.doc_id: r.labels for r in rows}
    assert [(text, got[n]) for n, (text, _) in enumerate(NOTICE_CASES)] == NOTICE_CASES and got[None] == "bsd"
    assert all((r.score >= 0.8) == (r.labels != "") for r in rows)
    assert license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plans(spark):
    for name in ("op3_fingerprints", "op7_license_scan"):
        plan = LLM_QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
