"""The near-duplicate join against brute force and SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm.components import components
from orderflow.llm.jaccard_join import common, near_duplicates, prefix_depth, shingles, without_duplicates
from orderflow.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.oracle_check import connect, rows_of

SF_DIR = "/root/testdata/sf0.001"


def test_prefixes_are_shortened_to_the_recall():
    assert prefix_depth() == 5
    assert prefix_depth(recall=0.5) > prefix_depth(recall=0.999) >= 5 > prefix_depth(threshold=0.4)
    assert 1 - (1 - 0.8 ** prefix_depth()) ** 24 >= 0.9999


def test_common():
    sets = [np.unique(np.random.default_rng(n).integers(0, 400, 90).astype(np.uint64)) for n in range(30)] + [np.zeros(0, np.uint64)]
    got = common(sets, width=16)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(30)] + [(200 + i, 201 + i) for i in range(12)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(1000):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
        if all(root[a] == root[b] for a, b in edges if a != b):
            break
    assert got == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copy(rng, words, share):
    out = list(words)
    for at in rng.sample(range(len(out)), max(1, int(len(out) * share))):
        out[at] = f"new{rng.randint(0, 10**6)}"
    return " ".join(out)


def corpus():
    rng = random.Random(11)
    rows = []

    def add(text):
        rows.append((len(rows), text))

    bases = [[f"w{rng.randint(0, 5000)}" for _ in range(n)] for n in (60, 200, 200, 400, 900)]
    for base in bases:
        add(" ".join(base))
        for share in (0.004, 0.01, 0.02, 0.03, 0.05, 0.1):
            for _ in range(4):
                add(near_copy(rng, base, share))
        for _ in range(5):
            add(" ".join(base))
    shared = " ".join(f"common{i}" for i in range(80))  # a passage that many documents have
    for _ in range(60):
        add(shared + " " + " ".join(f"own{rng.randint(0, 10**6)}" for _ in range(120)))
    for text in (None, "", "!!!", "...", "!!!", "one two", "One, TWO", "one two three", "x " * 40, "x " * 50):
        add(text)
    for _ in range(30):
        add(" ".join(f"u{rng.randint(0, 10**7)}" for _ in range(50)))
    rows.append((None, " ".join(bases[0])))
    rows.append((None, "only here and without an id"))
    rows.append((0, " ".join(bases[0])))
    rows.append((40, "another text of an id that is there already"))
    return rows


def brute(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"\w+", (text or "").lower())
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        sets.append(frozenset(grams) if grams else f"text {text or ''}")
    distinct = sorted(set(sets), key=str)
    links = {s: set() for s in distinct}
    for n, a in enumerate(distinct):
        for b in distinct[n + 1 :]:
            if isinstance(a, frozenset) and isinstance(b, frozenset) and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[a].add(b)
                links[b].add(a)
    ids = {}
    for (doc_id, _), s in zip(rows, sets):
        ids.setdefault(s, []).append(doc_id)
    least = {}
    for s in distinct:
        todo, seen = [s], {s}
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        known = [i for other in seen for i in ids[other] if i is not None]
        least[s] = min(known) if known else None

    def first(s):
        return min((i for i in ids[s] if i is not None), default=None)

    return Counter((d, least[s], first(s), len(ids[s]), len(links[s])) for (d, _), s in zip(rows, sets))


@pytest.mark.parametrize("crowd,block", [(256, 512), (4, 7)])
def test_against_brute_force(spark, crowd, block):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cls", F.lit("clash")).repartition(5)
    got = near_duplicates(docs, crowd=crowd, block=block).drop("digest", "stays")
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_one_of_each_class_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "en", n) for n, r in enumerate(rows)], "doc_id long, text string, label string, n int").repartition(3)
    kept = without_duplicates(docs).collect()
    assert set(map(tuple, kept)) <= {(*r, "en", n) for n, r in enumerate(rows)}
    classes = {class_id for _, class_id, *_ in brute(rows)}
    assert len(kept) == len(classes)
    assert {r.doc_id for r in kept} == classes


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0 and without_duplicates(empty).count() == 0


def test_shingles_of_short_texts():
    assert len(shingles("")) == 0 and len(shingles("...")) == 0
    assert (shingles("One two") == shingles("one, TWO")).all() and shingles("a b") != shingles("b a")
    assert len(shingles("a b c d e")) == 1 and len(shingles("a b c d e f")) == 2 and len(shingles("x " * 99)) == 1


def test_sql(spark):
    cursor = connect(SF_DIR).execute(LLM_ORACLES["op5_jaccard_join"])
    columns = [d[0] for d in cursor.description]
    frame = LLM_QUERIES["op5_jaccard_join"](spark, SF_DIR)
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(columns, cursor.fetchall()) == rows_of(frame.columns, frame.collect())
