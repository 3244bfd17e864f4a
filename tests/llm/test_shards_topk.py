"""Sharding and exact top-k search against brute force."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm.sharding import best_fit_decreasing, even_bins, shard_documents
from orderflow.llm.topk import PROBE, Lists, no_random_access, top_k_products


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_against_a_plain_search(seed):
    rng = np.random.default_rng(seed)
    sizes = [int(n) for n in rng.integers(1, 60, 300)] + [130]
    room, want = [], [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [(r, at) for at, r in enumerate(room) if r >= sizes[item]]
        if fits:
            want[item] = min(fits)[1]
        else:
            want[item] = len(room)
            room.append(100)
        room[want[item]] -= sizes[item]
    assert best_fit_decreasing(sizes, 100) == want


def test_even_bins():
    rng = np.random.default_rng(3)
    sizes = [int(n) for n in rng.integers(1, 50, 20_000)]
    totals = np.bincount(even_bins(sizes, 40), weights=sizes, minlength=40)
    assert totals.max() - totals.min() < 0.01 * totals.mean()
    totals = np.bincount(even_bins([10_000, 5000, *[10] * 300], 5), weights=[10_000, 5000, *[10] * 300], minlength=5)
    assert sorted(totals) == [1000, 1000, 1000, 5000, 10_000]
    assert even_bins([], 3) == [] and set(even_bins([5, 4], 3)) <= {0, 1, 2}


def test_shards(spark):
    rng = np.random.default_rng(2)
    texts = ["copy " * 40] * 2500 + [None, "", ""] + ["x" * int(n) for n in rng.integers(1, 900, 4000)] + ["medium copy " * 9] * 60
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (5, "copy " * 40), (5, "copy " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("clash")).repartition(6)
    got = shard_documents(docs).collect()
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    shards: dict = {}
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
        shards.setdefault(r.shard, []).append(r)
    assert len(shards) == 40
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    totals = [sum(r["size"] for r in own) for own in shards.values()]
    assert max(totals) - min(totals) < 0.02 * np.mean(totals)
    of_text: dict = {}
    for r in got:
        of_text.setdefault((r["size"], r.text_crc32), set()).add(r.shard)
    share = sum(totals) / 40
    for (size, crc), where in of_text.items():
        whole = sum(r["size"] for r in got if r.text_crc32 == crc and r["size"] == size)
        assert len(where) == 1 or whole > share
    assert shard_documents(docs.where("false")).count() == 0
    assert {r.shard for r in shard_documents(docs.where("doc_id = 7")).collect()} <= set(range(40))


def brute(rows, is_query, k):
    out = {}
    usable = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in usable), default=0)
    usable = [(i, np.array(v + [0] * (width - len(v)))) for i, v in usable]
    for q, a in usable:
        if is_query(q):
            best = sorted((-int(a @ b), i) for i, b in usable if i != q)[:k]
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("chunk,block", [(4096, 512), (60, 3)])
def test_top_k(spark, chunk, block):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=12)]) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(100)]  # one common vector: ties
    rows += [(None, rows[1][1]), (1000, None), (1020, [1.0, None]), (1040, [float("nan")] * 12), (1060, [float("inf")] * 12)]
    rows += [(1080, []), (1100, [1.0, 2.0]), (40, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).repartition(5)
    got: dict = {}
    for r in top_k_products(df, F.col("vec_id") % 20 == 0, 20, chunk=chunk, block=block).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == brute(rows, lambda i: i % 20 == 0, 20)


def test_top_k_of_small_tables(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, top_k_products(df, F.col("vec_id") % 20 == 0).collect()))
    assert got == [(0, 1, 1, 8192), (0, 2, 2, -4096)]
    assert top_k_products(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def best_of(rows, ids, query, own, k):
    scores = rows @ query
    order = np.lexsort((ids, -scores))
    return [(int(i), float(scores[i])) for i in order if ids[i] != own][:k]


def test_reading_stops_early_when_bounds_allow():
    rng = np.random.default_rng(8)
    rows = np.floor(64 * rng.exponential(size=(4000, 3)) ** 3)
    queries = np.array([[3.0, 1.0, 0.0], [-2.0, 0.0, 5.0], [1.0, 1.0, 1.0]])
    ids, asked = np.arange(4000), np.array([10_000, 10_001, 17])
    got, entries = no_random_access(rows, ids, queries, asked, 5)
    for j, q in enumerate(queries):
        assert [(r, s) for n, r, s, _ in got if n == j] == best_of(rows, ids, q, asked[j], 5)
    # Lists of weight 0 aren't read at all, and the others not to their ends.
    assert entries[0] < 2 * 4000 and entries[2] < 3 * 4000, entries


class Watched(Lists):
    """Notes how far each list was read from each end, and that no slice is read twice or out of order."""

    def __init__(self, rows):
        super().__init__(rows)
        self.read_to = {}

    def read(self, component, begin, end, from_top):
        assert self.read_to.get((component, from_top), 0) == begin < end
        self.read_to[component, from_top] = end
        return super().read(component, begin, end, from_top)


@pytest.mark.parametrize("seed", range(8))
def test_lists_are_read_in_order_and_results_exact(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    n, width = int(rng.integers(1, 300)), int(rng.integers(1, 9))
    rows = np.floor(rng.normal(0, 3, (n, width)) ** int(rng.integers(1, 4)))
    rows[rng.random(n) < 0.3] = rows[0]  # ties
    ids = rng.permutation(n) * 3
    queries = np.concatenate([rows[:7], np.zeros((1, width))])
    asked = np.concatenate([ids[:7], [1]])
    monkeypatch.setattr("orderflow.llm.topk.Lists", Watched)
    got, entries = no_random_access(rows, ids, queries, asked, 4)
    for j, q in enumerate(queries):
        want = best_of(rows, ids, q, asked[j], 4)
        assert [(r, s) for m, r, s, _ in got if m == j] == want
        # A floor that k rows reach changes no result. Where all rows are looked at before a test is put off, it saves reading.
        floor = np.array([want[-1][1] if len(want) == 4 else -np.inf])
        for probe in (PROBE, 5, 10**6):
            monkeypatch.setattr("orderflow.llm.topk.PROBE", probe)
            again, less = no_random_access(rows, ids, q[None], asked[j : j + 1], 4, floor)
            assert [(r, s) for _, r, s, _ in again] == want
        assert less[0] <= entries[j]
    assert (entries <= n * width).all() and entries[-1] == 0
    assert no_random_access(rows[:0], ids[:0], queries, asked, 4)[0] == []


def test_a_floor_above_all_rows_ends_reading_at_once():
    rows = np.floor(np.random.default_rng(1).exponential(5, (1000, 2)))
    got, entries = no_random_access(rows, np.arange(1000), np.array([[1.0, 2.0]]), np.array([-1]), 3, np.array([1e6]))
    assert got == [] and entries[0] < 200
