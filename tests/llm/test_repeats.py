"""Removal of repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm.queries import LLM_QUERIES
from orderflow.llm.repeats import merged, remove_repeats

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, length=100):
    """{(id, text): kept bytes and number of spans}; windows in order of id (null first) and place."""
    seen, out = set(), {}
    for i, text in sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = True
            seen.add(window)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[i, text] = (len(data), len(data) - len(kept), int(np.sum(np.diff(gone.astype(int), prepend=0) == 1)), kept)
    return out


def made():
    rng = random.Random(7)
    words = ["alpha", "bravo", "où", "данные", "漢字", "x", "lorem\n", "\x00", "ipsum dolor"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))
    passage, other = text(40), text(25)
    rows = [(i, text(rng.randrange(1, 60))) for i in range(20, 60)]
    rows += [(i, text(5) + passage + text(5)) for i in range(100, 130)]
    rows += [(i, text(3) + passage[rng.randrange(9):-7] + other + text(2)) for i in range(130, 150)]
    rows += [(200 + i, rows[3][1]) for i in range(10)] + [(1, "a" * 9000), (2, "ab" * 300 + "a" * 150), (3, "a" * 99), (4, "a" * 100)]
    rows += [(5, None), (6, ""), (None, passage), (7, passage * 3), (500, rows[0][1] + rows[1][1])]
    return rows


@pytest.mark.parametrize("batch,hot", [(8 << 20, 1 << 14), (900, 1 << 14), (900, 3)])
def test_repeats_are_removed(spark, batch, hot):
    rows = made()
    again = rows + [rows[45], rows[-2]]  # repeated rows: one document, its result twice
    docs = spark.createDataFrame(again, "doc_id long, text string").withColumn("batch", F.lit("clash")).repartition(4)
    got = remove_repeats(docs, batch=batch, hot=hot).collect()
    want = brute(rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(
        (str(i), *want[i, t or ""]) for i, t in again
    )
    texts = {i: (t or "").encode() for i, t in rows}
    for r in got:
        cut = bytearray(texts[r.doc_id])
        for a, b in reversed(r.spans):
            del cut[a:b]
        assert bytes(cut) == bytes(r.kept)


def test_documents_of_one_id(spark):
    text = "".join(random.Random(2).choices("abcdefgh", k=150))
    docs = spark.createDataFrame([(1, text + "!"), (1, "?" + text), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in remove_repeats(docs).collect())
    assert got == [(1, 0), (1, 150), (2, 150)]
    assert remove_repeats(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(docs, 20)


@pytest.mark.parametrize("seed", range(5))
def test_merged_transforms_against_sorted_suffixes(seed):
    rng = np.random.default_rng(seed)
    shards = [np.append(rng.integers(1, 4, rng.integers(1, 200)), 0).astype(np.uint8) for _ in range(4)]
    shards.append(shards[0])
    length = 6
    at, offset = {}, 0
    for s in shards:
        for i in range(len(s)):
            at[offset + i] = np.resize(np.roll(s, -i), length).tobytes()
        offset += len(s)
    chosen = rng.random(offset) < 0.7
    places, block = merged(shards, length, chosen)
    whole: dict = {}
    for i in np.flatnonzero(chosen).tolist():
        whole.setdefault(at[i], []).append(i)
    groups: dict = {}
    for p, b in zip(places.tolist(), block.tolist()):
        groups.setdefault(b, []).append(p)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(v) for v in whole.values() if len(v) > 1)


def test_query_on_the_given_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows)
    got = LLM_QUERIES["op11_repeats"](spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(
        (i, *want[i, t or ""][:3], hashlib.sha256(want[i, t or ""][3]).hexdigest()) for i, t in rows
    )
    assert sum(r.n_removed for r in got) > 0
