"""Language identification and toxicity: exact parts by brute force, the rest by held-out accuracy."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderflow.llm import language_id, toxicity
from orderflow.llm.queries import LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"


def grams(language, texts):
    counts: dict[int, int] = {}
    for text in texts:
        b = b"\n\n\n" + text.encode()
        for i in range(3, len(b)):
            counts[int.from_bytes(b[i - 3 : i + 1], "big")] = counts.get(int.from_bytes(b[i - 3 : i + 1], "big"), 0) + 1
    return pd.DataFrame({"language": language, "gram": list(counts), "n": list(counts.values())})


def brute_bits(texts, text):
    """Code length by prediction by partial matching, straight from the definition."""
    seen = [b"\n\n\n" + t.encode() for t in texts]
    data, bits = b"\n\n\n" + text.encode(), 0.0
    for i in range(3, len(data)):
        mass, excluded = 1.0, set()
        for order in (3, 2, 1, 0):
            context = data[i - order : i]
            counts: dict[int, int] = {}
            for s in seen:
                for j in range(3, len(s)):
                    if s[j - order : j] == context and s[j] not in excluded:
                        counts[s[j]] = counts.get(s[j], 0) + 1
            if not counts:
                continue
            whole = sum(counts.values()) + len(counts)
            if data[i] in counts:
                bits -= math.log2(mass * counts[data[i]] / whole)
                break
            mass *= len(counts) / whole
            excluded |= set(counts)
        else:
            bits -= math.log2(mass / (256 - len(excluded)))
    return bits


def test_code_lengths_are_exact():
    training = {"aa": ["banana bandana", "an apple"], "bb": ["ööö zug", "zu zäh"]}
    model = language_id.build(pd.concat([grams(k, v) for k, v in training.items()]))
    texts = ["banana", "zug an", "x\x00ñ漢", "", "bananaban" * 3]
    got = model.lengths([t.encode() for t in texts])
    for n, text in enumerate(texts):
        for k, language in enumerate(model.languages):
            assert got[n, k] == pytest.approx(brute_bits(training[language], text), rel=1e-4)


def test_long_texts_are_scored_in_slices(monkeypatch):
    model = language_id.build(grams("aa", ["banana bandana"]))
    whole = model.lengths([b"banana" * 50, b"", b"band"])
    monkeypatch.setattr(language_id, "SLICE", 7)
    assert np.allclose(model.lengths([b"banana" * 50, b"", b"band"]), whole)


@pytest.mark.parametrize("seed", range(4))
def test_code_lengths_of_random_bytes(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choices("ab é漢" if seed % 2 else "abcdefgh", k=n))
    training = {f"l{k}": [text(rng.randrange(1, 80)) for _ in range(4)] for k in range(40)}
    model = language_id.build(pd.concat([grams(k, v) for k, v in training.items()]))
    texts = [text(n) + extra for n, extra in ((60, ""), (20, "zz"), (1, "ß"))]
    got = model.lengths([t.encode() for t in texts])
    for n, t in enumerate(texts):
        for k in (0, 7, 39):
            assert got[n, k] == pytest.approx(brute_bits(training[model.languages[k]], t), rel=1e-4)
    # The trees are as large as what was seen.
    for tree, own in zip(model.trees, (training[k] for k in model.languages)):
        assert sum(len(o.seen) for o in tree.orders) <= 4 * sum(len(t.encode()) for t in own)


CASES = [(1, None), (2, ""), (3, "123 !?² ½ ①"), (4, "the words of this text"), (4, "the words of this text"), (None, "der Text hat Worte"), (5, "x" * 3000)]


def test_language_cases(spark):
    known = [(10 + i, t, lang) for i, (t, lang) in enumerate([("the words of this text", "en"), ("der Text und die Worte", "de")] * 5)]
    docs = spark.createDataFrame([*((i, t, None) for i, t in CASES), *known, (90, "skip", None), (None, "no id", "xx")], "doc_id long, text string, lang string")
    model = language_id.fit(docs, held_out=F.col("doc_id") == 10)
    assert model.languages == ["de", "en"]
    asked = spark.createDataFrame(CASES, "doc_id long, text string").withColumn("score", F.lit("clash"))
    rows = language_id.language_id(asked, model, held_out=F.col("doc_id") == 4).collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in rows if r.doc_id != 5) == [
        ("1", "und"), ("2", "und"), ("3", "und"), ("4", "en"), ("4", "en"), ("None", "de")
    ]
    assert all(0 <= r.score <= 1 and r.held_out == (r.doc_id == 4) for r in rows)
    nothing = language_id.fit(docs.where("false"))
    assert {r.lang_pred for r in language_id.language_id(asked, nothing).collect()} == {"und"}
    assert language_id.language_id(asked.where("false"), model).count() == 0


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = LLM_QUERIES["op6_language_id"](spark, SF_DIR).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def model_of(seed):
    rng = np.random.default_rng(seed)
    return toxicity.CrfModel(np.zeros(toxicity.BUCKETS), 0.0, rng.normal(size=2), rng.normal(size=(2, 2)))


@pytest.mark.parametrize("seed", range(3))
def test_marginals_against_all_paths(seed):
    model = model_of(seed)
    scores = np.random.default_rng(seed + 10).normal(size=(2, 6)) * 2
    mask = np.arange(6) < np.array([[6], [4]])
    toxic, pairs, log_z = toxicity.marginals(model, scores, mask)
    for n, length in enumerate((6, 4)):
        total, on = 0.0, np.zeros(length)
        for path in itertools.product((0, 1), repeat=length):
            weight = model.start[path[0]] + sum(scores[n, t] * y for t, y in enumerate(path))
            weight = math.exp(weight + sum(model.step[a, b] for a, b in zip(path, path[1:])))
            total += weight
            on += weight * np.array(path)
        assert np.allclose(toxic[n, :length], on / total) and (toxic[n, length:] == 0).all()
        assert log_z[n] == pytest.approx(math.log(total))
        assert np.allclose(pairs[n, : length - 1].sum(axis=(1, 2)), 1)


def labelled(n=240):
    rng = random.Random(2)
    plain = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 90))]
        bad = i % 4 == 0
        for _ in range(rng.randint(2, 4) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["nasty", "vileness", "vilest"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, b) for i, _, b in labelled()] + [(None, 1), (3, None), (10**6, 1)], "doc_id long, toxic int")
    return toxicity.fit(docs, labels, held_out=F.col("doc_id") % 5 == 0)


def test_toxicity_on_held_out_rows(spark, fitted):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled()], "doc_id long, text string")
    rows = {r.doc_id: r for r in toxicity.toxicity(docs, fitted, held_out=F.col("doc_id") % 5 == 0).collect()}
    held = [(rows[i], t, b) for i, t, b in labelled() if rows[i].held_out]
    assert len(held) == 48 and all(r.predicted == b for r, _, b in held)
    for row, text, bad in held:
        assert {text[s.start : s.end] for s in row.spans} <= {" ".join(c) for n in (1, 2, 3) for c in itertools.product(["nasty", "vileness", "vilest"], repeat=n)}


def test_toxicity_cases(spark, fitted):
    rows = [(1, None), (2, ""), (3, "..."), (4, "nasty nasty vilest word3"), (4, "nasty nasty vilest word3"), (None, "word1 word2"), (5, "word7 " * 30_000 + "İ vileness nasty")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = toxicity.toxicity(df, fitted).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and not r.held_out for r in got)
    assert sorted((str(r.doc_id), r.predicted) for r in got if r.doc_id != 5) == [("1", 0), ("2", 0), ("3", 0), ("4", 1), ("4", 1), ("None", 0)]
    assert len(next(r for r in got if r.doc_id == 5).spans) >= 1
    assert toxicity.toxicity(df.where("false"), fitted).count() == 0


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "nasty words")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.toxicity(docs, model).first().predicted == 0


def test_labels_that_are_held_out_teach_nothing(spark, fitted):
    # Held-out labels are turned round, and there are labels of ids without a document.
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled()], "doc_id long, text string")
    turned = [(i, 1 - b if i % 5 == 0 else b) for i, _, b in labelled()] + [(3, None)] + [(10**9 + i, 1) for i in range(500)]
    labels = spark.createDataFrame(turned, "doc_id long, toxic int")
    again = toxicity.fit(docs, labels, held_out=F.col("doc_id") % 5 == 0)
    assert np.allclose(again.document, fitted.document, atol=1e-6)


def test_repeated_ids_do_not_take_the_sample(spark):
    rows = [(1, "aaaa", "x")] * 50 + [(2, "bbbb", "x"), (3, "cccc", "x")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), train_docs=3)
    assert set(b"abc") <= set(model.trees[0].orders[3].seen.tolist())
