"""Toxic spans and document scores by a linear-chain conditional random field."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.samples import per_class
from orderflow.llm.worker_memory import small_batches

#: Labelled documents of each class that the model learns from, and windows of them that the field is fitted on.
TRAIN_DOCS = 6000
TRAIN_WINDOWS = 10_000
#: Tokens of a chain. Longer texts are several chains.
WINDOW = 64
#: Hash buckets of token features.
BUCKETS = 1 << 18
#: Evidence (log-likelihood ratio) and share of toxic uses from which a feature marks its tokens as toxic.
EVIDENCE, SHARE = 14.0, 0.9
#: Characters of the sample that are taken apart at a time.
SLICE_CHARS = 1 << 18
#: Words whose weight a worker remembers.
MEMO = 200_000
EPOCHS, RATE, DECAY = 12, 0.3, 1e-5

_TOKEN = re.compile(r"\w+")


def features(word: str) -> list[int]:
    """Buckets of the word and of its beginnings of three to six letters."""
    data = [b"=" + word.encode("utf-8", "replace")]
    data += [b"^%d" % n + word[:n].encode("utf-8", "replace") for n in (3, 4, 5, 6) if len(word) >= n]
    return [zlib.crc32(d) % BUCKETS for d in data]


class CrfModel(NamedTuple):
    """``weights`` of features for the toxic state; ``start`` and ``step`` (from, to) of the states clean, toxic.

    ``document`` are the weights of a document's summary (see ``summary``) and a constant.
    """

    weights: np.ndarray
    bias: float
    start: np.ndarray
    step: np.ndarray
    document: np.ndarray = np.array([1.0, 0.0, 0.0, 0.0])


def summary(chances: np.ndarray) -> tuple[float, float, float]:
    """Of the chances of a document's tokens: the log-odds of the highest, the expected number of toxic tokens
    (as log(1 + n)) and their share (as log(1 + 100 share)); those of a text without tokens are the least."""
    if not len(chances):
        return -12.0, 0.0, 0.0
    peak = min(max(float(chances.max()), 1e-6), 1 - 1e-6)
    mass = float(chances[chances >= 0.05].sum())
    return max(-12.0, math.log(peak / (1 - peak))), math.log1p(mass), math.log1p(100 * mass / len(chances))


def calibrated(summaries: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on the summaries (Newton steps, a small ridge)."""
    x = np.column_stack([summaries, np.ones(len(summaries))])
    w = np.array([0.5, 0.0, 0.0, 0.0])
    ridge = np.diag([1e-2, 1e-2, 1e-2, 1e-4]) * max(1.0, weight.sum() / 1000)
    for _ in range(40):
        chance = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (toxic - chance)) - ridge @ w
        hessian = (x * (weight * np.maximum(chance * (1 - chance), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        w = w + step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
    return w


def marginals(
    model: CrfModel, scores: np.ndarray, mask: np.ndarray, with_pairs: bool = True
) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Forward-backward over (chains, tokens) toxic scores; ``mask`` marks real tokens, which come first.

    Returns the chance that each token is toxic, the chances of each pair of states at its step (if asked for), and the
    logarithm of each chain's partition sum. Rows are normalised at each step, so nothing overflows.
    """
    chains, width = scores.shape
    emit = np.stack([np.zeros_like(scores), np.clip(scores, -40, 40)], axis=2)
    peak = emit.max(axis=2, keepdims=True)
    factor = np.exp(emit - peak)
    factor[~mask] = 1.0
    step = np.exp(model.step)
    forward = np.empty((chains, width, 2))
    log_z = np.where(mask, peak[:, :, 0], 0).sum(axis=1)
    state = np.exp(model.start)[None, :] * factor[:, 0]
    for t in range(width):
        if t:
            state = np.where(mask[:, t, None], (forward[:, t - 1] @ step) * factor[:, t], forward[:, t - 1])
        norm = state.sum(axis=1, keepdims=True)
        log_z += np.log(norm[:, 0])
        forward[:, t] = state / norm
    backward = np.ones((chains, width, 2))
    for t in range(width - 2, -1, -1):
        after = (backward[:, t + 1] * factor[:, t + 1]) @ step.T
        after /= after.sum(axis=1, keepdims=True)
        backward[:, t] = np.where(mask[:, t + 1, None], after, 1.0)
    both = forward * backward
    both /= both.sum(axis=2, keepdims=True)
    if not with_pairs:
        return both[:, :, 1] * mask, None, log_z
    pairs = forward[:, :-1, :, None] * step[None, None] * (factor * backward)[:, 1:, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    return both[:, :, 1] * mask, pairs * mask[:, 1:, None, None], log_z


class Windows(NamedTuple):
    """Labelled chains: features of window i are ``bucket[first[i]:first[i + 1]]``, at the tokens ``place`` says;
    ``label`` has WINDOW columns, of which the first ``size[i]`` are tokens."""

    first: np.ndarray
    bucket: np.ndarray
    place: np.ndarray
    label: np.ndarray
    size: np.ndarray


def windows_of(table: pa.Table) -> Windows:
    """From rows of (buckets, places, labels)."""
    table = table.combine_chunks()
    buckets, places, labels = (table[c].chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int32())) for c in table.column_names[:3])
    size = labels.value_lengths().to_numpy(zero_copy_only=False)
    label = np.zeros((len(size), WINDOW), np.float32)
    label[np.arange(WINDOW) < size[:, None]] = labels.flatten().to_numpy()
    first = np.concatenate([[0], np.cumsum(buckets.value_lengths().to_numpy(zero_copy_only=False))])
    return Windows(first, buckets.flatten().to_numpy(), places.flatten().to_numpy(), label, size)


def train(windows: Windows | None, epochs: int = EPOCHS) -> CrfModel:
    """Fits the field to labelled windows: exact gradients of the likelihood, AdaGrad steps."""
    model = CrfModel(np.zeros(BUCKETS), 0.0, np.zeros(2), np.zeros((2, 2)))
    if windows is None or not len(windows.size):
        return model._replace(bias=-20.0, document=np.array([1.0, 0.0, 0.0, -10.0]))
    rng = np.random.default_rng(0)
    weights, small = np.zeros(BUCKETS), np.array([-2.0, 0, 0, 0, 0, 0, 0])  # bias, start, step
    squares, small_squares = np.full(BUCKETS, 1e-2), np.full(7, 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(windows.size))
        for begin in range(0, len(order), 256):
            batch = order[begin : begin + 256]
            spans_ = [slice(windows.first[i], windows.first[i + 1]) for i in batch]
            bucket = np.concatenate([windows.bucket[s] for s in spans_])
            column = np.concatenate([windows.place[s] for s in spans_])
            row = np.repeat(np.arange(len(batch)), [s.stop - s.start for s in spans_])
            width = int(windows.size[batch].max())
            mask = np.arange(width) < windows.size[batch][:, None]
            gold = windows.label[batch, :width].astype(float)
            scores = np.full(mask.shape, small[0])
            np.add.at(scores, (row, column), weights[bucket])
            model = CrfModel(weights, small[0], small[1:3], small[3:].reshape(2, 2))
            toxic, pairs, _ = marginals(model, scores, mask)
            wrong = (gold - toxic) * mask
            gradient = np.bincount(bucket, weights=wrong[row, column], minlength=BUCKETS) / len(batch)
            states = np.stack([1 - gold, gold], axis=2)
            gold_pairs = states[:, :-1, :, None] * states[:, 1:, None, :]
            steps = ((gold_pairs - pairs) * mask[:, 1:, None, None]).sum(axis=(0, 1)).ravel()
            first = wrong[:, 0].sum()
            small_gradient = np.concatenate([[wrong.sum(), -first, first], steps]) / len(batch)
            gradient -= DECAY * weights
            squares += gradient**2
            weights = weights + RATE * gradient / np.sqrt(squares)
            small_squares += small_gradient**2
            small = small + RATE * small_gradient / np.sqrt(small_squares)
    return CrfModel(weights, float(small[0]), small[1:3], small[3:].reshape(2, 2))


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, digest of a word with its neighbours, toxic) of the tokens of the sample, repeats left out."""
    for batch in batches:
        texts, flags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for begin, end in _even(texts, SLICE_CHARS):
            codes: set[int] = set()
            for text, toxic in zip(texts[begin:end], flags[begin:end]):
                words = ["", *_TOKEN.findall(text.lower()), ""]
                for before, word, after in zip(words, words[1:], words[2:]):
                    use = zlib.crc32(f"{before} {word} {after}".encode("utf-8", "replace")) << 1 | toxic
                    codes.update([bucket << 33 | use for bucket in features(word)])
            code = np.fromiter(codes, np.int64, len(codes))
            columns = [pa.array((code >> 33).astype(np.int32)), pa.array(code >> 1 & 0xFFFFFFFF), pa.array((code & 1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "use", "toxic"])


def _windows(words: list[str]) -> Iterator[list[str]]:
    for begin in range(0, len(words), WINDOW):
        yield words[begin : begin + WINDOW]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    train_docs: int = TRAIN_DOCS,
    train_windows: int = TRAIN_WINDOWS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    held_out: Column | None = None,
) -> CrfModel:
    """Learns from labelled documents that aren't ``held_out``: ``train_docs`` of each class at most, by the hash of ids.

    Token labels come from the document labels: a token is toxic if it stands in a toxic document and its word, or
    a beginning of it, is used there far more often than in clean ones. Uses with the same neighbours count once, so
    the words of copied passages don't look toxic because one copy's document is. The field is then fitted on
    ``train_windows`` windows at most: those with a toxic token and as many others, by hash.

    Null ids, texts or labels teach nothing; of several labels of an id the highest holds. If a class is missing, the
    model finds nothing toxic.
    """
    marked = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("toxic"))
    marked = marked.where("id IS NOT NULL AND toxic IN (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    ids = docs.select(
        F.col(id_column).cast("long").alias("id"),
        (F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))).alias("held"),
    )
    taught = ids.where("NOT held").select("id").join(marked, "id").distinct()
    chosen = per_class(taught, "toxic", train_docs)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    # At most two times train_docs ids.
    sample = rows.where("text IS NOT NULL").join(F.broadcast(chosen), "id").select("id", "text", "toxic")
    texts = sample.select("text", "toxic")

    uses = texts.mapInArrow(_uses, "bucket int, use long, toxic int").distinct()
    counts = uses.groupBy("bucket").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).toPandas()
    bad, clean = counts["t"].to_numpy(float), counts["c"].to_numpy(float)
    if not bad.sum() or not clean.sum():
        return train(None)
    share = bad.sum() / (bad.sum() + clean.sum())
    every = bad + clean
    gain = bad * np.log(np.maximum(bad, 1e-9) / (every * share)) + clean * np.log(np.maximum(clean, 1e-9) / (every * (1 - share)))
    precise = (bad / bad.sum()) / (bad / bad.sum() + clean / clean.sum())
    toxic_buckets = frozenset(counts["bucket"].to_numpy()[(gain >= EVIDENCE) & (precise >= SHARE)].tolist())

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, flags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for begin, end in _even(whole, SLICE_CHARS):
                out: list[tuple[list[int], list[int], list[int], int, int]] = []
                for text, toxic in zip(whole[begin:end], flags[begin:end]):
                    for words in _windows(_TOKEN.findall(text.lower())):
                        own = [features(w) for w in words]
                        marks = [int(toxic == 1 and not toxic_buckets.isdisjoint(f)) for f in own]
                        places = [n for n, f in enumerate(own) for _ in f]
                        digest = zlib.crc32(" ".join(words).encode("utf-8", "replace"))
                        out.append(([b for f in own for b in f], places, marks, max(marks), digest))
                columns = list(zip(*out)) or [[]] * 5
                types = (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.int64())
                names = ["buckets", "places", "labels", "kind", "digest"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    kinds = "buckets array<int>, places array<int>, labels array<int>, kind int, digest long"
    labelled = texts.mapInArrow(label, kinds)
    half = train_windows // 2
    kept = [labelled.where(F.col("kind") == k).orderBy("digest").limit(half) for k in (1, 0)]
    model = train(windows_of(kept[0].unionAll(kept[1]).select("buckets", "places", "labels").toArrow()))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            rows = [summary(c) for begin, end in _even(texts) for c in scorer.token_chances(texts[begin:end])]
            values = [pa.array(c, pa.float64()) for c in zip(*rows)] or [pa.array([], pa.float64())] * 3
            yield pa.RecordBatch.from_arrays([*values, batch.column(1)], ["peak", "mass", "share", "toxic"])

    seen = texts.mapInArrow(summarise, "peak double, mass double, share double, toxic int").toPandas()
    flags = seen["toxic"].to_numpy(float)
    # The classes of the sample weigh as much as they are among all labelled documents that aren't held out.
    totals = {r.toxic: r.n for r in taught.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = np.where(flags == 1, totals[1] / max(1, flags.sum()), totals[0] / max(1, (1 - flags).sum()))
    weight *= len(weight) / weight.sum()
    return model._replace(document=calibrated(seen[["peak", "mass", "share"]].to_numpy(), flags, weight))


class Scorer:
    """Scores texts; words are weighed once and remembered."""

    def __init__(self, model: CrfModel):
        self._model = model
        self._known: dict[str, float] = {}

    def _weigh(self, words: list[list[str]]) -> np.ndarray:
        known = self._known
        if len(known) > MEMO:
            known.clear()
        for word in set().union(*words).difference(known):
            known[word] = float(self._model.weights[features(word)].sum()) + self._model.bias
        return np.concatenate([np.fromiter(map(known.__getitem__, own), np.float64, len(own)) for own in words])

    def token_chances(self, texts: list[str]) -> list[np.ndarray]:
        """The chance of each token of each text to be toxic."""
        words = [_TOKEN.findall(text.lower()) for text in texts]
        sizes = np.array([len(own) for own in words])
        if not sizes.sum():
            return [np.zeros(0) for _ in texts]
        weights = self._weigh(words)
        # Each text begins a chain of its own; all chains are padded to the same width.
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        within = np.arange(len(weights)) - np.repeat(starts, sizes)
        chains = -(-sizes // WINDOW)
        first = np.concatenate([[0], np.cumsum(chains)[:-1]])
        row, column = np.repeat(first, sizes) + within // WINDOW, within % WINDOW
        scores, mask = np.zeros((int(chains.sum()), WINDOW)), np.zeros((int(chains.sum()), WINDOW), bool)
        scores[row, column], mask[row, column] = weights, True
        toxic = self._chances(scores, mask)
        return np.split(toxic[row, column], np.cumsum(sizes)[:-1])

    def document(self, chances: np.ndarray) -> float:
        """The chance of a text to be toxic, from those of its tokens."""
        value = float(np.dot(self._model.document, [*summary(chances), 1.0]))
        return 1 / (1 + math.exp(-min(max(value, -30.0), 30.0)))

    def _chances(self, scores: np.ndarray, mask: np.ndarray, at_once: int = 2048) -> np.ndarray:
        parts = [
            marginals(self._model, scores[n : n + at_once], mask[n : n + at_once], False)[0] for n in range(0, len(scores), at_once)
        ]
        return np.concatenate(parts)


def spans(text: str, chances: np.ndarray) -> list[tuple[int, int]]:
    """Code-point offsets (start, end) of tokens that are toxic by more than even chance; neighbours are joined."""
    found: list[tuple[int, int]] = []
    matches = list(_TOKEN.finditer(text))
    if len(matches) != len(chances):  # lower case of a few letters is longer and may cut words otherwise
        matches = list(_TOKEN.finditer(text.lower()))
    last = -2
    for n in np.flatnonzero(chances >= 0.5):
        start, end = matches[n].span()
        if n == last + 1:
            found[-1] = (found[-1][0], end)
        else:
            found.append((start, end))
        last = int(n)
    return found


def scores(spark, model: CrfModel):
    """A column function: text to struct(score, spans)."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("score double, spans array<struct<start:int,end:int>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(CrfModel(*shared.value))
        for texts in batches:
            whole = [t or "" for t in texts]
            best, found = np.zeros(len(whole)), [[] for _ in whole]
            for begin, end in _even(whole):
                for n, chances in enumerate(scorer.token_chances(whole[begin:end]), begin):
                    best[n] = scorer.document(chances)
                    if len(chances) and chances.max() >= 0.5:
                        found[n] = [{"start": a, "end": b} for a, b in spans(whole[n], chances)]
            yield pd.DataFrame({"score": best, "spans": found})

    return score


def _even(texts: list[str], limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for n, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, n
            begin, size = n, 0
        size += len(text)
    yield begin, len(texts)


def toxicity(
    docs: DataFrame, model: CrfModel, *, id_column: str = "doc_id", text_column: str = "text", held_out: Column | None = None
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score``, ``predicted``, ``spans`` (code points, end exclusive).

    Forward-backward gives each token's chance to be toxic; the score of a text is a logistic function of the highest
    one, of their sum and of its share. Null and empty texts have no tokens and get the lowest summary. A null id stays null and isn't held out; repeated rows give repeated
    rows; an empty table gives none; other columns are not read. A long text is several chains, all of them scored.
    """
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    score = scores(docs.sparkSession, model)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), held.alias("held"), score(F.col(text_column).cast("string")).alias("s"))
    return rows.select(
        F.col("id").alias(id_column),
        F.col("held").alias("held_out"),
        "s.score",
        F.when(F.col("s.score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "s.spans",
    )
