"""Language identification by prediction by partial matching (PPM) over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.samples import per_class
from orderflow.llm.worker_memory import small_batches

#: Documents of each language that the trees are counted from.
TRAIN_DOCS = 400
#: Bytes scored at a time.
SLICE = 1 << 19
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


class Order(NamedTuple):
    """The contexts of one length of a language's tree, and what follows them, as sorted arrays.

    ``seen`` are contexts with one byte more, ``counts`` log2 of how often they came. ``contexts`` have ``escape`` (bits to go
    on to the next shorter context when the byte is new) and ``whole`` (log2 of the weight that counts are shares of) for
    a context that is entered without exclusions. ``escape_below`` and ``whole_below`` hold for the next shorter
    context when it is entered from here, the bytes seen here being left out.
    """

    seen: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray
    whole: np.ndarray
    escape_below: np.ndarray
    whole_below: np.ndarray


def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``asked`` in sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


class Tree(NamedTuple):
    """A language's contexts of 3, 2, 1 and 0 bytes; ``rest`` is log2 of the number of bytes it never saw."""

    orders: tuple[Order, ...]
    rest: float

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each four-byte gram after the three before it."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        spent = np.zeros(len(grams))
        above = np.zeros(len(grams), bool)  # whether the longer context was known, at ``place`` there
        place = np.zeros(len(grams), np.int64)
        longer: Order | None = None
        for order, length in zip(self.orders, (3, 2, 1, 0)):
            gram = grams[left] & np.uint32((1 << 8 * (length + 1)) - 1)
            at, known = _find(order.contexts, gram >> np.uint32(8))
            whole, escape = order.whole[at], order.escape[at]
            if longer is not None:
                whole = np.where(above, longer.whole_below[place], whole)
                escape = np.where(above, longer.escape_below[place], escape)
            found, hit = _find(order.seen, gram)
            out[left[hit]] = spent[hit] + whole[hit] - order.counts[found[hit]]
            miss = ~hit
            spent = (spent + np.where(known, escape, 0.0))[miss]
            left, above, place, longer = left[miss], known[miss], at[miss], order
        out[left] = spent + self.rest
        return out


class PpmModel:
    """The trees of all languages. Their size is that of the grams they were counted from."""

    def __init__(self, languages: list[str], trees: list[Tree]):
        self.languages, self.trees = languages, trees

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): the whole code length of each text; three line feeds stand before it.

        Each different gram of a slice is looked up once.
        """
        total = np.zeros((len(texts), len(self.languages)))
        held: list[tuple[int, np.ndarray]] = []
        held_size = 0

        def flush() -> None:
            grams, which = np.unique(np.concatenate([part for _, part in held]), return_inverse=True)
            text = np.repeat([n for n, _ in held], [len(part) for _, part in held])
            for k, tree in enumerate(self.trees):
                total[:, k] += np.bincount(text, tree.bits(grams)[which], len(texts))
            held.clear()

        for n, text in enumerate(texts):
            for begin in range(0, len(text), SLICE):
                before = b"\n\n\n" if not begin else text[begin - 3 : begin] if begin >= 3 else (b"\n\n\n" + text[:begin])[-3:]
                held.append((n, _grams(before + text[begin : begin + SLICE])))
                held_size += len(held[-1][1])
                if held_size >= SLICE:
                    flush()
                    held_size = 0
        if held:
            flush()
        return total


def _grams(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    return (b[:-3] << np.uint32(24)) | (b[1:-2] << np.uint32(16)) | (b[2:-1] << np.uint32(8)) | b[3:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four-byte grams of each text with their counts; three line feeds stand before the text."""
    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            grams, counts = np.unique(_grams(b"\n\n\n" + text.encode("utf-8", "replace")), return_counts=True)
            if len(grams):
                columns = [pa.array([language] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, ["language", "gram", "n"])


def _log2(values: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(values, 1.0)).astype(np.float32)


def _tree(grams: np.ndarray, n: np.ndarray) -> Tree:
    """The tree of one language's grams, each there once.

    Escape method C with exclusion: a context of T symbols, U of them different, gives n / (T + U) to each it has
    seen, and U / (T + U) to the next shorter context, where those are left out. All that a longer context has seen
    the shorter one has seen too, so what is left of the shorter one depends on the longer one alone. Below the empty
    context all bytes left share the rest evenly. A context that is not known, or has nothing left, costs nothing.
    """
    levels = []
    for length in (3, 2, 1, 0):
        seen, where = np.unique(grams & np.uint32((1 << 8 * (length + 1)) - 1), return_inverse=True)
        counts = np.bincount(where, n, len(seen))
        contexts, of = np.unique(seen >> np.uint32(8), return_inverse=True)
        levels.append((seen, counts, contexts, of, np.bincount(of, counts, len(contexts)), np.bincount(of, minlength=len(contexts))))
    orders = []
    for at, (seen, counts, contexts, of, totals, kinds) in enumerate(levels):
        escape_below = whole_below = np.zeros(len(contexts), np.float32)
        if at < 3:
            shorter = levels[at + 1]
            mask = np.uint32((1 << 8 * (3 - at)) - 1)
            same = np.searchsorted(shorter[0], seen & mask)
            below = np.searchsorted(shorter[2], contexts & (mask >> np.uint32(8)))
            total = shorter[4][below] - np.bincount(of, shorter[1][same], len(contexts))
            kind = shorter[5][below] - kinds
            whole_below = _log2(total + kind)
            escape_below = np.where(kind > 0, whole_below - _log2(kind), 0).astype(np.float32)
        whole = _log2(totals + kinds)
        orders.append(Order(seen, _log2(counts), contexts, whole - _log2(kinds), whole, escape_below, whole_below))
    return Tree(tuple(orders), float(np.log2(max(1, 256 - len(levels[3][0])))))


def build(grams: pd.DataFrame) -> PpmModel:
    """The model of counted grams (``language``, ``gram``, ``n``)."""
    languages = sorted(grams["language"].unique())
    parts = (grams[grams["language"] == language] for language in languages)
    return PpmModel(languages, [_tree(own["gram"].to_numpy().astype(np.uint32), own["n"].to_numpy(float)) for own in parts])


def fit(
    docs: DataFrame,
    *,
    train_docs: int = TRAIN_DOCS,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    held_out: Column | None = None,
) -> PpmModel:
    """Trees of each language from ``train_docs`` of its documents at most (by the hash of their ids), whole texts.

    Rows that are ``held_out``, and those with a null id, text or language, teach nothing. Without any row there
    are no languages, and every text is ``und``.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(language_column).cast("string").alias("language"),
        F.col(text_column).cast("string").alias("text"),
        (F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))).alias("held"),
    ).where("id IS NOT NULL AND language IS NOT NULL AND text IS NOT NULL AND NOT held")
    chosen = per_class(rows.select("id", "language").distinct(), "language", train_docs)
    # At most train_docs ids of each language.
    texts = rows.join(F.broadcast(chosen), ["id", "language"], "left_semi").select("language", "text")
    counted = texts.mapInArrow(_count, "language string, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))
    # Grams of the sample only: their number is bounded with it, and repeats are summed before.
    return build(counted.orderBy("language", "gram").toPandas())


def predictions(spark, model: PpmModel):
    """A column function: text to struct(lang_pred, score, bits_per_byte)."""
    small_batches(spark)
    # Plain arrays: as large as the grams of the sample, whose documents are bounded for each language.
    shared = spark.sparkContext.broadcast((model.languages, [([tuple(o) for o in t.orders], t.rest) for t in model.trees]))

    @F.pandas_udf("lang_pred string, score double, bits_per_byte double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, trees = shared.value
        ppm = PpmModel(languages, [Tree(tuple(Order(*o) for o in orders), rest) for orders, rest in trees])
        for texts in batches:
            known = [n for n, t in enumerate(texts) if languages and t is not None and _LETTER.search(t)]
            out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "bits_per_byte": np.nan}, index=range(len(texts)))
            if known:
                coded = [texts.iloc[n].encode("utf-8", "replace") for n in known]
                lengths = ppm.lengths(coded)
                best = lengths.argmin(axis=1)
                least = lengths.min(axis=1)
                out.loc[known, "lang_pred"] = [languages[b] for b in best]
                out.loc[known, "score"] = 1 / np.exp2(-np.minimum(lengths - least[:, None], 1000)).sum(axis=1)
                out.loc[known, "bits_per_byte"] = least / [len(c) for c in coded]
            yield out

    return predict


def has_letter():
    """A column function: whether a text has a letter; false for null."""

    @F.pandas_udf("boolean")
    def lettered(texts: pd.Series) -> pd.Series:
        return pd.Series([t is not None and _LETTER.search(t) is not None for t in texts], dtype=bool)

    return lettered


def language_id(
    docs: DataFrame, model: PpmModel, *, id_column: str = "doc_id", text_column: str = "text", held_out: Column | None = None
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score``, ``bits_per_byte``.

    The language whose trees give the whole text the shortest code; of equal ones the first by name. ``score`` is
    its posterior at equal priors, computed from the exact code lengths. ``und`` with score 0 (and null
    bits) if the text is null or has no letter, or no language was learned. A null id stays null and isn't held
    out; repeated rows give repeated rows; an empty table gives none; other columns are not read. Long texts are
    scored in slices that continue each other.
    """
    predict = predictions(docs.sparkSession, model)
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), held.alias("held"), predict(F.col(text_column).cast("string")).alias("p"))
    bits = F.when(~F.isnan("p.bits_per_byte"), F.col("p.bits_per_byte"))
    return rows.select(F.col("id").alias(id_column), F.col("held").alias("held_out"), "p.lang_pred", "p.score", bits.alias("bits_per_byte"))
