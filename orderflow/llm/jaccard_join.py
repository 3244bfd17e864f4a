"""Near-duplicate join on word shingles: MinHash banding and exact verification.

Documents with the same shingles are one class. Each class has a signature of ``TREES`` times ``DEPTH`` minima, of
which the first few of each tree are its key there; classes that share a key are candidates. How many is worked out
from the target recall at the threshold, before any data are seen: this is banding of a fixed depth, no LSH forest.
Candidates that a sketch doesn't rule out form loose groups, whose shingles meet in blocks of bounded size
and are compared exactly. Links are counted there and never leave as pairs.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.components import components
from orderflow.llm.worker_memory import remembered
from orderflow.operators.skew import fits_broadcast
from orderflow.session import staged

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 24, 8
RECALL = 0.9999
#: Minima (a byte each) of the sketch, and the share of equal ones under which a pair is ruled out: five standard
#: deviations under the threshold, so that some four links in a million at the threshold are lost to it.
SKETCH, SKETCH_SHARE = 64, 0.55
#: Members of a shared prefix that are compared by sketch; larger ones are joined without.
CROWD = 256
#: Classes of a loose group that are compared in one task; larger groups are cut into pairs of such blocks.
BLOCK = 512
#: Words whose hashes a worker remembers.
MEMO = 300_000

_WORD = re.compile(r"\w+")
_rng = np.random.default_rng(20)
_POWERS = _rng.integers(1, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(0, 1 << 63, TREES * DEPTH, np.uint64)
_TIMES = _rng.integers(1, 1 << 63, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = _rng.integers(1, 1 << 63, DEPTH + 1, np.uint64) * np.uint64(2) + np.uint64(1)


def prefix_depth(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix that finds a pair at the threshold in some tree with at least the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(29))


def shingles(text: str) -> np.ndarray:
    """The sorted distinct 64-bit hashes of each ``WORDS`` words in a row, in lower case.

    A text of fewer words has one shingle, all of them; one without words has none.
    """
    words = _WORD.findall(text.lower())
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    known = remembered(("word hashes",), _WordHashes)
    if len(known) > MEMO:
        known.clear()
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    if n < WORDS:
        return _mixed((hashes * _POWERS[:n]).sum(keepdims=True) + np.uint64(n))
    rows = hashes[: n - WORDS + 1] * _POWERS[0]
    for j in range(1, WORDS):
        rows = rows + hashes[j : n - WORDS + 1 + j] * _POWERS[j]
    return np.unique(_mixed(rows))


def signature(own: np.ndarray) -> np.ndarray:
    """The minima of a set of hashes, as (trees, depth) 32-bit numbers."""
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(own), 512):
        values = (own[begin : begin + 512, None] ^ _XOR) * _TIMES
        np.minimum(least, values.min(axis=0), out=least)
    return (least >> np.uint64(32)).reshape(TREES, DEPTH)


def prefix_keys(minima: np.ndarray, depth: int) -> np.ndarray:
    """A 64-bit number for each tree and its prefix."""
    folded = (minima[:, :depth] * _FOLD[:depth]).sum(axis=1) + np.arange(TREES, dtype=np.uint64) * _FOLD[DEPTH]
    return _mixed(folded).view(np.int64)


def class_of(own: np.ndarray, text: str) -> bytes:
    """128 bits that are equal for equal sets; texts without words are classes by themselves, if not equal."""
    data = own.tobytes() if len(own) else b"text" + text.encode("utf-8", "replace")
    return hashlib.blake2b(data, digest_size=16).digest()


def _signed(depth: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[bytes, tuple[np.ndarray, bytes]] = {}
        for batch in batches:
            classes, keys, sketches = [], [], []
            for value in batch.column(2):
                text = value.as_py()
                own = shingles(text)
                name = class_of(own, text)
                if name not in recent:
                    if len(recent) > 4096:
                        recent.clear()
                    if len(own):
                        minima = signature(own)
                        low = (minima.ravel()[:: TREES * DEPTH // SKETCH][:SKETCH] & np.uint64(255)).astype(np.uint8)
                        recent[name] = prefix_keys(minima, depth), low.tobytes()
                    else:
                        recent[name] = np.zeros(0, np.int64), b""
                classes.append(name)
                keys.append(recent[name][0])
                sketches.append(recent[name][1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(classes, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["id", "digest", "cls", "keys", "sketch"],
            )

    return sign


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the first row of its component."""
    roots = np.arange(len(linked))
    while True:
        near = np.where(linked, roots[None, :], len(roots)).min(axis=1, initial=len(roots))
        lower = np.minimum(roots, near)
        lower = lower[lower]
        if (lower == roots).all():
            return roots
        roots = lower


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (member, first member of its part) of prefixes, whose rows come one after the other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table["key"].to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))  # the last prefix may go on in the next batch
        held = table.slice(last).to_batches()
        yield from _edges(table.slice(0, last))
    if held:
        yield from _edges(pa.Table.from_batches(held))


def _edges(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    table = table.combine_chunks()
    keys = table["key"].to_numpy()
    names = table["cls"].to_pylist()
    sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
    starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    sizes = np.diff(starts, append=len(keys))
    a, b = [], []
    twos = starts[sizes == 2]
    alike = (sketches[twos] == sketches[twos + 1]).mean(axis=1) >= SKETCH_SHARE
    for n in twos[alike].tolist():
        a.append(names[n + 1])
        b.append(names[n])
    for begin, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        own = sketches[begin : begin + size]
        roots = _roots((own[:, None] == own[None]).mean(axis=2) >= SKETCH_SHARE)
        for n in np.flatnonzero(roots != np.arange(size)).tolist():
            a.append(names[begin + n])
            b.append(names[begin + int(roots[n])])
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t).tobytes() for t in batch.column(batch.num_columns - 1).to_pylist()]
        columns = [batch.column(n) for n in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], [*batch.schema.names[:-1], "shingles"])


def common(sets: list[np.ndarray], width: int = 1 << 13) -> np.ndarray:
    """The number of hashes that each two sets share."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    terms, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1  # a hash of one owner can't be common
    column = np.where(count > 1, shared, -1)[place]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n))
    for begin in range(0, int(shared[-1]) + 1 if len(shared) else 0, width):
        low, high = np.searchsorted(column, (begin, begin + width))
        dense = np.zeros((n, min(width, int(shared[-1]) + 1 - begin)), np.float32)
        dense[owner[low:high], column[low:high] - begin] = 1
        out += dense @ dense.T
    return out


def _verified(threshold: float):
    def verify(key, table):
        """Links of each class within the block (or between the two blocks), and the first class of its part."""
        _, left, right = (k.as_py() for k in key)
        names = table["cls"].to_pylist()
        first = {name: n for n, name in reversed(list(enumerate(names)))}  # rows may be repeated
        at = sorted(first.values(), key=lambda n: names[n])
        names = [names[n] for n in at]
        blocks = table["block"].to_numpy()[at]
        data = table["shingles"]
        sets = [np.frombuffer(data[n].as_py(), np.uint64) for n in at]
        sizes = np.array([len(s) for s in sets], float)
        shared = common(sets)
        linked = shared >= threshold * (sizes[:, None] + sizes[None] - shared) - 1e-9
        np.fill_diagonal(linked, False)
        if left != right:
            linked &= blocks[:, None] != blocks[None]
        roots = _roots(linked)
        rows = [names, [names[r] for r in roots], linked.sum(axis=1).tolist()]
        types = (pa.binary(), pa.binary(), pa.int64())
        return pa.table({name: pa.array(c, t) for name, c, t in zip(("cls", "root", "links"), rows, types)})

    return verify


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def near_duplicates(
    docs: DataFrame,
    *,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    id_column: str = "doc_id",
    text_column: str = "text",
    crowd: int = CROWD,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: id, ``digest`` (of its text), ``class_id``, ``copy_id``, ``n_copies``,
    ``n_links`` and ``stays`` (true for the row, or its repetitions, that stands for the class).

    Texts are linked if the Jaccard similarity of their sets of five-word shingles reaches ``threshold``.
    ``class_id`` is the least id of all documents that links connect, ``copy_id`` that of the documents with the same
    set, of which there are ``n_copies``; ``n_links`` counts the other sets that the document is linked to. Every link
    that is returned is exact; a link is missed with a chance of at most 1 - ``recall`` (plus the sketch's, see
    ``SKETCH``).

    A null text is empty. Texts without words are alike only if they are equal. Texts of one to four words have one
    shingle, all their words. Rows with a null id take part; an id is null only where no row of the class has one.
    Repeated rows are copies. An empty table gives no rows; other columns are not read.
    """
    narrow = docs.select(F.col(id_column).cast("long").alias("id"), _text(text_column).alias("text"))
    narrow = narrow.select("id", F.xxhash64("text").alias("digest"), "text")
    columns = "id long, digest long, cls binary, keys array<long>, sketch binary"
    signed = staged(narrow.mapInArrow(_signed(prefix_depth(threshold, recall)), columns), "jaccard-rows")

    # One row for each class: a copy of its signature, and the row that stands for it.
    classes = staged(
        signed.groupBy("cls").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("first"),
            F.any_value("keys").alias("keys"),
            F.any_value("sketch").alias("sketch"),
        ),
        "jaccard-classes",
    )
    placed = classes.select("cls", F.explode("keys").alias("key"))
    crowds = staged(
        placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("least")).where("n > 1"), "jaccard-crowds"
    )
    met = staged(placed.join(crowds, "key").select("key", "cls", "n", "least"), "jaccard-met")
    few = met.where(F.col("n") <= crowd).select("key", "cls").join(classes.select("cls", "sketch"), "cls")
    by_sketch = few.repartition("key").sortWithinPartitions("key").mapInArrow(_similar, "a binary, b binary")
    many = met.where(F.col("n") > crowd).select(F.col("cls").alias("a"), F.col("least").alias("b"))
    loose = components(by_sketch.unionByName(many))

    sizes = loose.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    grouped = staged(loose.join(staged(sizes, "jaccard-sizes"), "label"), "jaccard-groups")
    wanted = (
        grouped.join(classes, grouped["node"] == classes["cls"])
        .select("cls", "label", "blocks", F.col("first.id").alias("first_id"), F.col("first.digest").alias("first_digest"))
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    )
    wanted = staged(wanted, "jaccard-wanted")
    chosen = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    texts = narrow.join(chosen, (narrow["digest"] == chosen["first_digest"]) & narrow["id"].eqNullSafe(chosen["first_id"]))
    sets = texts.select("cls", "label", "blocks", "block", "text").mapInArrow(
        _shingled, "cls binary, label binary, blocks int, block int, shingles binary"
    )
    # Each class meets every block of its group, its own included; most groups are one block.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = sets.select("cls", "label", "block", "shingles", other).select(
        "cls",
        "label",
        "block",
        "shingles",
        F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
    )
    linked = staged(
        pairs.groupBy("label", "left", "right").applyInArrow(_verified(threshold), "cls binary, root binary, links long"),
        "jaccard-links",
    )
    counts = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    parts = components(linked.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    labelled = (
        classes.select("cls", "copies", "first")
        .join(counts, "cls", "left")
        .join(parts.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("label", F.coalesce("label", "cls"))
    )
    least = labelled.groupBy("label").agg(F.min("first").alias("least"))
    known = labelled.join(least, "label").select(
        "cls",
        "least",
        F.col("first.id").alias("copy_id"),
        F.col("copies").alias("n_copies"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
    )
    rows = signed.select("id", "digest", "cls").join(staged(known, "jaccard-known"), "cls")
    return rows.select(
        F.col("id").alias(id_column),
        "digest",
        F.col("least.id").alias("class_id"),
        "copy_id",
        "n_copies",
        "n_links",
        (F.col("id").eqNullSafe(F.col("least.id")) & (F.col("digest") == F.col("least.digest"))).alias("stays"),
    )


def without_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the least id stays, with all its columns.

    If several rows have that id, it is one of those with the least hash of the text; in a class without ids, one
    of the rows with the least hash.
    """
    found = near_duplicates(docs, id_column=id_column, text_column=text_column, **options)
    found = found.select(F.col(id_column).alias("_id"), F.col("digest").alias("_digest"), "stays")
    found = staged(found.groupBy("_id", "_digest", "stays").count(), "jaccard-found")
    again = found.where("stays AND count > 1")

    def key(other: DataFrame) -> Column:
        same_text = F.xxhash64(_text(text_column)) == other["_digest"]
        return F.col(id_column).cast("long").eqNullSafe(other["_id"]) & same_text

    def sized(df: DataFrame) -> DataFrame:
        keys = df.select("_id", "_digest")
        return F.broadcast(keys) if fits_broadcast(keys) else keys

    once = docs.join(sized(found.where("NOT stays OR count > 1")), key(found), "left_anti")
    several = docs.join(sized(again), key(again), "left_semi").dropDuplicates([id_column, text_column])
    return once.unionByName(several)
