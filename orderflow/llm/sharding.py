"""Shards of even size from groups that stay together: best-fit decreasing over bounded summaries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.session import staged

#: Small groups are dealt by hash into so many cells; the driver sees cells, never groups or rows.
CELLS = 1 << 15
#: A group of more than 1/GRAIN of a shard is placed by itself, in pieces of about that size.
GRAIN = 64


class Node(NamedTuple):
    """An AVL tree of (room, bin); never changed, only rebuilt along a path."""

    key: tuple[int, int]
    left: Node | None
    right: Node | None
    height: int


def _height(node: Node | None) -> int:
    return node.height if node else 0


def _node(key, left, right) -> Node:
    """Joins two trees whose heights differ by two at most."""
    lean = _height(left) - _height(right)
    if lean > 1:
        if _height(left.left) < _height(left.right):
            inner = left.right
            left = _plain(inner.key, _plain(left.key, left.left, inner.left), inner.right)
        return _plain(left.key, left.left, _plain(key, left.right, right))
    if lean < -1:
        if _height(right.right) < _height(right.left):
            inner = right.left
            right = _plain(inner.key, inner.left, _plain(right.key, inner.right, right.right))
        return _plain(right.key, _plain(key, left, right.left), right.right)
    return _plain(key, left, right)


def _plain(key, left, right) -> Node:
    return Node(key, left, right, 1 + max(_height(left), _height(right)))


def _with(node: Node | None, key) -> Node:
    if node is None:
        return Node(key, None, None, 1)
    if key < node.key:
        return _node(node.key, _with(node.left, key), node.right)
    return _node(node.key, node.left, _with(node.right, key))


def _without(node: Node, key) -> Node | None:
    if key < node.key:
        return _node(node.key, _without(node.left, key), node.right)
    if key > node.key:
        return _node(node.key, node.left, _without(node.right, key))
    if node.left is None or node.right is None:
        return node.left or node.right
    least = node.right
    while least.left:
        least = least.left
    return _node(least.key, node.left, _without(node.right, least.key))


def _tightest(node: Node | None, size: int) -> tuple[int, int] | None:
    """The least (room, bin) with room for ``size``."""
    best = None
    while node:
        if node.key >= (size, -1):
            best, node = node.key, node.left
        else:
            node = node.right
    return best


def best_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[int]:
    """The bin of each item: the largest first, each into the tightest bin that has room, else a new one.

    Equal sizes keep their order; an item beyond the capacity gets a bin of its own.
    """
    bins = [0] * len(sizes)
    tree: Node | None = None
    opened = 0
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = _tightest(tree, sizes[item])
        if found is None:
            room, at, opened = capacity, opened, opened + 1
        else:
            room, at = found
            tree = _without(tree, found)
        bins[item] = at
        if room > sizes[item]:
            tree = _with(tree, (room - sizes[item], at))
    return bins


def even_bins(sizes: Sequence[int], count: int) -> list[int]:
    """The bins of ``best_fit_decreasing`` at about the least capacity at which ``count`` bins hold all items.

    Items that are larger than an even share get a bin each, and the others share what is left.
    """
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    rest, alone = sum(sizes), 0
    while alone < min(count - 1, len(order)) and sizes[order[alone]] * (count - alone) > rest:
        rest -= sizes[order[alone]]
        alone += 1
    bins = [0] * len(sizes)
    for at, item in enumerate(order[:alone]):
        bins[item] = at
    others = [sizes[i] for i in order[alone:]]
    share = -(-rest // (count - alone))
    extra = 0
    while True:
        found = best_fit_decreasing(others, share + extra)
        if max(found, default=0) < count - alone:
            break
        extra = max(1, share >> 14) if not extra else 2 * extra
    for item, at in zip(order[alone:], found):
        bins[item] = alone + at
    return bins


def shard_documents(
    docs: DataFrame, shards: int = 40, *, id_column: str = "doc_id", text_column: str = "text", cells: int = CELLS
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Sizes (UTF-8 bytes plus 16) of the shards are near equal (law ``bytes``); rows of equal texts share a shard.
    Only a group larger than a whole shard is divided, as no shard could hold it. Groups meet the driver in
    bounded summaries: hash cells of small groups, and the at most ``shards * GRAIN`` groups that are large. Slots
    are counted within cells (large groups are many cells) and shifted by the cells before, so no task sorts a
    shard.

    A null text has no bytes and shares the group of empty texts; a null id stays null; repeated rows each get a
    slot of their own; an empty table gives no rows; shards may stay empty if there are fewer groups; other columns
    are not read.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = staged(
        docs.select(
            F.col(id_column).cast("long").alias("id"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.xxhash64(text).alias("key"),
        ),
        "shard-rows",
    )
    spark = rows.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 0
    grain = max(1, total // (shards * GRAIN))

    cell = F.pmod("key", F.lit(cells)).cast("int")
    heavy = rows.groupBy(cell.alias("cell")).agg(F.sum("size").alias("s")).where(F.col("s") > grain).select("cell")
    inside = rows.withColumn("cell", cell).join(F.broadcast(heavy), "cell", "left_semi")
    # At most shards * GRAIN cells and groups can be that large.
    large = inside.groupBy("key").agg(F.sum("size").alias("s")).where(F.col("s") > grain).orderBy("key").collect()
    first, starts = cells, []
    for key, size in large:
        parts = -(-size // grain)
        starts.append((key, first, parts))
        first += parts
    known = spark.createDataFrame(starts, "key long, first int, parts int")
    own_cell = F.coalesce(F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")), cell).cast("int")
    placed = rows.join(F.broadcast(known), "key", "left").withColumn("cell", own_cell).drop("first", "parts")
    summary = {r.cell: r for r in placed.groupBy("cell").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).collect()}

    groups: list[list[int]] = [[c] for c in sorted(summary) if c < cells]
    share = -(-total // shards)
    for _, begin, parts in starts:
        own = [c for c in range(begin, begin + parts) if c in summary]
        whole = sum(summary[c].s for c in own) <= share
        groups += [own] if whole else [[c] for c in own]
    bins = even_bins([sum(summary[c].s for c in g) for g in groups], shards)
    offsets = [0] * shards
    table = []
    for group, at in zip(groups, bins):
        for c in group:
            table.append((c, at, offsets[at]))
            offsets[at] += summary[c].n
    of_cell = spark.createDataFrame(table, "cell int, shard int, before long")
    in_cell = F.row_number().over(Window.partitionBy("cell").orderBy("id", "key"))
    return (
        placed.withColumn("place", in_cell)
        .join(F.broadcast(of_cell), "cell")
        .select(
            F.col("id").alias(id_column),
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("before") + F.col("place") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
