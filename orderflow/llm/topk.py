"""Exact top-k by inner product, from sorted lists read in step (no random access)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.session import staged

#: Vectors and queries that meet in one task at a time, and queries that read their lists together there.
CHUNK, BLOCK, BATCH = 4096, 4096, 64
#: Rows that are looked at before all bounds of a depth are worked out.
PROBE = 128
#: Shares of the lists to which is read before each test of the bounds; the last reads all.
DEPTHS = (1 / 16, 1 / 4, 1 / 2, 3 / 4, 1.0)


class Lists:
    """Each component of the rows as a list, sorted by value. Values are only ever taken from it in slices, in order."""

    def __init__(self, rows: np.ndarray):
        components = np.ascontiguousarray(rows.T)
        self.order = np.argsort(components, axis=1, kind="stable")
        self.values = np.take_along_axis(components, self.order, axis=1)

    def read(self, component: int, begin: int, end: int, from_top: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of the entries number ``begin`` to ``end``, counted from the top or from the bottom."""
        n = self.values.shape[1]
        part = slice(n - end, n - begin) if from_top else slice(begin, end)
        return self.order[component, part], self.values[component, part]


def _search(lists: Lists, row_ids: np.ndarray, weights: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, k: int):
    """Yields (query, places of its best rows, their scores, entries read) for a batch of queries."""
    width, n = lists.values.shape
    asked = np.arange(len(weights))
    least, most = lists.values[:, :1], lists.values[:, -1:]
    # From the top for positive weights, from the bottom for negative ones: weights, what each row has shown or can still
    # show at best, what it can show at worst, and whether it is still to be shown (a line for each list).
    ends = [
        (True, np.maximum(weights, 0), np.repeat(most, n, axis=1), least, np.ones((width, n), bool)),
        (False, np.minimum(weights, 0), np.repeat(least, n, axis=1), most, np.ones((width, n), bool)),
    ]
    can_qualify = query_ids[:, None] != row_ids
    entries = np.zeros(len(asked), np.int64)
    needed = [parts != 0 for _, parts, *_ in ends]
    at = 0
    for share in DEPTHS:
        depth = min(n, int(np.ceil(n * share)))
        if depth == at:
            continue
        for (from_top, _, best, _, hidden), need in zip(ends, needed):
            for d in np.flatnonzero(need.any(axis=0)):
                places, values = lists.read(d, at, depth, from_top)
                best[d, places] = values
                hidden[d, places] = False
                best[d, hidden[d]] = values[0 if from_top else -1]
            entries += (depth - at) * need.sum(axis=1)
        at = depth

        live = np.flatnonzero(can_qualify.any(axis=0))
        enough = max(k, n // 8)
        if depth < n and np.isfinite(floors).all() and (can_qualify.sum(axis=1) > enough).all():
            # Where all queries have many rows left and the bounds leave each of some rows in, the test is put off.
            some = live[:: len(live) // PROBE + 1]
            if (sum(parts @ best[:, some] for _, parts, best, *_ in ends) >= floors[:, None]).all():
                continue
        upper = sum(parts @ best[:, live] for _, parts, best, *_ in ends)
        bar = floors
        if len(live) > k and np.isneginf(floors).any():
            lower = sum(parts @ np.where(hidden[:, live], worst, best[:, live]) for _, parts, best, worst, hidden in ends)
            lower[~can_qualify[:, live]] = -np.inf
            bar = np.maximum(floors, np.partition(lower, len(live) - k, axis=1)[:, len(live) - k])
        can_qualify[:, live] &= upper >= bar[:, None]

        # A list is read on while it hasn't shown some row that can qualify. A query is done when it needs no list: no
        # outsider can qualify, and the bounds of the rows that can are their scores.
        done = np.full(len(asked), depth == n)
        few = np.flatnonzero(can_qualify.sum(axis=1) <= enough) if depth < n else ()
        if len(few):
            rows = np.flatnonzero(can_qualify[few].any(axis=0))
            open_rows = can_qualify[np.ix_(few, rows)].astype(np.float32)
            for need, (_, parts, _, _, hidden) in zip(needed, ends):
                need[few] = (open_rows @ hidden[:, rows].T.astype(np.float32) > 0) & (parts[few] != 0)
            done[few] = ~(needed[0][few].any(axis=1) | needed[1][few].any(axis=1))
        for j in np.flatnonzero(done):
            places = np.flatnonzero(can_qualify[j, live])
            first = places[np.lexsort((row_ids[live[places]], -upper[j, places]))[:k]]
            yield int(asked[j]), live[first], upper[j, first], int(entries[j])
        if done.all():
            return
        if done.any():
            stay = ~done
            ends = [(from_top, parts[stay], *others) for from_top, parts, *others in ends]
            needed = [need[stay] for need in needed]
            can_qualify, asked, floors, entries = can_qualify[stay], asked[stay], floors[stay], entries[stay]


def no_random_access(
    rows: np.ndarray, row_ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, floors: np.ndarray | None = None
):
    """(number of the query, place of the row, score, rank from 0) of the k best rows of each query, and the entries read by each.

    Each component is a list of the rows, sorted by value, read from the top by queries that have a positive
    weight there and from the bottom by the others; a list of weight 0 isn't read. What a row has shown so far, plus the
    best (least) that the unread parts can add, bounds its score from above (below). Rows whose upper bound is under
    the k-th best lower bound, or under the query's floor (where it has one), are out. A list is left when it has shown every row
    that can qualify; once that is so for all lists, the sums of these rows are their scores, and none is looked up. Ties go to
    the smaller row id. A floor is a score that k rows elsewhere are known to reach.
    """
    found: list[tuple[int, int, float, int]] = []
    entries = np.zeros(len(queries), np.int64)
    floors = np.full(len(queries), -np.inf) if floors is None else floors
    if not len(rows):
        return found, entries
    lists = Lists(rows)
    for begin in range(0, len(queries), BATCH):
        part = slice(begin, begin + BATCH)
        for j, best, scores, read in _search(lists, row_ids, queries[part], query_ids[part], floors[part], k):
            entries[begin + j] = read
            found += [(begin + j, int(place), float(s), r) for r, (place, s) in enumerate(zip(best, scores))]
    return found, entries


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of whole numbers as a matrix; shorter ones are padded with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), max(1, int(lengths.max(initial=0)))), np.float64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


_MET = pa.schema([("query_id", pa.int64()), ("row_id", pa.int64()), ("score", pa.int64()), ("variant", pa.int64())])


def _meeting(k: int):
    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _MET.empty_table()
        a, b = _matrix(left["v"]), _matrix(right["v"])
        width = max(a.shape[1], b.shape[1])
        a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
        row_ids, query_ids, variants = left["id"].to_numpy(), right["id"].to_numpy(), right["variant"].to_numpy()
        floors = right["floor"].to_numpy().astype(float)
        found, _ = no_random_access(a, row_ids, b, query_ids, k, floors)
        if not found:
            return _MET.empty_table()
        query, place, score, _ = (np.array(c) for c in zip(*found))
        columns = (query_ids[query], row_ids[place], score.astype(np.int64), variants[query])
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=_MET)

    return meet


def top_k_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 64,
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the id and the ``score`` of the ``k`` best rows of each query row.

    Components become floor(``scale`` * x); scores are integer inner products, exact as long as they stay below
    2^53. Rows and queries are dealt by hash into chunks and blocks of bounded size; each pair of them meets in
    one task. The queries meet one chunk first: their k-th score there is a floor that k rows reach, so in the other
    chunks reading ends as soon as no further row can reach it, and only rows that do are returned. A ranked merge
    keeps the best. No row is passed over: bounds only save reading.

    Vectors that are null, or hold a null or a component that isn't finite, and rows without an id take no part.
    Shorter vectors count as padded with zeros (an empty one scores 0). A query skips all rows with its own id.
    Repeated rows are candidates each; a query that is repeated with the same vector is asked once. Ties go to the
    smaller id. An empty table gives no rows; other columns are not read.
    """
    finite = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector_column, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    usable = vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & finite)
    rows = usable.select(F.col(id_column).cast("long").alias("id"), whole.alias("v"))
    asked = usable.where(is_query).select(F.col(id_column).cast("long").alias("id"), whole.alias("v")).dropDuplicates()
    n_rows, n_asked = rows.count(), asked.count()
    chunks, blocks = max(1, -(-n_rows // chunk)), max(1, -(-n_asked // block))

    spread = rows.select(
        "id",
        "v",
        F.pmod(F.xxhash64("id", "v"), F.lit(chunks)).cast("int").alias("c"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"),
    )
    posed = asked.select(
        "id", "v", F.xxhash64("v").alias("variant"), F.pmod(F.xxhash64("v", "id"), F.lit(blocks)).cast("int").alias("b")
    )

    def met(rows: DataFrame, queries: DataFrame) -> DataFrame:
        grouped = rows.groupBy("c", "b").cogroup(queries.groupBy("c", "b"))
        return grouped.applyInArrow(_meeting(k), "query_id long, row_id long, score long, variant long")

    no_floor = F.lit(float("-inf"))
    found = met(spread.where("c = 0"), posed.select("*", F.lit(0).alias("c"), no_floor.alias("floor")))
    if chunks > 1:
        found = staged(found, "topk-first")
        full = F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double"))
        floors = found.groupBy(F.col("query_id").alias("id"), "variant").agg(full.alias("floor"))
        later = F.explode(F.sequence(F.lit(1), F.lit(chunks - 1))).alias("c")
        known = posed.join(floors, ["id", "variant"], "left").withColumn("floor", F.coalesce("floor", no_floor))
        found = found.unionByName(met(spread.where("c > 0"), known.select("*", later)))
    place = F.row_number().over(Window.partitionBy("query_id", "variant").orderBy(F.desc("score"), "row_id"))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("row_id").alias(id_column), "score")
