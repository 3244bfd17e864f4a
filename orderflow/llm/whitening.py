"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation over distributed rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.session import staged

#: Whole numbers up to here are exact as doubles; larger products are worked out with Python's integers.
_EXACT = 1 << 53
_LONG = (1 << 63) - 1
#: Scaled entries are held within this, so that sums with the shift stay longs.
_HUGE = float(1 << 62)


def _matrix(lists: pa.ListArray, width: int, fill: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``width``; shorter ones are filled up."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(lengths), width), fill, np.int64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class _Centring:
    """n * x - S of whole rows x, exact, and the same divided by n."""

    def __init__(self, n: int, sums: list[int], fill: int):
        self.n, self.sums, self.fill = n, sums, fill

    def exact(self, lists: pa.ListArray) -> np.ndarray:
        rows = _matrix(lists, len(self.sums), self.fill)
        top = max((abs(int(rows.min())), abs(int(rows.max()))), default=0) if rows.size else 0
        if self.n * top + max(map(abs, self.sums), default=0) < _EXACT:
            return rows * self.n - np.array(self.sums, np.int64)
        return rows.astype(object) * self.n - np.array(self.sums, object)

    def rows(self, lists: pa.ListArray) -> np.ndarray:
        return (self.exact(lists) / self.n).astype(np.float64)


def _summed(rows: DataFrame, part: Callable[[pa.ListArray], np.ndarray]) -> np.ndarray:
    """Sum over all batches of what ``part`` makes of each; one row per task goes to the shuffle."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(batch.column("x"))
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["values"])

    sums = rows.select("x").mapInArrow(partial, "values array<double>").select(F.posexplode("values").alias("at", "value"))
    found = sums.groupBy("at").agg(F.sum("value").alias("value")).collect()
    return np.array([r["value"] for r in sorted(found, key=lambda r: r["at"])])


def bidiagonalise(width: int, products: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float, np.ndarray]], scale: float):
    """(V, alphas, betas): A V = U B with B upper bidiagonal, V orthonormal and complete.

    ``products(W, q)`` gives (AW)'(Aq), |Aq|^2 and A'(Aq) in one pass over the rows of A. A left vector is never
    stored, as it is A w for a short w; it is made orthogonal to all earlier ones through w, and each right
    vector to all earlier ones directly (both twice where much is lost). All ``width`` steps are taken: a start
    vector sees one direction of a repeated value only, so a space that is used up is left by a new random vector.
    """
    rng = np.random.default_rng(0)
    v_all, w_all, g_all = (np.zeros((width, 0)) for _ in range(3))
    alphas: list[float] = []
    betas: list[float] = []

    def orthogonal(r: np.ndarray) -> np.ndarray:
        for _ in range(2):
            r = r - v_all @ (v_all.T @ r)
        return r

    v, beta = rng.normal(size=width), 0.0
    v /= np.linalg.norm(v)
    tiny = scale * width * np.finfo(float).eps
    for k in range(width):
        q = v - beta * w_all[:, -1] if k else v
        v_all = np.column_stack([v_all, v])
        while True:
            c, size, g = products(w_all, q)
            q, g, left = q - w_all @ c, g - g_all @ c, size - c @ c
            if left > 0.5 * size or size <= tiny * tiny:
                break
        alpha = float(np.sqrt(max(left, 0.0)))
        if alpha <= tiny:
            alpha, w, g = 0.0, np.zeros(width), np.zeros(width)
        else:
            w, g = q / alpha, g / alpha
        alphas.append(alpha)
        w_all, g_all = np.column_stack([w_all, w]), np.column_stack([g_all, g])
        if k + 1 == width:
            break
        r = orthogonal(g - alpha * v)
        beta = float(np.linalg.norm(r))
        if beta <= tiny:
            beta, r = 0.0, orthogonal(rng.normal(size=width))
            r = orthogonal(r / np.linalg.norm(r))
        betas.append(beta)
        v = r / np.linalg.norm(r)
    return v_all, np.array(alphas), np.array(betas)


def whiten(
    vectors: DataFrame,
    components: int = 32,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 64,
    shift: int = 1_000_000,
) -> DataFrame:
    """Whitened principal components: one row for each vector and component, the strongest first.

    Entries become x = floor(``scale`` * c) + ``shift`` (within 2^62). Returns the id, ``component`` (from 1), ``n`` (vectors),
    ``deviation`` (sum over dimensions of (n*x - S)^2, exact; null beyond a long), ``whitened``, ``explained`` (share of
    the total variance) and ``identity_error`` (largest entry by which the covariance of ``whitened`` departs from
    the identity). A component's largest loading is positive.

    Vectors that are null or hold a null or an entry that isn't finite take no part; shorter vectors count as padded
    with zeros. Rows are kept as often as they come, null ids too. Directions without variance (fewer distinct vectors
    than dimensions) have no unit scale and give no component: equal vectors, a single one and an empty table give no
    rows. Of equal variances any basis may come. Other columns are not read.

    Each of the steps, one for each dimension, is one pass over the rows and sums a few hundred numbers of each
    task in the shuffle; the driver holds matrices of dimension by dimension only.
    """

    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(_HUGE)), F.lit(-_HUGE))) + F.lit(shift).cast("long")

    finite = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    used = vectors.where(F.col(vector_column).isNotNull() & finite)
    rows = staged(used.select(F.col(id_column).cast("long").alias("id"), F.transform(vector_column, whole).alias("x")), "vectors")
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
    n, width = shape["n"], shape["width"] or 0
    summed = rows.select(F.posexplode("x").alias("at", "value")).groupBy("at")
    # Padding adds the shift of each absent entry.
    found = summed.agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    sums = [0] * width
    for r in found:
        sums[r["at"]] = int(r["s"]) + (n - r["n"]) * shift
    centring = _Centring(n, sums, shift)

    def products(w: np.ndarray, q: np.ndarray):
        def part(lists: pa.ListArray) -> np.ndarray:
            a = centring.rows(lists)
            p = a @ q
            return np.concatenate([(a @ w).T @ p, [p @ p], a.T @ p])

        got = _summed(rows, part)
        return got[: w.shape[1]], float(got[w.shape[1]]), got[w.shape[1] + 1 :]

    loadings, values, total, error = np.zeros((width, 0)), np.zeros(0), 0.0, 0.0
    if width:
        total = float(_summed(rows, lambda lists: np.array([np.square(centring.rows(lists)).sum()]))[0])
    if total > 0:
        right, alphas, betas = bidiagonalise(width, products, np.sqrt(total))
        _, sigma, turned = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        m = min(components, int(np.sum(sigma > sigma[0] * max(n, width) * np.finfo(float).eps)))
        loadings, values = right @ turned[:m].T, np.square(sigma[:m]) / n
        strongest = loadings[np.argmax(np.abs(loadings), axis=0), np.arange(m)]
        loadings = loadings * np.sign(strongest) / np.sqrt(values)

        def gram(lists: pa.ListArray) -> np.ndarray:
            z = centring.rows(lists) @ loadings
            return np.concatenate([(z.T @ z).ravel(), z.sum(axis=0)])

        got = _summed(rows, gram)
        mean = got[m * m :] / n
        error = float(np.abs(got[: m * m].reshape(m, m) / n - np.outer(mean, mean) - np.eye(m)).max())
    explained = (values / (total / n)).tolist() if total else []
    m = len(explained)
    schema = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows if m else 0, 4096):
                batch = whole_batch.slice(at, 4096)
                exact = centring.exact(batch.column("x"))
                fits = exact.dtype != object and int(np.abs(exact).max(initial=0)) ** 2 * width <= _LONG
                squares = np.square(exact).sum(axis=1) if fits else (exact.astype(object) ** 2).sum(axis=1)
                deviation = [s if s <= _LONG else None for s in map(int, squares)]
                z = (exact / n).astype(np.float64) @ loadings
                each = np.repeat(np.arange(batch.num_rows), m)
                yield pa.record_batch(
                    [
                        batch.column("id").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), batch.num_rows)),
                        pa.array(np.full(len(each), n, np.int64)),
                        pa.array(deviation, pa.int64()).take(pa.array(each)),
                        pa.array(z.ravel()),
                        pa.array(np.tile(np.array(explained), batch.num_rows)),
                        pa.array(np.full(len(each), error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, schema).withColumnRenamed("id", id_column)
