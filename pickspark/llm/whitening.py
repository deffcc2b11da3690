"""Whitening of embeddings by a bidiagonal qd solver.

Rows are centred exactly (``n * x - S`` in whole numbers) and reduced by QR, block by block: a task keeps one
triangle, triangles of many tasks are stacked and reduced again in rounds of ``FAN_IN``. The last one, of the vectors'
width, is made bidiagonal by Householder reflections; dqds gives its singular values to high relative accuracy, and
twisted factorisations of the shifted matrix give each one's vector. No covariance is formed, so small
components do not drown in the rounding of large ones.

Edge cases: rows whose vector is null, empty or holds null or non-finite entries are left out; so are vectors of another
width than the most frequent one (of equally frequent ones the larger); repeated rows count each; a null id
stays; components without variance have null ``whitened``; with no rows left the result is empty; a deviation beyond
a long is null; other columns are not read. Widths over ``MOST_WIDTH`` raise: the driver holds one triangle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Entries become whole numbers: floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Triangles that one task stacks in a round, and the widest vectors (a triangle of 32 MB).
FAN_IN, MOST_WIDTH = 64, 2048
#: Values of a block that is reduced at a time.
BLOCK_VALUES = 1 << 20
#: Neighbouring eigenvalues closer than this part of the larger one share a cluster.
CLUSTER = 1e-3
EPS = np.finfo(float).eps
#: Squares of off-diagonal entries below this part of the values are none.
NEGLIGIBLE = (4 * EPS) ** 2


# -- the bidiagonal solver --------------------------------------------------------------------------------------------


def reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """``v``, ``tau``, ``beta`` with ``(I - tau v v') x = beta e1``."""
    norm = float(np.linalg.norm(x))
    if norm == 0 or not x[1:].any():
        return np.zeros(len(x)), 0.0, float(x[0])
    beta = -math.copysign(norm, x[0])
    v = x / (x[0] - beta)
    v[0] = 1.0
    return v, (beta - x[0]) / beta, beta


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal ``a``, superdiagonal ``b`` and orthogonal ``v`` with ``r = u B v'``."""
    m, d = r.copy(), len(r)
    v = np.eye(d)
    for k in range(d):
        h, tau, _ = reflector(m[k:, k])
        m[k:, k:] -= tau * np.outer(h, h @ m[k:, k:])
        if k < d - 2:
            h, tau, _ = reflector(m[k, k + 1 :])
            m[k:, k + 1 :] -= tau * np.outer(m[k:, k + 1 :] @ h, h)
            v[:, k + 1 :] -= tau * np.outer(v[:, k + 1 :] @ h, h)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the bidiagonal matrix with diagonal ``a`` and superdiagonal ``b``."""
    found: list[float] = []
    parts = [(np.square(a).tolist(), np.square(b).tolist(), 0.0)]
    while parts:
        q, e, shift = parts.pop()
        steps = 0
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + shift)
                break
            # Negligible off-diagonals end the last value, or split the matrix.
            if e[-1] <= NEGLIGIBLE * (shift + q[-1]):
                found.append(q.pop() + shift)
                e.pop()
                continue
            split = next((i for i in range(n - 2, -1, -1) if e[i] <= NEGLIGIBLE * (shift + min(q[i], q[i + 1]))), None)
            if split is not None:
                parts.append((q[: split + 1], e[:split], shift))
                q, e = q[split + 1 :], e[split + 1 :]
                continue
            # The shift stays below the smallest value; where rounding has made it too large it is tried smaller.
            bound = lower_bound(q, e)
            for s in (bound, bound * (1 - 1e-6), bound / 2, 0.0):
                if (step := transformed(q, e, s)) is not None:
                    q, e = step
                    shift += s
                    break
            steps += 1
            if steps > 200 * len(a):
                raise ArithmeticError("dqds does not converge")
    return np.sort(np.maximum(np.array(found), 0.0))[::-1]


def lower_bound(q: list[float], e: list[float]) -> float:
    """One over the trace of the inverse: below the smallest eigenvalue, near it if the others are far (Newton's step)."""
    d, total = q[0], 0.0
    for i in range(len(q)):
        if d <= 0:
            return 0.0
        total += 1 / d
        if i < len(e):
            d = d * (q[i + 1] / (d + e[i]))
    return 1 / total


def transformed(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float]] | None:
    """One differential quotient-difference step with shift ``s``; none if the shift was too large."""
    d = q[0] - s
    new_q, new_e = [], []
    for i in range(len(e)):
        if d < 0:
            return None
        x = d + e[i]
        if x == 0:
            new_q.append(0.0)
            new_e.append(0.0)
            d = q[i + 1] - s
            continue
        new_q.append(x)
        ratio = q[i + 1] / x
        new_e.append(e[i] * ratio)
        d = d * ratio - s
    if d < 0:
        return None
    return [*new_q, d], new_e


def twisted(a: np.ndarray, b: np.ndarray, value: float, at: int | None = None) -> np.ndarray:
    """The vector of ``B'B`` for an eigenvalue, from the factorisation twisted at ``at`` or where it is nearest to
    singular: stationary qd from the top, progressive qd from the bottom."""
    n = len(a)
    if n == 1:
        return np.ones(1)
    diag = np.square(a) + np.concatenate([[0.0], np.square(b)])
    off = a[:-1] * b
    tiny = EPS * EPS * float(diag.max()) + np.finfo(float).tiny
    q, e = np.square(a), np.square(b)
    # Differential forms: s and p carry the shift, so that nothing cancels in q and e.
    s = np.zeros(n)
    top = np.zeros(n)  # pivots from the top
    s[0] = -value
    for i in range(n):
        top[i] = s[i] + q[i]
        if abs(top[i]) < tiny:
            top[i] = -tiny
        if i + 1 < n:
            s[i + 1] = e[i] * (s[i] / top[i]) - value
    p = np.zeros(n)
    low = np.zeros(n)  # pivots from the bottom
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        low[i + 1] = e[i] + p[i + 1]
        if abs(low[i + 1]) < tiny:
            low[i + 1] = -tiny
        p[i] = p[i + 1] * (q[i] / low[i + 1]) - value
    gamma = np.abs(s + p + value)
    k = int(np.argmin(gamma)) if at is None else at
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -off[i] / top[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -off[i] / low[i + 1] * z[i]
    return z / np.linalg.norm(z)


def singular_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, most: int) -> np.ndarray:
    """Right singular vectors, as columns, of the first ``most`` of the falling squared singular ``values``. Within a
    cluster, vectors are made orthogonal to those before them, from different twists where they are too alike."""
    n = len(a)
    out = np.zeros((n, most))
    first = 0
    product = lambda z: np.concatenate([a[:1] * z[:1], a[1:] * z[1:]]) + np.concatenate([b * z[1:], [0.0]])  # noqa: E731  B z
    for j in range(most):
        if j and values[j - 1] - values[j] > CLUSTER * values[j - 1]:
            first = j
        z = twisted(a, b, values[j])
        starts = iter(np.argsort(np.abs(np.arange(n) - n // 2), kind="stable").tolist())
        while first < j:
            before = out[:, first:j]
            for _ in range(2):
                z = z - before @ (before.T @ z)
            size = np.linalg.norm(z)
            if size > 1e-3:
                z /= size
                # What orthogonalising has left of other vectors goes by inverse iteration with the same factors.
                break
            k = next(starts, None)
            if k is None:
                raise ArithmeticError("a cluster of singular values has too few vectors")
            z = twisted(a, b, values[j] * (1 - 4 * EPS * (1 + j - first)), k)
        out[:, j] = z
    # A Rayleigh-Ritz step inside each cluster.
    j = 0
    while j < most:
        end = j + 1
        while end < most and values[end - 1] - values[end] <= CLUSTER * values[end - 1]:
            end += 1
        if end - j > 1:
            basis, _ = np.linalg.qr(out[:, j:end])
            image = np.stack([product(z) for z in basis.T], 1)
            _, _, turn = np.linalg.svd(image, full_matrices=False)
            out[:, j:end] = basis @ turn.T
        j = end
    return out


@dataclass
class Directions:
    """Mean and whitening directions: eigenvalues ``values`` (falling, of the covariance) and their vectors (columns)."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        scale = np.where(self.values > 0, np.sqrt(np.maximum(self.values, np.finfo(float).tiny)), np.nan)
        return (self.n * x - self.sums) / self.n @ self.vectors / scale


def solved(r: np.ndarray, n: int, sums: np.ndarray, most: int) -> Directions:
    """Directions from the triangle of the centred rows."""
    d = len(r)
    scale = float(np.abs(r).max()) or 1.0
    a, b, v = bidiagonalised(r / scale)
    values = dqds(a, b)
    values[values <= (d * EPS) ** 2 * values[0]] = 0.0
    most = min(most, d)
    real = int((values[:most] > 0).sum())
    vectors = np.zeros((d, most))
    vectors[:, :real] = v @ singular_vectors(a, b, values, real)
    return Directions(n, sums, values[:most] * scale**2 / n, vectors, float(np.square(r).sum()) / n)


# -- over Spark -------------------------------------------------------------------------------------------------------


def whole(part: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers; vectors are as wide as ``width`` and finite."""
    c = np.asarray(part.flatten(), np.float64).reshape(-1, width)
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    step = max(1, BLOCK_VALUES // max(width, 1))
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            yield part.column("id"), whole(part.column("vector"), width)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector`` of the rows with a vector of finite entries."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~F.coalesce(bad, F.lit(False)))


def sums_of(rows: DataFrame, width: int) -> np.ndarray:
    """Sums of the whole numbers by dimension: a row of partial sums a task, added by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for _, x in blocks(batches, width):
            total += x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total)], names=["at", "total"])

    added = rows.mapInArrow(run, "at int, total long").groupBy("at").agg(F.sum("total").alias("total"))
    found = {r["at"]: r["total"] for r in added.collect()}  # one row a dimension
    return np.array([found.get(i, 0) for i in range(width)], np.int64)


def triangle(rows: DataFrame, n: int, sums: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The triangle of all centred rows, by rounds of stacked QR."""
    width = len(sums)

    def emit(r: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.astype("<f8").tobytes()], pa.binary())], names=["r"])

    def reduced(held: np.ndarray | None, block: np.ndarray) -> np.ndarray:
        stacked = block if held is None else np.vstack([held, block])
        r = np.linalg.qr(stacked, mode="r")
        return r if len(r) == width else np.vstack([r, np.zeros((width - len(r), width))])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for _, x in blocks(batches, width):
            r = reduced(r, (n * x - sums) / n)
        yield from emit(r)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for one in batch.column("r").to_pylist():
                r = reduced(r, np.frombuffer(one, "<f8").reshape(width, width))
        yield from emit(r)

    made = scratch.put(rows.mapInArrow(first, "r binary"), "triangles")
    count = made.count()
    while count > FAN_IN:
        made = scratch.put(made.repartition(-(-count // FAN_IN)).mapInArrow(again, "r binary"), "triangles")
        count = made.count()
    r = None
    for row in made.toLocalIterator():  # FAN_IN triangles at most, one at a time
        r = reduced(r, np.frombuffer(row["r"], "<f8").reshape(width, width))
    return r


def identity_error(rows: DataFrame, found: Directions) -> float | None:
    """The largest absolute entry of the covariance of the whitened rows minus the identity."""
    width, k = len(found.sums), int((found.values > 0).sum())
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean, n = np.zeros((k, k)), np.zeros(k), 0
        for _, x in blocks(batches, width):
            w = found.whiten(x)[:, :k]
            own = w.mean(0)
            apart = own - mean
            total += (w - own).T @ (w - own) + np.outer(apart, apart) * n * len(w) / (n + len(w))
            mean += apart * len(w) / (n + len(w))
            n += len(w)
        at = np.arange(k * k)
        # Means of tasks are joined as sums: the whitened rows are centred already, so nothing cancels here.
        cross = total + n * np.outer(mean, mean)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(cross.ravel()), pa.array(np.repeat(n * mean, k)), pa.array(np.tile(n * mean, k))], names=["at", "cross", "x", "y"])

    added = rows.mapInArrow(run, "at int, cross double, x double, y double").groupBy("at").agg(F.sum("cross").alias("cross"), F.sum("x").alias("x"), F.sum("y").alias("y"))
    n, worst = found.n, 0.0
    for r in added.collect():  # one row a pair of components
        own = r["cross"] / n - (r["x"] / n) * (r["y"] / n)
        worst = max(worst, abs(own - (1.0 if r["at"] // k == r["at"] % k else 0.0)))
    return worst


def directions(rows: DataFrame, most: int = 8) -> Directions | None:
    """Fit on all of ``rows`` (``usable``, of one width)."""
    widths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not widths:
        return None
    width, n = widths[0]["width"], widths[0]["count"]
    if width > MOST_WIDTH:
        raise ValueError(f"vectors of {width} entries; at most {MOST_WIDTH}")
    same = rows.where(F.size("vector") == width)
    sums = sums_of(same, width)
    scratch = Scratch(rows.sparkSession, "whitening")
    r = triangle(same, n, sums, scratch)
    scratch.drop_all_but()
    return solved(r, n, sums, most)


OUT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 8) -> DataFrame:
    """A row for each usable vector and component up to ``most``."""
    rows = usable(df, id_col, vector_col)
    found = directions(rows, most)
    named = OUT.replace("id long", f"`{id_col}` long", 1)
    if found is None:
        return df.sparkSession.createDataFrame([], named)
    width, k = len(found.sums), len(found.values)
    same = rows.where(F.size("vector") == width)
    error = identity_error(same, found)
    explained = [v / found.trace if found.trace else None for v in found.values.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in blocks(batches, width):
            w = found.whiten(x)
            apart = found.n * x - found.sums
            sizes = np.square(apart.astype(float)).sum(1)
            exact = np.square(apart).sum(1)  # modulo 2**64 where it is too large
            deviation = pa.array(exact, mask=sizes >= 2.0**63)
            at = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [
                ids.cast(pa.int64()).take(at),
                pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(x) * k, found.n)),
                deviation.take(at),
                pa.array(w.ravel(), mask=np.isnan(w.ravel())),
                pa.array(explained * len(x), pa.float64()),
                pa.array([error] * (len(x) * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return same.mapInArrow(run, named)
