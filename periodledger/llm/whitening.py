"""Whitening of embeddings by an orthogonal route: blockwise QR, bidiagonal form, dqds, twisted factorisations.

Entries become whole numbers x = floor(64 c) + 1000000, so equal vectors, sums and deviations are exact. The fit list, each
distinct vector once, is made by a distinct aggregation on the packed numbers. Its centred rows are reduced block by block to
triangles (QR, each block stacked under the triangle so far); triangles are reduced again, ``FAN`` at a time, until one is
left. So the covariance is never formed and its small eigenvalues keep their accuracy. The last triangle is as wide as
the vectors, whatever the number of rows; the driver brings it to bidiagonal form with Householder reflections, finds the
singular values by the differential qd algorithm with shifts, and the directions by twisted factorisations of the
tridiagonal B'B. Close eigenvalues are separated by inverse iteration with orthogonalisation inside their cluster.

The shift of each dqds step is 1 / sum(1/d), d from the unshifted step before it: these are the diagonal of the inverse, so the
shift never passes the smallest eigenvalue, and nothing has to be taken back.

Defined results: rows whose vector is null, empty or holds null or non-finite entries are left out, and so are rows of another
length than the most frequent one among distinct vectors (the larger of equally frequent ones); entries beyond +-2^40 / 64 count as that bound, so that all sums are exact; repeated rows and null ids are kept;
components whose eigenvalue is within rounding of zero do not exist, so a table of equal vectors gives no rows; an empty table gives
none. Equal eigenvalues are numbered as they come. A deviation too large for a long is null. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize

# Fixed values of the number rule.
SCALE, OFFSET = 64, 1_000_000
LIMIT = 1 << 40
COMPONENTS = 16
BLOCK = 4096
FAN = 16
_EPS = np.finfo(float).eps
_TINY = 1e-290


def vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length: places of a batch's usable rows and their x - OFFSET."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(column.flatten().cast(pa.float64()), math.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = (sizes > 0) & (broken[ends] == broken[ends - sizes])
    for width in np.unique(sizes[good]).tolist():
        at = np.flatnonzero(good & (sizes == width))
        rows = values[((ends - sizes)[at])[:, None] + np.arange(width)]
        yield width, at, np.clip(np.floor(np.clip(rows, -1e300, 1e300) * SCALE), -LIMIT, LIMIT).astype(np.int64)


def _packed(rows: np.ndarray) -> pa.Array:
    """Each row as bytes: two a number where they suffice, else eight."""
    small = (np.abs(rows) < 1 << 15).all(1)
    out = np.empty(len(rows), object)
    for choice, kind in ((small, "<i2"), (~small, "<i8")):
        data = rows[choice].astype(kind)
        out[choice] = [r.tobytes() for r in data]
    return pa.array(out, pa.binary())


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    sizes = pc.binary_length(column).to_numpy()
    rows = np.empty((len(column), width), np.int64)
    for kind in ("<i2", "<i8"):
        choice = sizes == width * int(kind[2])
        rows[choice] = np.frombuffer(b"".join(column.filter(pa.array(choice)).to_pylist()), kind).reshape(-1, width)
    return rows


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for width, _, rows in vectors(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array([width] * len(rows), pa.int32()), _packed(rows)], names=["width", "x"])


def _sums(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
    for batch in batches:
        rows = _unpacked(batch.column(0), width)
        n += len(rows)
        high += (rows >> 20).sum(0)
        low += (rows & (1 << 20) - 1).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width)), pa.array([0, *high.tolist()]), pa.array([n, *low.tolist()])], names=["dim", "high", "low"])


@dataclass
class Centre:
    """Number of distinct vectors and the sums of their x - OFFSET, exact."""

    n: int
    sums: list[int]

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows: the whole part of the mean is taken off before anything is rounded."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exact; None beyond a long."""
        far = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums))
        if far * far * x.shape[1] < 1 << 63:
            off = x * self.n - np.array(self.sums, np.int64)
            return (off * off).sum(1).tolist()
        found = [sum((v * self.n - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in found]


def _stack(triangle: np.ndarray, rows: np.ndarray) -> np.ndarray:
    for a in range(0, len(rows), BLOCK):
        triangle = np.linalg.qr(np.vstack([triangle, rows[a:a + BLOCK]]), mode="r")
    return triangle


def _triangle_batch(triangle: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([triangle.astype("<f8").tobytes()], pa.binary())], names=["r"])


def _reduce(centre: Centre, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = len(centre.sums)
    triangle, any_rows = np.empty((0, width)), False
    for batch in batches:
        any_rows = any_rows or batch.num_rows > 0
        triangle = _stack(triangle, centre.rows(_unpacked(batch.column(0), width)))
    if any_rows:
        yield _triangle_batch(triangle)


def _again(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    triangle = np.empty((0, width))
    for batch in batches:
        for r in batch.column("r").to_pylist():
            triangle = _stack(triangle, np.frombuffer(r, "<f8").reshape(-1, width))
    if len(triangle):
        yield _triangle_batch(triangle)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right reflections V of R = U B V', by Householder."""
    a, n = r.copy(), r.shape[1]
    if len(a) < n:
        a = np.vstack([a, np.zeros((n - len(a), n))])
    v = np.eye(n)
    for k in range(n):
        h, scale = _reflection(a[k:, k])
        a[k:, k:] -= scale * np.outer(h, h @ a[k:, k:])
        if k < n - 2:
            h, scale = _reflection(a[k, k + 1:])
            a[k:, k + 1:] -= scale * np.outer(a[k:, k + 1:] @ h, h)
            v[:, k + 1:] -= scale * np.outer(v[:, k + 1:] @ h, h)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflection(x: np.ndarray) -> tuple[np.ndarray, float]:
    """h and s so that (I - s h h') x lies on the first axis."""
    size = float(np.max(np.abs(x), initial=0.0))
    if size == 0.0 or not np.any(x[1:]):
        return np.zeros(len(x)), 0.0
    h = x / size
    h[0] += math.copysign(float(np.linalg.norm(h)), h[0])
    return h, 2.0 / float(h @ h)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, largest first."""
    found: list[float] = []
    parts = [((diagonal**2).tolist(), (above**2).tolist(), 0.0)]
    while parts:
        q, e, shifted = parts.pop()
        while q:
            n = len(q)
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= _EPS * _EPS * (q[i] + shifted) or e[i] <= _EPS * _EPS * (q[i + 1] + shifted) or e[i] < _TINY), -1)
            if n == 1 or cut == n - 2:
                found.append(max(q.pop(), 0.0) + shifted)
                if e:
                    e.pop()
                continue
            if cut >= 0:  # two independent parts
                parts.append((q[:cut + 1], e[:cut], shifted))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            q, e, lowest = _qd_step(q, e, 0.0)
            shift = 0.0 if min(lowest) <= _TINY else (1.0 / math.fsum(1.0 / d for d in lowest)) * (1 - 8 * len(q) * _EPS)
            if shift > _EPS * shifted:
                moved, rest, lowest = _qd_step(q, e, shift)
                if min(lowest) >= 0.0:
                    q, e, shifted = moved, rest, shifted + shift
    return np.array(sorted(found, reverse=True))


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd transform; the intermediate d last."""
    d = q[0] - shift
    new_q, new_e, lowest = [], [], [d]
    for i in range(len(e)):
        top = d + e[i]
        ratio = q[i + 1] / top if top else 0.0
        new_q.append(top)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        lowest.append(d)
    return [*new_q, d], new_e, lowest


class Twisted:
    """B'B - lambda factored from both ends: solves with it, and gives its near-null vector."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        n = len(diagonal)
        # B'B = L D L' with D = a^2 and L = b / a.
        a = np.where(np.abs(diagonal) > 1e-150, diagonal, 1e-150)
        d, low = a * a, above / a[:-1]
        least = _EPS * _EPS * max(abs(value), 1e-300)
        self.down, self.up, self.size = np.empty(n - 1), np.empty(n - 1), n
        from_top, from_end = np.empty(n), np.empty(n)
        from_top[0] = -value
        for i in range(n - 1):
            pivot = from_top[i] + d[i]
            self.down[i] = d[i] * low[i] / (pivot if abs(pivot) > least else math.copysign(least, pivot))
            from_top[i + 1] = self.down[i] * low[i] * from_top[i] - value
        from_end[n - 1] = d[n - 1] - value
        for i in range(n - 2, -1, -1):
            pivot = d[i] * low[i] ** 2 + from_end[i + 1]
            ratio = d[i] / (pivot if abs(pivot) > least else math.copysign(least, pivot))
            self.up[i] = low[i] * ratio
            from_end[i] = from_end[i + 1] * ratio - value
        self.gamma = from_top + from_end + value

    def vector(self, twist: int | None = None) -> np.ndarray:
        k = int(np.argmin(np.abs(self.gamma))) if twist is None else twist
        z = np.zeros(self.size)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -self.down[i] * z[i + 1]
        for i in range(k, self.size - 1):
            z[i + 1] = -self.up[i] * z[i]
        return z / np.linalg.norm(z)


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Unit eigenvectors of B'B for the ``count`` largest values, as columns."""
    n = len(diagonal)
    if n == 1:
        return np.ones((1, 1))
    found: list[np.ndarray] = []
    start = 0
    while start < count:
        stop = start + 1
        while stop < n and values[stop - 1] - values[stop] <= 1e-7 * values[0]:
            stop += 1  # a cluster, with members beyond ``count`` too
        if stop - start == 1:
            found.append(Twisted(diagonal, above, float(values[start])).vector())
        else:
            found += _cluster(diagonal, above, values[start:stop])
        start = stop
    return np.stack(found[:count], 1)


def _cluster(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """An orthonormal basis of close eigenvalues' space, turned to the eigenvectors within it."""
    n = len(diagonal)
    tri = np.diag(diagonal**2) + np.diag(diagonal[:-1] * above, 1) + np.diag(diagonal[:-1] * above, -1)
    tri[np.arange(1, n), np.arange(1, n)] += above**2
    rng, basis = np.random.default_rng(1), np.empty((n, 0))
    for i, value in enumerate(values):
        factors = Twisted(diagonal, above, float(value))
        order = np.argsort(np.abs(factors.gamma))
        z = factors.vector(int(order[i % n]))
        for _ in range(4):
            z -= basis @ (basis.T @ z)
            z -= basis @ (basis.T @ z)
            if np.linalg.norm(z) < 1e-3:
                z = rng.normal(size=n)
                continue
            z /= np.linalg.norm(z)
            z = np.linalg.solve(tri - (value + 1e-14 * values[0] * (1 + i)) * np.eye(n), z)
            z /= np.linalg.norm(z)
        z -= basis @ (basis.T @ z)
        basis = np.column_stack([basis, z / np.linalg.norm(z)])
    basis = np.linalg.qr(basis)[0]
    turn = np.linalg.eigh(basis.T @ tri @ basis)[1][:, ::-1]
    return list((basis @ turn).T)


@dataclass
class Whitener:
    """What a vector's components need. ``explained``: each eigenvalue's share of the trace."""

    centre: Centre
    matrix: np.ndarray  # directions over the root of their eigenvalue, as columns
    eigenvalues: np.ndarray
    explained: np.ndarray


def fit(embeddings: DataFrame, components: int = COMPONENTS) -> tuple[Whitener | None, DataFrame]:
    """The whitening of a table's distinct vectors, and these vectors (packed, column x). None without any."""
    every = materialize(embeddings.select("embedding").mapInArrow(_pack, "width int, x binary").distinct(), "whitening-distinct")
    common = every.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    if common is None:
        return None, every.select("x")
    width = common["width"]
    distinct = every.where(F.col("width") == width).select("x")
    sums = distinct.mapInArrow(partial(_sums, width), "dim long, high long, low long").groupBy("dim").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    parts = {r["dim"]: (r["high"] << 20) + r["low"] for r in sums.collect()}  # one row a dimension
    centre = Centre(parts[-1], [parts[i] for i in range(width)])
    triangles = materialize(distinct.mapInArrow(partial(_reduce, centre), "r binary"), "whitening-triangles")
    left = triangles.count()
    while left > 1:
        left = math.ceil(left / FAN)
        triangles = materialize(triangles.repartition(left).mapInArrow(partial(_again, width), "r binary"), "whitening-triangles")
    last = np.frombuffer(triangles.first()["r"], "<f8").reshape(-1, width)
    diagonal, above, v = bidiagonal(last / math.sqrt(centre.n))
    values = dqds(diagonal, above)
    count = min(components, int((values > values[0] * (_EPS * width) ** 2 * 16).sum()) if values[0] > 0 else 0)
    z = v @ directions(diagonal, above, values, count) if count else np.empty((width, 0))
    return Whitener(centre, z / np.sqrt(values[:count]), values[:count], values[:count] / max(values.sum(), _TINY)), distinct


def _squares(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    w = shared.value
    width, k = w.matrix.shape
    total = np.zeros((k + 1, k + 1))
    for batch in batches:
        z = w.centre.rows(_unpacked(batch.column(0), width)) @ w.matrix
        z = np.column_stack([z, np.ones(len(z))])
        total += z.T @ z
    i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "s"])


def identity_error(whitener: Whitener, distinct: DataFrame) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, n = whitener.matrix.shape[1], whitener.centre.n
    if not k:
        return 0.0
    shared = distinct.sparkSession.sparkContext.broadcast(whitener)  # width x components numbers
    found = np.zeros((k + 1, k + 1))
    for r in distinct.mapInArrow(partial(_squares, shared), "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        found[r["i"], r["j"]] = r["s"] / n  # (components + 1)^2 rows
    covariance = found[:k, :k] - np.outer(found[:k, k], found[:k, k])
    return float(np.abs(covariance - np.eye(k)).max())


def _apply(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    w = shared.value
    for batch in batches:
        for width, at, x in vectors(batch.column(1)):
            if width == len(w.matrix):
                z = w.centre.rows(x) @ w.matrix
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(w.centre.deviations(x), pa.int64()), lists], names=["vec_id", "deviation", "whitened"])


def whiten(embeddings: DataFrame, whitener: Whitener) -> DataFrame:
    """vec_id, deviation and the list of whitened components of each usable row."""
    shared = embeddings.sparkSession.sparkContext.broadcast(whitener)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    return embeddings.select("vec_id", "embedding").mapInArrow(partial(_apply, shared), f"vec_id {kind}, deviation long, whitened array<double>")


def components(embeddings: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component."""
    whitener, distinct = fit(embeddings, count)
    if whitener is None or not len(whitener.eigenvalues):
        none = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}
        return embeddings.limit(0).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    error = identity_error(whitener, distinct)
    explained = F.array(*[F.lit(float(x)) for x in whitener.explained])
    rows = whiten(embeddings, whitener).select("vec_id", "deviation", F.posexplode("whitened").alias("_i", "whitened"))
    return rows.select("vec_id", (F.col("_i") + 1).cast("int").alias("component"), F.lit(whitener.centre.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(explained, F.col("_i")).alias("explained"), F.lit(error).alias("identity_error"))
