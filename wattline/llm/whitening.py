"""Whitening of embeddings by singular values of the centred rows.

Blocks of centred rows are reduced to triangles by QR, triangles are stacked and reduced again until one is left: no
covariance is formed, so small directions keep their digits. The triangle is made bidiagonal by Householder
reflections, dqds finds its singular values to high relative accuracy, and twisted factorisations give the vectors. The
triangle is as large as the dimension, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import discard, map_rows, shipped, staged

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Bytes of a block of rows, and of the triangles that meet in one task.
BLOCK, MEET = 8 << 20, 64 << 20
#: Singular values below this share of the largest are noise of the arithmetic.
NOISE = 1e-12
EPS = np.finfo(np.float64).eps


# --- the solver -----------------------------------------------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, v)``: diagonal and upper diagonal of U' r V, and V, by Householder reflections."""
    r = np.array(r, np.float64)
    n = r.shape[1]
    v = np.eye(n)
    for k in range(n):
        _reflect(r[k:, k:], r[k:, k])
        if k + 2 < n:
            row = r[k, k + 1 :].copy()
            w = _reflector(row)
            if w is not None:
                r[k:, k + 1 :] -= np.outer(r[k:, k + 1 :] @ w, 2 * w)
                v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, 2 * w)
    return np.diag(r).copy(), np.diag(r, 1).copy(), v


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """The unit vector whose reflection moves ``x`` to its first axis; none if it is there."""
    size = np.abs(x[1:]).max(initial=0.0)
    if size == 0:
        return None
    scale = max(size, abs(x[0]))
    w = x / scale
    w[0] += math.copysign(np.linalg.norm(w), w[0] if w[0] else 1.0)
    return w / np.linalg.norm(w)


def _reflect(block: np.ndarray, column: np.ndarray) -> None:
    w = _reflector(column.copy())
    if w is not None:
        block -= np.outer(2 * w, w @ block)


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, float] | None:
    """One dqds step: new ``q, e``, the last d, and a bound from the sum of 1/d; none if the shift is too large."""
    n, d, inverse = len(q), q[0] - shift, 0.0
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    for i in range(n - 1):
        if d < 0 or math.isnan(d):
            return None
        inverse += 1 / d if d > 0 else math.inf
        new_q[i] = d + e[i]
        ratio = q[i + 1] / new_q[i] if new_q[i] > 0 else 0.0
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
    if d < 0 or math.isnan(d):
        return None
    new_q[-1] = d
    inverse += 1 / d if d > 0 else math.inf
    return new_q, new_e, d, 1 / inverse if inverse > 0 else 0.0


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling, by dqds.

    Shifts are lower bounds of the smallest value left; a shift that is too large is halved and in
    the end left out, so every step succeeds. The matrix is divided where an off-diagonal entry no longer counts.
    """
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(a))
    blocks = [([float(x) ** 2 for x in a / scale], [float(x) ** 2 for x in b / scale], 0.0)]
    found: list[float] = []
    while blocks:
        q, e, above = blocks.pop()
        bound = 0.0
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1) if _negligible(q, e, i, above)), None)
            if cut == len(e) - 1:
                found.append(above + q[-1])
                q, e = q[:-1], e[:-1]
                continue
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], above))
                q, e, bound = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            if q[0] < q[-1]:
                q, e = _flipped(q, e)
                bound = 0.0
            shift = bound
            while (step := _transform(q, e, shift)) is None:
                shift = shift / 2 if shift > EPS * max(q) else 0.0
            q, e, last, bound = step
            above += shift
            bound = 0.0 if last == 0 else bound * (1 - 4 * len(q) * EPS)
        found.append(above + q[0])
    return np.sort(np.array(found))[::-1] * scale**2


def _negligible(q: list[float], e: list[float], i: int, above: float) -> bool:
    return e[i] <= EPS * EPS * (above + min(q[i], q[i + 1])) or e[i] < 1e-300


def _flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The array of the reversed matrix, which has the same values: a bidiagonal read from its end is a lower one."""
    return q[::-1], e[::-1]


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float, avoid: np.ndarray) -> np.ndarray:
    """The right singular vector of an upper bidiagonal matrix for one squared singular value.

    B'B - value is factored from the top and from the bottom, and the two factors are joined where the
    twist is smallest, which gives the vector without a linear solve. ``avoid`` holds vectors (columns) that were found before;
    one that leaves nothing new (values that agree in all digits) is replaced by one from another twist.
    """
    n = len(a)
    q, e, ab = a**2, np.append(b**2, 0.0), np.append(a[:-1] * b, 0.0)
    tiny = EPS * EPS * max(q.max() + e.max(), value)
    top, s = np.zeros(n), np.zeros(n)
    low, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n):
        top[i] = s[i] + q[i]
        top[i] = top[i] if abs(top[i]) > tiny else -tiny
        if i + 1 < n:
            s[i + 1] = e[i] * (s[i] / top[i]) - value
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        low[i + 1] = e[i] + p[i + 1]
        low[i + 1] = low[i + 1] if abs(low[i + 1]) > tiny else -tiny
        p[i] = p[i + 1] * (q[i] / low[i + 1]) - value
    for twist in np.argsort(np.abs(s + p + value), kind="stable").tolist():
        z = np.zeros(n)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -ab[i] / top[i] * z[i + 1]
        for i in range(twist, n - 1):
            z[i + 1] = -ab[i] / low[i + 1] * z[i]
        z /= np.linalg.norm(z)
        for _ in range(2):
            z -= avoid @ (avoid.T @ z)
        if np.linalg.norm(z) > 0.1:
            return z / np.linalg.norm(z)
    # Every twist repeats what was found: any direction outside it belongs to the same value.
    rest = np.eye(n) - avoid @ avoid.T
    z = rest[:, np.argmax(np.linalg.norm(rest, axis=0))]
    return z / np.linalg.norm(z)


def leading(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """``(values, vectors)``: squares of the largest singular values of ``r``, falling, and their right vectors.

    Values at the noise of the arithmetic are left out, so there may be fewer.
    """
    a, b, v = bidiagonal(r)
    values = squared_singular_values(a, b)
    values = values[values > NOISE**2 * max(values[0], 1e-300)][:components]
    inner = np.zeros((len(a), 0))
    for value in values:
        close = [i for i in range(inner.shape[1]) if abs(values[i] - value) < 1e-3 * value]
        inner = np.column_stack([inner, twisted_vector(a, b, float(value), inner[:, close])])
    return values, v @ inner


# --- the passes over the rows ---------------------------------------------------------------------------------------


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 * c) + 100000 as 64-bit integers; what would not fit is held at the ends of 52 bits."""
    limit = float(1 << 52)
    return np.clip(np.floor(vectors * SCALE), -limit, limit).astype(np.int64) + SHIFT


def _vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    return df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Numbers and scaled vectors of the fit list, some megabytes at a time; without a dimension, of each length by itself."""
    for batch in batches:
        lists = batch.column("vector")
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        for length in [dimension] if dimension else np.unique(lengths[lengths > 0]).tolist():
            at = np.flatnonzero(lengths == length)
            # 1024 entries of 52 bits add up within 64.
            step = max(1, min(1024, BLOCK // (8 * length)))
            for start in range(0, len(at), step):
                chosen = pa.array(at[start : start + step])
                # A null entry reads as NaN.
                flat = lists.take(chosen).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
                finite = np.isfinite(flat).all(axis=1)
                if finite.any():
                    yield batch.column("vec_id").take(chosen).filter(pa.array(finite)), scaled(flat[finite])


def _sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By dimension: number of rows and the exact sum of each entry. The driver gets one row per dimension and place."""
    shipped(rows.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _blocks(batches, None):
            length = x.shape[1]
            columns = [np.full(length, length), np.arange(length), np.full(length, len(x)), x.sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["length", "place", "n", "total"])

    parts = rows.mapInArrow(each, "length long, place long, n long, total long")
    totals = parts.groupBy("length", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals = staged(totals, "whitening-sums")
    found: dict[int, tuple[int, list[int]]] = {}
    most = totals.where("place = 0").agg(F.max(F.struct("n", "length")).alias("most")).first().most
    if most is not None:
        for length, n, total in totals.where(F.col("length") == most.length).orderBy("place").select("length", "n", "total").collect():
            found.setdefault(length, (n, []))[1].append(int(Decimal(total)))
    discard(totals)
    return found


class Centre:
    """Centred rows, without loss before the division by the number of rows."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums = n, sums
        self.fits = max(abs(s) for s in sums) < 1 << 61
        self.whole = np.array(sums, np.int64 if self.fits else object)

    def times_n(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        if self.fits and float(np.abs(x).max(initial=0)) * self.n < 2.0**61:
            return x * np.int64(self.n) - self.whole
        return x.astype(object) * self.n - np.array(self.sums, object)

    def of(self, x: np.ndarray) -> np.ndarray:
        return (self.times_n(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sums of squares of n * x - S, exact; none where 64 bits do not hold one."""
        d = self.times_n(x)
        if d.dtype != object and float((d.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)) < 2.0**62:
            return (d * d).sum(axis=1).tolist()
        whole = (d.astype(object) ** 2).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in whole]


def _triangle(rows: DataFrame, centre: Centre, dimension: int) -> np.ndarray:
    """R of the QR factorisation of all centred rows. Each task sends one triangle; some meet at a time until one is left."""
    shipped(rows.sparkSession)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, dimension))
        for _, x in _blocks(batches, dimension):
            r = np.linalg.qr(np.concatenate([r, centre.of(x)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    def meet():
        held: list[np.ndarray] = []
        open_part: list = [None]

        def finish() -> Iterator[tuple]:
            if held:
                yield open_part[0], np.linalg.qr(np.concatenate(held), mode="r").tobytes()
            held.clear()

        def row(part: int, r: bytes) -> Iterator[tuple]:
            if part != open_part[0]:
                yield from finish()
                open_part[0] = part
            held.append(np.frombuffer(r).reshape(-1, dimension))
            if len(held) > 64:
                held[:] = [np.linalg.qr(np.concatenate(held), mode="r")]

        row.finish = finish
        return row

    triangles = staged(rows.mapInArrow(reduce, "part long, r binary"), "whitening-triangles")
    fan = max(2, min(64, MEET // (8 * dimension * dimension)))
    while (count := triangles.count()) > 1:
        parts = triangles.withColumn("part", F.floor(F.col("part") / fan).cast("long"))
        together = parts.repartition(min(count, 200), "part").sortWithinPartitions("part")
        smaller = staged(map_rows(together.select("part", "r"), "part long, r binary", meet), "whitening-triangles")
        discard(triangles)
        triangles = smaller
    r = np.frombuffer(triangles.first().r).reshape(-1, dimension)
    discard(triangles)
    return np.concatenate([r, np.zeros((max(0, dimension - len(r)), dimension))])[:dimension]


def _identity_error(rows: DataFrame, centre: Centre, directions: np.ndarray) -> float:
    """The largest absolute entry of the covariance of the whitened rows minus the identity, from all rows."""
    dimension, k = directions.shape
    shipped(rows.sparkSession)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means, products = np.zeros(k), np.zeros((k, k))
        for _, x in _blocks(batches, dimension):
            w = centre.of(x) @ directions
            means += w.sum(axis=0)
            products += w.T @ w
        values = np.concatenate([means, products.ravel()])
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(values)), pa.int32()), "value": pa.array(values, pa.float64())})

    parts = rows.mapInArrow(moments, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    values = np.array([r.value for r in parts.orderBy("place").collect()]) / centre.n
    covariance = values[k:].reshape(k, k) - np.outer(values[:k], values[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whitened(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors that are null, empty, or hold a null or an entry that is not finite are left out, and so are those of another length than
    most have (of several lengths, the largest). Entries become integers, floor(1024 * c) + 100000. Components
    are the eigenvectors of the covariance of all vectors that remain, by falling eigenvalue; those without
    variance beyond rounding have no rows, so equal vectors, one vector or none give none. ``deviation`` is null where 64 bits do not hold
    it. Repeated rows count each time, missing numbers stay missing, other columns are not looked at.
    """
    spark = df.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = _vectors(df, id_column, vector_column)
    sums = _sums(rows)
    if not sums:
        return spark.createDataFrame([], schema)
    [(dimension, (n, totals))] = sums.items()
    centre = Centre(n, totals)
    r = _triangle(rows, centre, dimension)
    trace = float((r**2).sum())
    if trace <= (NOISE * max(map(abs, totals)) / n) ** 2:
        return spark.createDataFrame([], schema)
    values, vectors = leading(r, components)
    directions = vectors / np.sqrt(values / n)
    explained = (values / trace).tolist()
    error = _identity_error(rows, centre, directions)
    shipped(spark)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for numbers, x in _blocks(batches, dimension):
            many = len(x)
            columns = [
                pa.array(np.repeat(np.arange(many), k)).cast(pa.int64()),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                pa.array(np.full(many * k, n, np.int64)),
                pa.array([d for d in centre.deviations(x) for _ in range(k)], pa.int64()),
                pa.array((centre.of(x) @ directions).ravel()),
                pa.array(np.tile(explained, many)),
                pa.array(np.full(many * k, error)),
            ]
            columns[0] = numbers.take(columns[0])
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
