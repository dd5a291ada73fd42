"""Embedding whitening by a bidiagonal qd solver.

The distinct vectors, centred, are reduced to one triangle R by QR block by block: within tasks, then over groups of tasks. R has the singular values and right
singular vectors of all of them, and never squares what it holds, as a covariance matrix would. On the driver R, a matrix of dimension
times dimension, is made bidiagonal by Householder reflections; dqds (the differential quotient-difference algorithm with shifts) finds the singular
values of the bidiagonal matrix to high relative accuracy; twisted factorisations of the shifted matrix give the vectors of the largest, where
the twist lies at the smallest pivot. Values that nearly coincide get theirs by inverse iteration with the same factorisations, each kept orthogonal to the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, keep, read
from .exact import SCHEMA, as_long, column_sums, dense, finite, partial_sums, total_sums

#: Rows of a block that a task reduces at once.
BLOCK = 4096
#: Triangles that one task, and at last the driver, reduces to one.
FAN = 32
#: Values closer than this, relative to the larger, have their vectors found together.
CLOSE = 1e-4
_EPS = np.finfo(float).eps
#: Stands for a pivot of 0.
_TINY = 1e-150


def triangle(blocks: Iterator[np.ndarray], dim: int) -> np.ndarray:
    """R of the QR factorisation of all rows of `blocks`."""
    r = np.zeros((0, dim))
    for block in blocks:
        for a in range(0, len(block), BLOCK):
            r = np.linalg.qr(np.concatenate([r, block[a : a + BLOCK]]), mode="r")
    return r


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit h so that x - 2 h (h.x) has only its first entry; None if that is so already."""
    if not np.any(x[1:]):
        return None
    h = x / np.abs(x).max()
    h[0] += np.copysign(np.linalg.norm(h), h[0])
    return h / np.linalg.norm(h)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V^T for orthogonal U and V."""
    dim = r.shape[1]
    b = np.zeros((dim, dim))
    b[: len(r)] = r
    v = np.eye(dim)
    for k in range(dim):
        if (h := _reflector(b[k:, k])) is not None:
            b[k:, k:] -= 2 * np.outer(h, h @ b[k:, k:])
        if (h := _reflector(b[k, k + 1 :])) is not None:
            b[k:, k + 1 :] -= 2 * np.outer(b[k:, k + 1 :] @ h, h)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ h, h)
    return np.diag(b).copy(), np.diag(b, 1).copy(), v


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transformation with `shift`, and its smallest d; None if the shift is too large."""
    d, out_q, out_e = q[0] - shift, [], []
    least = d
    for i, off in enumerate(e):
        if d < 0:
            return None
        out_q.append(d + off)
        t = q[i + 1] / out_q[-1] if out_q[-1] else 0.0
        out_e.append(off * t)
        d = d * t - shift
        least = min(least, d)
    return None if d < 0 or d != d else ([*out_q, d], out_e, least)


def squared_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the upper bidiagonal matrix of `a` and `b`, largest first, by dqds."""
    scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if not scale:
        return np.zeros(len(a))
    found, todo = [], [([*((a / scale) ** 2)], [*((b / scale) ** 2)], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        guess = 0.0
        while q:
            cut = next((i for i in reversed(range(len(e))) if e[i] <= (8 * _EPS) ** 2 * (sigma + min(q[i], q[i + 1])) or e[i] < _TINY), None)
            if cut is not None:
                # parts that no longer touch go on apart
                todo.append((q[: cut + 1], e[:cut], sigma))
                q, e, guess = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            if len(q) == 1:
                found.append(q[0] + sigma)
                break
            if q[-1] > 1.5 * q[0]:
                q, e = q[::-1], e[::-1]
            for shift in (guess, guess / 4, guess / 64, 0.0):
                if (step := _dqds_step(q, e, shift)) is not None:
                    break
            q, e, least = step
            sigma += shift
            # the smallest d bounds the smallest value from above; near the end it is almost that
            guess = max(least, 0.0) * (0.97 if e[-1] < 1e-3 * q[-1] else 0.5)
    return np.sort(np.maximum(found, 0))[::-1] * scale**2


class Twisted:
    """B^T B - value for the bidiagonal B of `a` and `b`, factorised from both ends to the position of smallest pivot."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = len(a)
        safe = lambda x: x if abs(x) > _TINY else _TINY
        top, bottom, s, p = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        s[0] = -value
        for i in range(n):
            top[i] = safe(s[i] + a[i] ** 2)
            if i + 1 < n:
                s[i + 1] = b[i] ** 2 / top[i] * s[i] - value
        p[-1] = a[-1] ** 2 - value
        for i in range(n - 1, 0, -1):
            bottom[i] = safe(b[i - 1] ** 2 + p[i])
            p[i - 1] = p[i] * a[i - 1] ** 2 / bottom[i] - value
        pivot = s + p + value
        self.k = int(np.abs(pivot).argmin())
        off = a[:-1] * b
        self.lower, self.upper = off / top[:-1], off / bottom[1:]
        self.d = np.r_[top[: self.k], safe(pivot[self.k]), bottom[self.k + 1 :]]

    def back(self, w: np.ndarray) -> np.ndarray:
        y = w.copy()
        for i in range(self.k - 1, -1, -1):
            y[i] -= self.lower[i] * y[i + 1]
        for i in range(self.k, len(y) - 1):
            y[i + 1] -= self.upper[i] * y[i]
        return y

    def vector(self) -> np.ndarray:
        w = np.zeros(len(self.d))
        w[self.k] = 1
        return _unit(self.back(w))

    def solve(self, rhs: np.ndarray) -> np.ndarray:
        u, n, k = rhs.copy(), len(rhs), self.k
        for i in range(1, k + 1):
            u[i] -= self.lower[i - 1] * u[i - 1]
        for i in range(n - 2, k - 1, -1):
            u[i] -= self.upper[i] * u[i + 1]
        return self.back(u / self.d)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()
    return x / np.linalg.norm(x)


def directions(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Columns: unit right singular vectors of the bidiagonal matrix for its `values` (squared, falling)."""
    out: list[np.ndarray] = []
    first = 0
    draw = np.random.default_rng(0)
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLOSE * values[i - 1]:
            first = i
        near = i + 1 < len(values) and value - values[i + 1] <= CLOSE * value
        twisted = Twisted(a, b, value)
        if first == i and not near:
            out.append(twisted.vector())
            continue
        x = draw.standard_normal(len(a))
        for _ in range(5):
            for _ in range(2):
                for other in out[first:]:
                    x = x - other * (other @ x)
            x = _unit(twisted.solve(_unit(x)))
        for _ in range(2):
            for other in out[first:]:
                x = _unit(x - other * (other @ x))
        out.append(x)
    return np.array(out).T.reshape(len(a), len(values))


def principal(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(directions as columns, their squared singular values, the sum of all) of a triangle; values that rounding can't tell from 0 are left out."""
    a, b, v = bidiagonal(r)
    values = squared_values(a, b)
    some = values[: most + 1]
    some = some[some > (_EPS * max(len(a), 2)) ** 2 * values[0]] if values[0] else some[:0]
    unit = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) or 1.0
    return (v @ directions(a / unit, b / unit, some / unit**2))[:, :most], some[:most], float(values.sum())


class Fit:
    """n distinct vectors with sums S: their mean as floor and remainder, and centred rows."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.floor = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once or twice."""
        far = np.abs(x).max(initial=0) >= 2**61
        return (x.astype(float) - self.floor.astype(float) if far else (x - self.floor).astype(float)) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)**2 of each row, exact; null where a long can't hold it."""
        most = self.n * int(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, self.sums))
        if len(self.sums) * most**2 < 2**63:
            y = self.n * x - np.array(self.sums, np.int64)
            return np.einsum("ij,ij->i", y, y).tolist()
        about = ((self.centred(x) * self.n) ** 2).sum(axis=1)
        return [None if rough > 2.0**63 * 1.01 else as_long(sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums))) for row, rough in zip(x.tolist(), about)]


def _reduced(fit_rows: DataFrame, fit: Fit, dim: int) -> np.ndarray:
    """R of all centred rows: a triangle a task, then one of each FAN, until FAN or fewer reach the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = triangle((fit.centred(dense(b.column(0), dim)) for b in batches), dim)
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["g", "r"])

    unpack = lambda data: np.frombuffer(data, float).reshape(-1, dim)

    def join(table: pa.Table) -> pa.Table:
        r = triangle(map(unpack, table["r"].to_pylist()), dim)
        return pa.table({"g": pa.array([table["g"][0].as_py() // FAN], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    parts = keep(fit_rows.mapInArrow(task, "g long, r binary"), "triangles")
    while parts.count() > FAN:
        joined = keep(parts.groupBy(F.floor(F.col("g") / FAN)).applyInArrow(join, "g long, r binary"), "triangles")
        discard(parts)
        parts = joined
    # FAN rows at most
    last = [unpack(row["r"]) for row in parts.orderBy("g").collect()]
    discard(parts)
    return triangle(iter(last), dim)


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """`id_col`, component (from 1), n, deviation, whitened, explained, identity_error for each vector and each of the `components` directions of largest variance.

    Vectors that are null or hold null or non-finite entries are left out. The others become whole numbers x = floor(scale * entry), at most a long's
    largest. The fit list is each distinct x once: n of them, sums S. whitened is x - S / n along the direction over the square root of its variance; deviation the sum of
    (n * x - S)**2, null where a long can't hold it; explained the direction's share of all variance; identity_error the largest
    absolute entry of the covariance of whitened over the fit list less the identity.

    Directions without variance are left out, so equal or no vectors give an empty table. Shorter vectors are filled up with zeros. Repeated rows get a row each and count
    once in the fit; null ids are allowed; other columns are left out. Memory grows with the square of the vectors' length, not with their number.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    nothing = spark.createDataFrame([], f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    v = vectors[vec_col]
    rows = keep(vectors.where(finite(v)).select(vectors[id_col].alias("id"), F.transform(v, lambda e: F.floor(F.lit(scale) * e.cast("double"))).alias("x")), "long-vectors")
    shape = rows.agg(F.max(F.size("x")).alias("dim"), F.min(F.size("x")).alias("least")).first()
    dim = shape["dim"]
    if not dim:
        return nothing
    if shape["least"] < dim:
        filled = keep(rows.select("id", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))).alias("x")), "long-vectors")
        discard(rows)
        rows = filled
    distinct = keep(rows.select("x").distinct(), "fit-list")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * (dim + 1)
        for batch in batches:
            sums = [a + b for a, b in zip(sums, [*column_sums(dense(batch.column(0), dim)), batch.num_rows])]
        yield from partial_sums([(0, sums)])

    totals = total_sums(distinct.mapInArrow(add, SCHEMA))[0]
    fit = Fit(totals[dim], [totals[d] for d in range(dim)])
    axes, values, every = principal(_reduced(distinct, fit, dim), components)
    if not len(values):
        return nothing
    axes = axes / np.sqrt(values / fit.n)[None, :]
    names = [f"w{i}" for i in range(len(values))]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = fit.centred(dense(batch.column(0), dim)) @ axes
            yield pa.RecordBatch.from_arrays([pa.array(w[:, i]) for i in range(len(names))], names)

    white = distinct.mapInArrow(project, ", ".join(f"{c} double" for c in names))
    # one row; covar_pop centres before it multiplies
    entries = white.agg(*(F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i in range(len(names)) for j in range(i + 1))).first()
    error = max(abs(entries[f"c{i}_{j}"] - (i == j)) for i in range(len(names)) for j in range(i + 1))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(names)
        for batch in batches:
            x = dense(batch.column(1), dim)
            at = np.repeat(np.arange(len(x)), k)
            deviation = pa.array(fit.deviations(x), pa.int64()).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), deviation, pa.array((fit.centred(x) @ axes).ravel())], ["id", "component", "deviation", "whitened"])

    out = rows.mapInArrow(answer, f"id {kind}, component int, deviation long, whitened double")
    share = F.element_at(F.array(*(F.lit(float(x) / every) for x in values)), F.col("component"))
    return out.select(F.col("id").alias(id_col), "component", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(float(error)).alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
