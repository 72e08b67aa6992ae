"""Whitening of embeddings by a bidiagonal qd solver.

Tasks reduce centred rows to triangles by blockwise QR, and triangles meet
sixteen at a time until one is left: R'R is n times the covariance. R is
brought to an upper bidiagonal form by Householder reflections from both
sides. The dqds algorithm finds the squared singular values with high relative
accuracy, and a twisted factorisation at each of the largest gives its vector.
The covariance is never formed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.scratch import settings, write_table

#: Components that are returned, and triangles that one task joins.
COMPONENTS, FAN_IN = 4, 16
#: An eigenvalue below this share of the largest is zero to working precision.
ZERO = 1e-24
_EPS = np.finfo(np.float64).eps
#: Diagonal entries below this share of the largest entry are raised to it; it moves no singular value by more.
_TINY = 1e-150
_LONG = 1 << 63


def triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal and superdiagonal of U'RW, and the reflections (first row, vector) whose product is W."""
    a, n = r.copy(), r.shape[1]
    right: list[tuple[int, np.ndarray]] = []
    for k in range(n):
        v = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(2 * v, v @ a[k:, k:])
        if k < n - 2:
            v = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, 2 * v)
            right.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """A unit vector whose reflection leaves only the first entry of x; zero where there is nothing to do."""
    top = np.abs(x).max(initial=0.0)
    if not top or not x[1:].any():
        return np.zeros(len(x))
    v = x / top
    v[0] += math.copysign(np.sqrt(v @ v), v[0])
    return v / np.sqrt(v @ v)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squared singular values of an upper bidiagonal matrix with nonzero diagonal, falling."""
    found: list[float] = []
    parts = [(list(diagonal**2), list(above**2), 0.0)]
    small = (16 * _EPS) ** 2
    while parts:
        q, e, shift = parts.pop()
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= small * (shift + min(q[i], q[i + 1]))), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], shift))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1]:  # small ones leave at the end
                q, e = q[::-1], e[::-1]
            tau = _corner(q[-2], e[-1], q[-1])
            while (step := _qd_step(q, e, tau)) is None:
                tau = tau / 4 if tau > small * q[-1] else 0.0
            q, e = step
            shift += tau
        found.append(q[0] + shift)
    return np.sort(np.array(found))[::-1]


def _corner(q1: float, e: float, q2: float) -> float:
    """A little less than the smaller eigenvalue of the last two rows: a shift."""
    a, b = q1 + e, q2
    half = (a - b) / 2
    return max(0.0, b - q2 * e / (abs(half) + math.sqrt(half * half + q2 * e)) if half >= 0 else b + half - math.sqrt(half * half + q2 * e)) * (1 - 8 * _EPS)


def _qd_step(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float]] | None:
    """One differential step with shift; None where the shift was above the smallest value."""
    d, out_q, out_e = q[0] - tau, [], []
    if d < 0:
        return None
    for i in range(len(e)):
        top = d + e[i]
        if top == 0.0:  # only with a zero on the diagonal, which moves on
            out_q.append(0.0)
            out_e.append(0.0)
            d = q[i + 1] - tau
        else:
            t = q[i + 1] / top
            out_q.append(top)
            out_e.append(e[i] * t)
            d = d * t - tau
        if d < 0:
            return None
    return [*out_q, d], out_e


class Twisted:
    """B'B less an eigenvalue, factorised from both ends (stationary and progressive qd)."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        n = len(diagonal)
        pivot, low = diagonal**2, above / diagonal[:-1]
        least = _TINY * max(value, pivot.max())
        s, p = np.empty(n), np.empty(n)
        self.down, self.up, self.plus = np.zeros(n - 1), np.zeros(n - 1), np.empty(n)
        s[0] = -value
        for i in range(n):
            plus = pivot[i] + s[i]
            self.plus[i] = plus if abs(plus) > least else least
            if i < n - 1:
                self.down[i] = low[i] * pivot[i] / self.plus[i]
                s[i + 1] = self.down[i] * low[i] * s[i] - value
        p[n - 1] = pivot[n - 1] - value
        for i in range(n - 2, -1, -1):
            minus = pivot[i] * low[i] ** 2 + p[i + 1]
            t = pivot[i] / (minus if abs(minus) > least else least)
            self.up[i] = low[i] * t
            p[i] = p[i + 1] * t - value
        self.twist = int(np.abs(s + p + value).argmin())

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.plus))
        z[self.twist] = 1.0
        for i in range(self.twist - 1, -1, -1):
            z[i] = -self.down[i] * z[i + 1]
        for i in range(self.twist, len(z) - 1):
            z[i + 1] = -self.up[i] * z[i]
        return _unit(z)

    def nearer(self, z: np.ndarray) -> np.ndarray:
        """One step of inverse iteration."""
        y = z.copy()
        for i in range(1, len(y)):
            y[i] -= self.down[i - 1] * y[i - 1]
        y /= self.plus
        for i in range(len(y) - 2, -1, -1):
            y[i] -= self.down[i] * y[i + 1]
        return _unit(y)


def _unit(z: np.ndarray, others: list[np.ndarray] = ()) -> np.ndarray:
    """z at length 1, orthogonal to the others."""
    z = z / np.abs(z).max()
    for v in [*others, *others]:
        z = z - (v @ z) * v
    return z / np.sqrt(z @ z)


def directions(r: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of R and their right vectors, as rows; fewer where fewer are above zero."""
    size, n = np.abs(r).max(initial=0.0), r.shape[1]
    if not size:
        return np.zeros(0), np.zeros((0, n))
    diagonal, above, right = bidiagonal(r / size)
    top = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    diagonal = np.where(np.abs(diagonal) < _TINY * top, _TINY * top, diagonal)
    # Where the superdiagonal is zero to working precision the matrix falls apart; a value of several blocks has a vector in each.
    cuts = [0, *(np.flatnonzero(np.abs(above) <= _EPS * top) + 1), n]
    blocks = [slice(int(i), int(j)) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    inner = [above[b.start : b.stop - 1] for b in blocks]
    found = sorted(((v, i) for i, b in enumerate(blocks) for v in dqds(diagonal[b], inner[i])), reverse=True)
    found = [(v, i) for v, i in found if v > ZERO * found[0][0]][:most]
    own: list[list[tuple[float, np.ndarray]]] = [[] for _ in blocks]
    out = np.zeros((len(found), n))
    for k, (value, i) in enumerate(found):
        factors = Twisted(diagonal[blocks[i]], inner[i], value)
        z = factors.vector()
        if close := [v for w, v in own[i] if w - value < 1e-3 * w]:
            z = _unit(z + 1e-3 * np.random.default_rng(k).standard_normal(len(z)), close)
            for _ in range(4):
                z = _unit(factors.nearer(z), close)
        own[i].append((value, z))
        out[k, blocks[i]] = z
    for first, v in reversed(right):
        out[:, first:] -= np.outer(out[:, first:] @ v, 2 * v)
    out *= np.sign(out[np.arange(len(out)), np.abs(out).argmax(1)])[:, None]
    return np.array([v for v, _ in found]) * size**2, out


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_list()) if len(series) else np.zeros((0, 0), np.int64)


def _whole_sum(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns."""
    return x.sum(0) if len(x) * float(np.abs(x.astype(np.float64)).max(initial=0.0)) < _LONG / 2 else x.astype(object).sum(0)


def _summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n, total = 0, 0
    for pdf in frames:
        if len(pdf):
            n, total = n + len(pdf), total + _whole_sum(_matrix(pdf["x"])).astype(object)
    if n:
        yield pd.DataFrame({"n": [n], "total": [[str(v) for v in total]]})


def _triangles(mean: np.ndarray):
    def reduced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = np.zeros((0, len(mean)))
        for pdf in frames:
            if len(pdf):
                r = triangle(np.vstack([r, _matrix(pdf["x"]) - mean]))
        if len(r):
            yield pd.DataFrame({"id": [TaskContext.get().partitionId()], "r": [r.ravel()]})

    return reduced


def _joined(size: int):
    def joined(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        r = triangle(np.vstack([x.reshape(-1, size) for x in pdf.sort_values("id")["r"]]))
        return pd.DataFrame({"id": [key[0]], "r": [r.ravel()]})

    return joined


def _solved(size: int):
    def solved(pdf: pd.DataFrame) -> pd.DataFrame:
        r = triangle(np.vstack([*(x.reshape(-1, size) for x in pdf.sort_values("id")["r"]), np.zeros((size, size))]))
        values, vectors = directions(r)
        return pd.DataFrame({"component": np.arange(1, len(values) + 1), "value": values, "vector": pd.Series(list(vectors), dtype=object), "trace": [float((r * r).sum())] * len(values)})

    return solved


def _products(project):
    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                y = project(_matrix(pdf["x"]))
                yield pd.DataFrame({"name": [f"{i},{j}" for i in range(y.shape[1]) for j in range(y.shape[1] + 1)], "value": np.column_stack([y.T @ y, y.sum(0)]).ravel()})

    return summed


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """The sum of (n x - S) squared of each row, exactly; None where it doesn't fit in 64 bits."""
    if not x.size:
        return [0] * len(x)
    most = max(abs(int(x.max())), abs(int(x.min()))) * n + max(abs(s) for s in total)
    if most * most * x.shape[1] < _LONG:
        return list(((x * n - np.array(total, np.int64)) ** 2).sum(1))
    found = ((x.astype(object) * n - np.array(total, object)) ** 2).sum(1)
    return [v if v < _LONG else None for v in found]


def _whole(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the rows that can be used."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * 256).cast("long")).alias("x")
    return vectors.where(F.col("embedding").isNotNull() & finite).select("vec_id", x)


def whitened(vectors: DataFrame) -> DataFrame:
    """For each usable row and each of the first four components: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries go. The fit
    is over distinct whole vectors x = floor(256 c), so repeated vectors count
    once; every usable row is projected. The most frequent length (ties: the
    longest) is the fit's: rows of another length come out once, with only
    vec_id and n, as no projection of them exists. Components whose eigenvalue
    is zero to working precision are left out: there are fewer than four where
    the vectors span fewer, and none where all are equal or empty. Equal
    eigenvalues have any orthogonal vectors. A null vec_id is kept as it is, and
    repeated vec_ids stay apart. deviation is null where it exceeds 64 bits,
    and an entry whose x does is taken as the nearest one that fits. An empty
    table gives an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = write_table(_whole(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")), "whole")
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("size")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    size = lengths["size"]
    fits = write_table(rows.where(F.size("x") == size).select("x").distinct(), "fit")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=max(1, min(10_000, 4_000_000 // max(1, size)))):
        sums = fits.mapInPandas(_summed, "n long, total array<string>")
        n = sums.agg(F.sum("n")).first()[0]
        total = [int(r[0]) for r in sums.select(F.posexplode("total").alias("at", "s")).groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").select("s").collect()]
        mean = np.array([s / n for s in total])
        parts = write_table(fits.mapInPandas(_triangles(mean), "id long, r array<double>"), "triangles") if size else None
        many = parts.count() if size else 0
        while many > FAN_IN:
            parts = write_table(parts.groupBy(F.floor(F.col("id") / FAN_IN).alias("id")).applyInPandas(_joined(size), "id long, r array<double>"), "triangles")
            many = parts.count()
        found = parts.groupBy((F.col("id") * 0).alias("all")).applyInPandas(_solved(size), "component int, value double, vector array<double>, trace double").orderBy("component").collect() if size else []
        values = np.array([f["value"] for f in found]) / n
        axes = np.array([f["vector"] for f in found]).reshape(len(found), size).T / np.sqrt(values)
        share = [f["value"] / f["trace"] for f in found]

        def project(x: np.ndarray) -> np.ndarray:
            return (x - mean) @ axes

        error = 0.0
        if found:
            k = len(found)
            sums = {tuple(map(int, r["name"].split(","))): r["value"] for r in fits.mapInPandas(_products(project), "name string, value double").groupBy("name").agg(F.sum("value").alias("value")).collect()}
            means = [sums[i, k] / n for i in range(k)]
            error = max(abs(sums[i, j] / n - means[i] * means[j] - (i == j)) for i in range(k) for j in range(k))

        def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                fit = pdf["x"].map(len) == size
                other = pd.DataFrame({"vec_id": pdf["vec_id"][~fit]})
                yield other.assign(component=None, n=n, deviation=None, whitened=None, explained=None, identity_error=None)
                pdf = pdf[fit]
                if not len(pdf) or not found:
                    continue
                x, k = _matrix(pdf["x"]), len(found)
                dev = pd.Series(deviations(x, n, total), dtype="Int64")
                yield pd.DataFrame(
                    {"vec_id": pdf["vec_id"].repeat(k).to_numpy(), "component": np.tile(np.arange(1, k + 1), len(pdf)), "n": n, "deviation": dev.repeat(k).to_numpy(), "whitened": project(x).ravel(), "explained": np.tile(share, len(pdf)), "identity_error": error}
                )

        return write_table(rows.mapInPandas(placed, schema), "whitened")
