"""Functions that SQL text can call: likenesses of vectors by name, and a table function for stretches of time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

Likeness = Callable[[np.ndarray, np.ndarray], np.ndarray]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of vectors row by row; 0 where one has no length."""
    norm = np.sqrt((a * a).sum(1) * (b * b).sum(1))
    return np.divide((a * b).sum(1), norm, out=np.zeros(len(a)), where=norm > 0)


def euclidean(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal vectors, falling to 0 with their distance."""
    return 1 / (1 + np.sqrt(((a - b) ** 2).sum(1)))


LIKENESSES: dict[str, Likeness] = {"likeness": cosine, "nearness": euclidean}


def _by_length(f: Likeness):
    """Pairs of equal length are compared together; null where one side is null or lengths differ."""

    def of(left: pd.Series, right: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(left), dtype=object)
        size = [len(x) if x is not None and y is not None and len(x) == len(y) else -1 for x, y in zip(left, right, strict=True)]
        for n in set(size) - {-1}:
            at = np.flatnonzero(np.array(size) == n)
            a, b = (np.array([s.iloc[i] for i in at], np.float64).reshape(len(at), n) for s in (left, right))
            out.iloc[at] = f(a, b)
        return out.astype("float64")

    return of


class Stretches:
    """stretches(TABLE(rows with t) PARTITION BY ... ORDER BY t, gap): t_in, t_out and n of each stretch without a pause of more than gap. (O1)"""

    def __init__(self) -> None:
        self.first = self.last = None
        self.n, self.gap = 0, 0.0

    def eval(self, row: Row, gap: float) -> Iterator[tuple]:
        t = row["t"]
        if t is None:
            return
        if self.last is not None and t - self.last > gap:
            yield self.key, self.first, self.last, self.n
            self.first = None
        if self.first is None:
            self.first, self.n, self.key = t, 0, row["key"]
        self.last, self.n = t, self.n + 1

    def terminate(self) -> Iterator[tuple]:
        if self.first is not None:
            yield self.key, self.first, self.last, self.n


def register(spark: SparkSession, likenesses: dict[str, Likeness] | None = None) -> None:
    """Makes the functions known to a session; a caller's own likenesses come beside or in place of these. (O2)"""
    for name, f in (LIKENESSES | (likenesses or {})).items():
        spark.udf.register(name, F.pandas_udf(_by_length(f), "double"))
    spark.udtf.register("stretches", F.udtf(Stretches, returnType="key string, t_in double, t_out double, n long"))
