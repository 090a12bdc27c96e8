"""Embedding whitening by a compensated covariance.

Components become whole numbers, so the rows' number and sums are exact. The mean is a double-double: a double and the
double that it lacks. Each task centres its rows and adds their outer products up in double-double: error-free
transformations give every product and sum together with its rounding error, and the low parts carry the errors along.
A task ends with one high and one low part for each pair of dimensions; these meet over tasks in a tree, some tasks at a
time and each block of pairs apart, high and low parts together. The eigenvectors come from LAPACK's symmetric
divide-and-conquer solver (Householder reduction to a tridiagonal matrix, then Cuppen's splitting), refined against the
double-double covariance in extended precision. Only the covariance, of as many rows as dimensions, reaches the driver.

Defined results for odd input: vectors that are null, empty, of another length than most, or that hold null or
non-finite components, or components beyond LIMIT, take no part; null ids keep their rows; repeated rows count as often
as they come; an empty table gives an empty result; a component without variance has whitened 0, explained 0 and is
left out of identity_error (which is 0 if none has any); a deviation beyond 64 bits is null; with fewer dimensions than
components asked for, there are as many components as dimensions; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .vectors import matrix, whole

SHIFT = 100_000
KEPT = 8
#: Components beyond this would make sums of a batch inexact.
LIMIT = float(1 << 30)
#: Pairs of dimensions that are added up, and sent, at a time; rows of which products are made at a time; tasks that merge at a time.
PAIRS, ROWS, FAN = 4096, 64, 64
#: A component with less than this share of the largest has no variance that doubles could tell from none.
LEAST_SHARE = 1e-13


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rounded sum and its error, exactly."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def _halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t = a * 134217729.0
    high = t - (t - a)
    return high, a - high


def two_product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rounded product and its error, exactly."""
    p = a * b
    ah, al = _halves(a)
    bh, bl = _halves(b)
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def plus(ah: np.ndarray, al: np.ndarray, bh: np.ndarray, bl: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of two double-doubles."""
    s, e = two_sum(ah, bh)
    return two_sum(s, e + (al + bl))


def total(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Double-doubles added up along the first axis, halves with halves."""
    while len(high) > 1:
        half = len(high) // 2
        h, e = plus(high[:half], low[:half], high[half : 2 * half], low[half : 2 * half])
        if len(high) % 2:
            h, e = np.concatenate((h, high[-1:])), np.concatenate((e, low[-1:]))
        high, low = h, e
    return high[0], low[0]


@dataclass
class Mean:
    """Row count, exact sums, and sums / n as double-doubles."""

    n: int
    sums: list[int]

    @property
    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        exact = [Fraction(s, self.n) for s in self.sums]
        high = [float(f) for f in exact]
        return np.array(high), np.array([float(f - Fraction(h)) for f, h in zip(exact, high, strict=True)])


def centred(x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """x - sums / n as double-doubles."""
    s, e = two_sum(x.astype(np.float64), -mean[0])
    return two_sum(s, e - mean[1])


def _pairs(dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(dims)


def add_products(high: np.ndarray, low: np.ndarray, d: np.ndarray, e: np.ndarray) -> None:
    """Adds the outer products of the rows d + e to the double-doubles high, low (one a pair of dimensions), in place."""
    left, right = _pairs(d.shape[1])
    for at in range(0, len(left), PAIRS):
        i, j = left[at : at + PAIRS], right[at : at + PAIRS]
        for r in range(0, len(d), ROWS):
            a, b, c, f = d[r : r + ROWS, i], d[r : r + ROWS, j], e[r : r + ROWS, i], e[r : r + ROWS, j]
            p, q = two_product(a, b)
            p, q = two_sum(p, q + (a * f + c * b))
            high[at : at + PAIRS], low[at : at + PAIRS] = plus(high[at : at + PAIRS], low[at : at + PAIRS], *total(p, q))


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums, n = None, 0
    for batch in batches:
        if batch.num_rows:
            own = matrix(batch.column("x")).sum(axis=0)
            sums = [int(s) for s in own] if sums is None else [a + int(b) for a, b in zip(sums, own, strict=True)]
            n += batch.num_rows
    if sums is not None:
        yield pa.RecordBatch.from_pydict({"pos": pa.array(range(len(sums)), pa.int32()), "s": pa.array([str(s) for s in sums]), "n": pa.array([n] * len(sums), pa.int64())})


def mean_of(rows: DataFrame) -> Mean | None:
    """One row a dimension reaches the driver."""
    by_task = rows.select("x").mapInArrow(_column_sums, "pos int, s string, n long")
    found = by_task.groupBy("pos").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("pos").collect()
    return Mean(found[0]["n"], [int(r["s"]) for r in found]) if found else None


def _products(shared):
    """One row a block of pairs: the task's outer products, high and low parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        mean = shared.value.parts
        dims = len(mean[0])
        high, low = np.zeros(dims * (dims + 1) // 2), np.zeros(dims * (dims + 1) // 2)
        seen = False
        for batch in batches:
            if batch.num_rows:
                seen = True
                add_products(high, low, *centred(matrix(batch.column("x")), mean))
        if seen:
            at = range(0, len(high), PAIRS)
            yield pa.RecordBatch.from_pydict(
                {
                    "task": pa.array([TaskContext.get().partitionId()] * len(at), pa.int64()),
                    "block": pa.array(range(len(at)), pa.int32()),
                    "high": pa.array([high[a : a + PAIRS] for a in at], pa.list_(pa.float64())),
                    "low": pa.array([low[a : a + PAIRS] for a in at], pa.list_(pa.float64())),
                }
            )

    return run


def _merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("task")
    high, low = total(np.stack(frame["high"].to_numpy()), np.stack(frame["low"].to_numpy()))
    return pd.DataFrame({"task": [key[1]], "block": [key[0]], "high": [high], "low": [low]})


def covariance(rows: DataFrame, mean: Mean) -> tuple[np.ndarray, np.ndarray]:
    """The sums of centred outer products over all rows, divided by n, as high and low parts."""
    schema = "task long, block int, high array<double>, low array<double>"
    partial = saved(rows.select("x").mapInArrow(_products(rows.sparkSession.sparkContext.broadcast(mean)), schema), "products")
    last = partial.agg(F.max("task")).first()[0]
    while True:
        partial = partial.withColumn("up", F.expr(f"task DIV {FAN}")).groupBy("block", "up").applyInPandas(_merge, schema)
        last //= FAN
        if last == 0:
            break
    found = partial.orderBy("block").collect()  # one row a block of pairs: half of the covariance
    dims = len(mean.sums)
    out = []
    for part in ("high", "low"):
        full = np.zeros((dims, dims))
        full[_pairs(dims)] = np.concatenate([r[part] for r in found])
        out.append(full + np.triu(full, 1).T)
    high = out[0] / mean.n
    p, e = two_product(high, np.full_like(high, float(mean.n)))
    return high, ((out[0] - p) - e + out[1]) / mean.n


def eigen(high: np.ndarray, low: np.ndarray, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, their largest entry positive.

    The solver's vectors are refined by Ogita and Aishima's iteration in extended precision, until a step changes nothing
    that a double could hold.
    """
    a = high.astype(np.longdouble) + low
    values, start = np.linalg.eigh(high)
    x = start.astype(np.longdouble)
    size = np.abs(values).max(initial=0.0)
    lam = values.astype(np.longdouble)
    for _ in range(rounds if size > 0 else 0):
        r = np.eye(len(a), dtype=np.longdouble) - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # a rounding that isn't symmetric would grow by close eigenvalues
        lam = np.diag(s) / (1 - np.diag(r))
        gap = lam[None, :] - lam[:, None]
        near = 2 * (np.linalg.norm((s - np.diag(np.diag(s))).astype(np.float64)) + size * np.linalg.norm(r.astype(np.float64)))
        apart = np.abs(gap) > max(near, 1e-18 * size)
        step = np.where(apart, (s + lam[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ step
        if np.abs(step).max() < 1e-17:
            break
    order = np.argsort(-lam, kind="stable")
    values, x = lam[order].astype(np.float64), x[:, order].astype(np.float64)
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])])
    return values, x * np.where(sign == 0, 1, sign)


def deviations(x: np.ndarray, mean: Mean) -> list[int | None]:
    """Sums of (n * x - sums) ** 2, exact; beyond 64 bits: None."""
    most = mean.n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, mean.sums))
    if x.shape[1] * most * most < 1 << 63:
        gap = mean.n * x - np.array(mean.sums, np.int64)
        return (gap * gap).sum(axis=1).tolist()
    gap = x.astype(object) * mean.n - np.array(mean.sums, object)
    return [s if s < 1 << 63 else None for s in (gap * gap).sum(axis=1).tolist()]


def _whitened(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, axes = shared.value
        parts = mean.parts
        for batch in batches:
            x = matrix(batch.column("x")) if batch.num_rows else np.zeros((0, len(mean.sums)), np.int64)
            d, e = centred(x, parts)
            w = d @ axes + e @ axes
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviations(x, mean), pa.int64()), flat], ["vec_id", "deviation", "w"])

    return run


@dataclass
class Whitener:
    """What fit() learns: the mean, falling eigenvalues, their trace, and unit eigenvectors as columns."""

    mean: Mean
    values: np.ndarray
    vectors: np.ndarray

    @property
    def trace(self) -> float:
        return float(self.values.sum())

    def varied(self, kept: int = KEPT) -> np.ndarray:
        """Which of the first components have variance."""
        some = self.values[:kept]
        return some > LEAST_SHARE * max(self.values.max(initial=0.0), 0.0)

    def axes(self, kept: int = KEPT) -> np.ndarray:
        """Columns that project a centred vector to its whitened components; zero where there is no variance."""
        ok = self.varied(kept)
        scale = np.where(ok, 1 / np.sqrt(np.where(ok, self.values[:kept], 1)), 0)
        return self.vectors[:, :kept] * scale


def fit(rows: DataFrame) -> Whitener | None:
    """rows: x. None if there are none."""
    mean = mean_of(rows)
    return None if mean is None else Whitener(mean, *eigen(*covariance(rows, mean)))


def whitened(rows: DataFrame, model: Whitener, kept: int = KEPT) -> DataFrame:
    """vec_id, deviation, w: the first whitened components of each row."""
    shared = rows.sparkSession.sparkContext.broadcast((model.mean, model.axes(kept)))
    return rows.select("vec_id", "x").mapInArrow(_whitened(shared), "vec_id long, deviation long, w array<double>")


def identity_error(rows: DataFrame, varied: np.ndarray) -> float:
    """The largest entry of the whitened components' covariance minus the identity; components without variance stay out."""
    some = [int(i) for i in np.flatnonzero(varied)]
    pairs = [(i, j) for i in some for j in some if i <= j]
    if not pairs:
        return 0.0
    found = rows.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def report(vectors: DataFrame, kept: int = KEPT) -> DataFrame:
    """A row for each vector and component: see SCHEMA."""
    spark = vectors.sparkSession
    rows = saved(whole(vectors, LIMIT, SHIFT), "vectors")
    model = fit(rows)
    if model is None:
        return spark.createDataFrame([], SCHEMA)
    done = saved(whitened(rows, model, kept), "whitened")
    ok = model.varied(kept)
    shares = [float(v) / model.trace if on else 0.0 for v, on in zip(model.values[:kept], ok, strict=True)]
    out = done.select("vec_id", "deviation", F.posexplode("w").alias("pos", "whitened"))
    return out.select(
        "vec_id",
        (F.col("pos") + 1).cast("int").alias("component"),
        F.lit(model.mean.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(s) for s in shares])[F.col("pos")].alias("explained"),
        F.lit(identity_error(done, ok)).cast("double").alias("identity_error"),
    )
