"""Whitening of vectors: centred, turned to the principal axes, and scaled to unit variance.

The scatter is gathered by Spark: one scan adds the vectors up, a second adds the products of what is left when the mean is
taken away; each task keeps dims x dims numbers, whatever rows it reads, and Spark adds these by cell. The driver gets that
one matrix and turns it by cyclic Jacobi rotations: a sweep meets each pair of axes once, pairs without a common axis
together, until all off-diagonals have vanished beside their own diagonals, which keeps small eigenvalues accurate. The
matrix of `k` axes goes out with the tasks. Its size depends on dims alone.

Vectors of integers are exact: n * x - S is taken in integers before anything is rounded, and deviation, the sum of its
squares, is a decimal. Sums must fit 62 bits: where n times the largest entry doesn't, fit() raises ValueError.

Rows whose vector is null, empty, or holds a null, NaN or infinite entry are dropped; of vectors of several lengths those of
the commonest are kept (of the longest of these). Repeated rows count each. Axes without variance (an eigenvalue of at most
dims * 2^-52 of the largest) have null whitened values and don't count for identity_error; with one row all have none. Fewer
dimensions than k give fewer components. Other columns are kept; whitened and deviation are replaced. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, stored, table

COMPONENTS, EXACT, SWEEPS = 32, 1 << 62, 60
SCALE, SHIFT = 64, 1_000_000
#: Beyond this an entry is cut before it becomes an integer; sums of such don't fit, so that fit() raises.
LARGEST = float(1 << 61)


def finite(vector: str) -> Column:
    """Whether the vector is there, not empty, and without null, NaN and infinite entries."""
    inner = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & inner, F.lit(False))


def gridded(vector: str, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * c) + shift of each entry, as long."""
    return F.transform(vector, lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-LARGEST)), F.lit(LARGEST))) + shift)


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, as a matrix of its numbers."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


@dataclass
class Sums:
    """Of vectors: their number, sums by dimension, and lowest and highest entries."""

    n: int
    sums: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n if x.dtype == np.int64 else x - self.sums / self.n


def sums_of(df: DataFrame, vector: str) -> Sums | None:
    """Sums of the vectors of the commonest length (arrays of long or of double, without nulls); None if there are none."""
    whole = df.schema[vector].dataType.elementType.typeName() == "long"
    kind, item = (np.int64, "long") if whole else (np.float64, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[int, list] = {}
        for b in batches:
            lengths = b.column(0).value_lengths().to_numpy()
            for d in np.unique(lengths).tolist():
                x = matrix(b.column(0).filter(pa.array(lengths == d)))
                n, s, low, high = of.get(d, (0, np.zeros(d, kind), x[0], x[0]))
                of[d] = [n + len(x), s + x.sum(axis=0, dtype=kind), np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))]
        if of:
            n, s, low, high = zip(*of.values(), strict=True)
            yield pa.RecordBatch.from_pydict({"d": pa.array(list(of), pa.int64()), "n": pa.array(n, pa.int64())} | {c: pa.array(map(list, x), pa.list_(pa.from_numpy_dtype(kind))) for c, x in (("s", s), ("low", low), ("high", high))})

    parts = stored(df.select(vector).mapInArrow(run, f"d long, n long, s array<{item}>, low array<{item}>, high array<{item}>"), "sums")
    lengths = parts.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not lengths:
        return None
    d, n = lengths[0]
    if whole:
        most = parts.where(F.col("d") == d).agg(F.max(F.greatest(F.array_max("high"), -F.array_min("low"))).alias("most")).first().most
        if most * n >= EXACT:
            raise ValueError(f"sums of {n} vectors with entries up to {most} don't fit in 62 bits")
    cells = parts.where(F.col("d") == d).select(F.posexplode(F.arrays_zip("s", "low", "high")).alias("i", "x"))
    rows = sorted(cells.groupBy("i").agg(F.sum("x.s"), F.min("x.low"), F.max("x.high")).collect())  # one for each dimension
    return Sums(n, *(np.array([r[j] for r in rows], kind) for j in (1, 2, 3)))


def covariance(df: DataFrame, vector: str, sums: Sums) -> np.ndarray:
    """Covariance of the vectors of sums' length, divisor n, centred before multiplying."""
    d = len(sums.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((d, d)), 0
        for b in batches:
            own = b.column(0).filter(pa.array(b.column(0).value_lengths().to_numpy() == d))
            if len(own):
                z = sums.centred(matrix(own))
                total += z.T @ z
                n += len(own)
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "cells": pa.array([total[i, i:] for i in range(d)], pa.list_(pa.float64()))})

    parts = df.select(vector).mapInArrow(run, "i int, cells array<double>").select("i", F.posexplode("cells").alias("j", "x"))
    out = np.zeros((d, d))
    for i, j, x in parts.groupBy("i", "j").agg(F.sum("x")).collect():  # half of dims x dims cells
        out[i, i + j] = out[i + j, i] = x / sums.n
    return out


def rounds(d: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of axes by the circle method: each pair comes once, those of a round have no axis in common."""
    ring, out = list(range(d + d % 2)), []
    for _ in range(len(ring) - 1):
        pairs = [(min(p, q), max(p, q)) for p, q in zip(ring[: len(ring) // 2], ring[::-1], strict=False) if max(p, q) < d]
        out.append(tuple(np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.empty(0, np.int64),) * 2)
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def jacobi(matrix: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its unit eigenvectors as columns, by cyclic Jacobi rotations."""
    a, v = np.array(matrix, np.float64), np.eye(len(matrix))
    eps, plan = np.finfo(np.float64).eps, rounds(len(a))
    floor = (eps * np.abs(a).max(initial=0)) ** 2  # products of diagonals that are nothing beside the largest
    for _ in range(sweeps):
        turned = 0
        for p, q in plan:
            off, low, high = a[p, q], a[p, p], a[q, q]
            on = off * off > eps * eps * np.maximum(np.abs(low * high), floor)
            if not on.any():
                continue
            p, q, off, low, high = p[on], q[on], off[on], low[on], high[on]
            turned += len(p)
            theta = (high - low) / (2 * off)
            t = np.where(theta < 0, -1.0, 1.0) / (np.abs(theta) + np.hypot(theta, 1))
            c = 1 / np.hypot(t, 1)
            s = c * t
            for m in (a.T, a, v.T):  # columns of a, its rows, columns of v
                x, y = m[p], m[q]
                m[p], m[q] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
            a[p, p], a[q, q], a[p, q], a[q, p] = low - t * off, high + t * off, 0, 0
        if not turned:
            break
    order = np.argsort(-np.diag(a), kind="stable")
    return np.diag(a)[order], v[:, order]


@dataclass
class Whitening:
    sums: Sums
    values: np.ndarray  #: eigenvalues, falling
    vectors: np.ndarray  #: unit eigenvectors as columns

    def apply(self, df: DataFrame, vector: str, k: int = COMPONENTS) -> DataFrame:
        """df's rows with vectors of the fitted length, with whitened (of the first k components) and, for vectors of integers, deviation."""
        sums, d = self.sums, len(self.sums.sums)
        k = min(k, d)
        own = self.values[:k] > max(d * np.finfo(np.float64).eps * self.values.max(initial=0), 0)
        axes = self.vectors[:, :k][:, own] / np.sqrt(self.values[:k][own])
        whole = sums.sums.dtype == np.int64
        spread = max([abs(sums.n * int(x) - int(s)) for side in (sums.low, sums.high) for x, s in zip(side, sums.sums, strict=True)]) if whole else 0
        small = spread * spread * d < 1 << 63

        @F.arrow_udf("whitened array<double>, deviation decimal(38,0)")
        def whiten(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for vectors in batches:
                x = matrix(vectors)
                z = np.zeros((len(x), k))
                z[:, own] = sums.centred(x) @ axes
                flat = pa.array(z.ravel(), mask=np.tile(~own, len(x)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), flat)
                if not whole:
                    squares = [None] * len(x)
                elif small:
                    squares = ((sums.n * x - sums.sums) ** 2).sum(axis=1).tolist()
                else:
                    squares = ((sums.n * x - sums.sums).astype(object) ** 2).sum(axis=1).tolist()
                yield pa.StructArray.from_arrays([lists, pa.array([None if s is None else Decimal(s) for s in squares], pa.decimal128(38, 0))], ["whitened", "deviation"])

        name = "_whitened"
        while name in df.columns:
            name += "_"
        kept = df.where(F.size(vector) == d).withColumn(name, whiten(vector))
        return kept.select(*[c for c in df.columns if c not in ("whitened", "deviation")], f"{name}.*")


def fit(df: DataFrame, vector: str) -> Whitening | None:
    """The whitening of df's vectors (arrays of long or double; see finite()); None if there are none."""
    bound_batches(df.sparkSession)
    sums = sums_of(df, vector)
    return None if sums is None else Whitening(sums, *jacobi(covariance(df, vector, sums)))


def identity_error(df: DataFrame, whitened: str = "whitened") -> float | None:
    """The largest absolute entry of whitened's covariance minus the identity, over components that have values; None if none has."""
    bound_batches(df.sparkSession)
    rows = df.select(F.filter(whitened, lambda x: x.isNotNull()).alias("x")).where(F.size("x") > 0)
    sums = sums_of(rows, "x")
    return None if sums is None else float(np.abs(covariance(rows, "x", sums) - np.eye(len(sums.sums))).max())


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """All vectors of embeddings whitened, a row for each component."""
    x = table(spark, sf_dir, "embeddings").where(finite("embedding")).select("vec_id", gridded("embedding").alias("x"))
    fitted = fit(x, "x")
    if fitted is None:
        return x.select("vec_id", *(F.lit(None).cast(k).alias(c) for c, k in (("component", "int"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))))
    out = stored(fitted.apply(x, "x").select("vec_id", F.col("deviation").cast("long").alias("deviation"), "whitened"), "whitened")
    trace = fitted.values.sum()
    explained = F.array(*(F.lit(float(e / trace) if trace > 0 else None).cast("double") for e in fitted.values[:COMPONENTS]))
    rows = out.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return rows.select("vec_id", (F.col("i") + 1).alias("component"), F.lit(fitted.sums.n).cast("long").alias("n"), "deviation", "whitened", explained[F.col("i")].alias("explained"), F.lit(identity_error(out)).cast("double").alias("identity_error"))
