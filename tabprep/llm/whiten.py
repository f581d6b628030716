"""Embedding whitening: eigenvectors of a distributed covariance, refined from single to beyond double precision."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import name, written

STEPS, SHIFT = 64, 1_000_000             # an entry c becomes floor(64 * c) + 1000000
REACH = 2.0 ** 40                        # larger scaled entries are outside the number range of the method
NULL_PART = 1e-12                        # a component below this share of the largest variance is rounding, not data
MAX_TURNS = 30
EXACT = 2 ** 53
WIDE = np.longdouble


def _vectors(batch: pa.RecordBatch, dims: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(dims, rows, x)`` per length of vector: the usable rows of a batch and their whole numbers."""
    column = batch.column("vector")
    sizes = np.where(np.asarray(column.is_valid()), np.asarray(column.value_lengths().fill_null(0)), 0)
    flat = column.flatten()
    starts = np.cumsum(sizes) - sizes
    values = np.asarray(flat.fill_null(np.nan), np.float64) * STEPS
    for d in [dims] if dims else np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == d)
        c = values[starts[rows][:, None] + np.arange(d)]
        usable = (np.abs(c) < REACH).all(axis=1)               # false for NaN and infinity too
        yield d, rows[usable], np.floor(c[usable]).astype(np.int64) + SHIFT


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums per dimension, of vectors of each length by themselves."""
    held: dict[int, list] = {}
    for batch in batches:
        for d, rows, x in _vectors(batch):
            if len(rows):
                n, total = held.get(d, (0, 0))
                held[d] = [n + len(rows), total + x.sum(axis=0).astype(object)]
    for d, (n, total) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * d), pa.array(range(d)), pa.array([n] * d), _decimals(total)], ["dims", "place", "n", "total"])


def _gram(y: np.ndarray) -> np.ndarray:
    """Exact sums of products of whole numbers: in doubles while no partial sum can be rounded, else in Python's integers."""
    top = int(np.abs(y).max(initial=0))
    if top * top * max(len(y), 1) < EXACT:
        real = y.astype(np.float64)
        return (real.T @ real).astype(np.int64).astype(object)
    whole = y.astype(object)
    return whole.T @ whole


def _upper(matrix: np.ndarray, values) -> pa.RecordBatch:
    i, j = np.triu_indices(len(matrix))
    return pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), values(matrix[i, j])], ["i", "j", "v"])


def _products(dims: int, centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for _, rows, x in _vectors(batch, dims):
                if len(rows):
                    held = _gram(x - centre) + (0 if held is None else held)
        if held is not None:
            yield _upper(held, _decimals)

    return run


def refined_eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, right to double precision.

    Starts from single-precision eigenvectors and applies the iteration of Ogita and Aishima: from the residuals
    ``I - X'X`` and ``X'VX``, formed in extended precision by matrix products, comes a correction ``X + XE`` that
    squares the error. Pairs of values nearer than the residuals can tell apart only have their vectors made
    orthogonal; each cluster of such values is then solved by itself, as a small problem shifted by its mean, so its
    own spread sets the scale of the error. The extended type has 64 bits where the platform offers it.
    """
    v = np.asarray(v, WIDE)
    size = len(v)
    scale = np.abs(v).max(initial=WIDE(0))
    if scale == 0:
        return np.zeros(size, WIDE), np.eye(size, dtype=WIDE)
    a = v / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    unit, good = np.eye(size, dtype=WIDE), max(4 * size * float(np.finfo(WIDE).eps), 1e-17)
    for _ in range(MAX_TURNS):
        r = unit - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2                    # their rounding must not reach the orthogonality
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        error = 2 * (np.linalg.norm(off.astype(float)) + np.linalg.norm(a.astype(float)) * np.linalg.norm(r.astype(float)))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > error
        turn = np.where(apart, (s + (values[None, :] + values[:, None]) / 2 * r) / np.where(apart, gap, 1), 0)
        x = x + x @ (r / 2 + turn)                             # (s + value * r) / gap, as its even and its odd part
        if max(np.abs(off).max(), np.abs(r).max()) <= good:
            break
        order = np.argsort(-values)
        x, values = x[:, order], values[order]
        cuts = np.flatnonzero(values[:-1] - values[1:] > error) + 1
        for group in np.split(np.arange(size), cuts):
            if len(group) > 1:
                y = x[:, group]
                mean = values[group].mean()
                b = y.T @ (a @ y - mean * y)
                top = np.abs(b).max()
                if top > 0:
                    x[:, group] = y @ np.linalg.eigh(((b + b.T) / (2 * top)).astype(np.float64))[1][:, ::-1].astype(WIDE)
    for _ in range(2):                         # where values are below the extended precision, turns leave a rest of it
        x = x @ (3 * unit - x.T @ x) / 2
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(size)])
    return values * scale, x * np.where(sign == 0, 1, sign)


class _Space:
    """What a task needs to whiten vectors: a whole centre, the exact rest of the mean, and the scaled components."""

    def __init__(self, dims: int, n: int, centre: np.ndarray, rest: list[int], vectors: np.ndarray, spread: np.ndarray):
        self.dims, self.n, self.centre, self.rest = dims, n, centre, rest
        self.mean = np.array([float(Fraction(r, n)) for r in rest])
        self.vectors, self.spread = vectors, spread

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return ((y - self.mean) @ self.vectors) / self.spread

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Sums of squares of ``n * x - S``, exact; null where a long cannot hold one."""
        top = int(np.abs(y).max(initial=0)) * self.n + max(map(abs, self.rest))
        if top * top * self.dims < 2 ** 63:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        return [v if v < 2 ** 63 else None for v in ((self.n * y.astype(object) - np.array(self.rest, object)) ** 2).sum(axis=1)]

    def second_moments(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of products of the whitened values, a last row and column of ones for their sums."""
        held = 0.0
        for batch in batches:
            for _, rows, x in _vectors(batch, self.dims):
                w = np.column_stack([self.whitened(x - self.centre), np.ones(len(rows))])
                held = held + w.T @ w
        if np.ndim(held):
            yield _upper(held, pa.array)

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, x in _vectors(batch, self.dims):
                y = x - self.centre
                w = self.whitened(y)
                ends = np.arange(len(rows) + 1, dtype=np.int32) * w.shape[1]
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").take(pa.array(rows)), pa.array(self.deviations(y), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))], ["key", "deviation", "whitened"])


def _matrix(rows: list, size: int, kind=object) -> np.ndarray:
    out = np.zeros((size, size), kind)
    for i, j, v in rows:
        out[i, j] = out[j, i] = int(v) if kind is object else v
    return out


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """Per usable row: key, ``n``, ``deviation``, ``whitened`` (array), ``explained`` (array), ``identity_error``.

    An entry ``c`` becomes the whole number ``floor(64 * c) + 1000000``. Rows whose vector is null, empty, or holds a null or
    non-finite entry (or one of 2^34 and more) are left out; so are, where lengths differ, all but those of the most frequent
    length, of ties the longest. Sums, and products about the whole number next to the mean, are added up exactly, in
    one scan each, so the covariance (divisor ``n``) depends on no order. Only it, a matrix of the dimension, reaches the
    driver, where ``refined_eigen`` finds the components. ``whitened`` holds the row's centred vector along each, over
    the root of the eigenvalue, ``explained`` the eigenvalues over the trace, ``identity_error`` the largest entry
    by which the covariance of ``whitened``, measured in a scan of its own, misses the identity.

    Components whose variance is only rounding (constant or dependent dimensions, fewer rows than dimensions) are
    left out, so the arrays may be short or empty; ties among eigenvalues get some orthonormal basis. Each of
    several equal rows or keys gets its row, a null key stays null; an empty table gives an empty table. ``deviation``
    is null where it exceeds a long. Only the key and the vector are read, other columns may have any name.
    """
    spark = table.sparkSession
    kind = table.schema[key].dataType.simpleString()
    rows = table.select(name(key).alias("key"), name(vector).alias("vector"))
    light = rows.select("vector")
    totals = written(
        light.mapInArrow(_sums, "dims bigint, place bigint, n bigint, total decimal(38,0)")
        .groupBy("dims", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    top = totals.filter("place = 0").orderBy(F.col("n").desc(), F.col("dims").desc()).first()
    out = f"key {kind}, deviation bigint, whitened array<double>"
    if top is None:
        empty = spark.createDataFrame([], out + ", n bigint, explained array<double>, identity_error double")
        return empty.select(F.col("key").alias(key), "n", "deviation", "whitened", "explained", "identity_error")
    dims, n = top["dims"], top["n"]
    s = [int(r["total"]) for r in totals.filter(F.col("dims") == dims).orderBy("place").collect()]
    centre = [(2 * t + n) // (2 * n) for t in s]
    rest = [t - n * c for t, c in zip(s, centre)]
    at = np.array(centre, np.int64)
    summed = light.mapInArrow(_products(dims, at), "i bigint, j bigint, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    gram = _matrix(summed.collect(), dims)
    v = np.zeros((dims, dims), WIDE)
    for i in range(dims):
        for j in range(i, dims):
            exact = Fraction(n * gram[i, j] - rest[i] * rest[j], n * n)
            near = float(exact)
            v[i, j] = v[j, i] = WIDE(near) + WIDE(float(exact - Fraction(near)))
    values, vectors = refined_eigen(v)
    kept = min(components, int((values > NULL_PART * values[0]).sum()))
    trace = float(np.trace(v))
    space = _Space(dims, n, at, rest, vectors[:, :kept].astype(np.float64), np.sqrt(values[:kept]).astype(np.float64))
    moments = light.mapInArrow(space.second_moments, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    second = _matrix(moments.collect(), kept + 1, float) / n
    error = np.abs(second[:kept, :kept] - np.outer(second[kept, :kept], second[kept, :kept]) - np.eye(kept)).max(initial=0.0)
    explained = F.array(*[F.lit(float(e) / trace) for e in values[:kept]]).cast("array<double>")
    return rows.mapInArrow(space.rows, out).select(
        F.col("key").alias(key), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", explained.alias("explained"),
        F.lit(float(error)).alias("identity_error"))
