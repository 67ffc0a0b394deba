"""Whitening of vectors by covariances that are sums of squares alone.

Entries become whole numbers. Var(a + b) - Var(a) - Var(b) is twice the covariance of a
and b, so the exact sums of squared centred values of every dimension, and of every sum
of two dimensions, give the whole matrix. They are whole numbers too (the values are
centred by n times the mean), so neither the order of the rows nor a large offset shows.
Sums are taken per task and added by Spark; the driver gets one row per pair of dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCALE, OFFSET = 64, 1_000_000
#: Rows whose squares are added up before they become Python numbers.
BLOCK = 1024
#: Below this a square times BLOCK fits 62 bits; its square is where two such halves end.
HALF = 1 << 26
EXACT = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """What is fitted: rows, sums per dimension, and per component its eigenvalue, share and direction."""

    n: int
    sums: list[int]
    values: np.ndarray
    explained: np.ndarray
    vectors: np.ndarray


def whole_numbers(column: pa.ListArray, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows that hold a vector, floor(64 c) + 1000000 of their entries).

    A vector that is null or empty, or holds a null or a non-finite entry, is none. Two
    lengths among the rest raise ValueError, as do entries beyond 2**52 / 64.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    lengths[column.is_null().to_numpy(zero_copy_only=False)] = 0
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become nan
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    rows = np.flatnonzero(good)
    if not len(rows):
        return rows, np.zeros((0, dims or 0), np.int64)
    dims = dims or int(lengths[rows[0]])
    if (lengths[rows] != dims).any():
        raise ValueError("vectors of different lengths")
    x = np.floor(SCALE * flat[np.repeat(good, lengths)].reshape(len(rows), dims))
    if np.abs(x).max() >= 1 << 52:
        raise ValueError("an entry is too large for a whole number of double precision")
    return rows, x.astype(np.int64) + OFFSET


def sums_of_squares(values: np.ndarray) -> list[int]:
    """Exact sums of the squares of each column of whole numbers; blocks of them stay within 64 bits."""
    most = int(np.abs(values).max(initial=0))
    if most < HALF:
        return [sum(c) for c in zip(*(np.einsum("ij,ij->j", b, b).tolist() for b in _blocks(values)), strict=True)]
    if most < HALF * HALF:
        high, low = values >> 26, values & (HALF - 1)
        total = [0] * values.shape[1]
        for h, m in zip(_blocks(high), _blocks(low), strict=True):
            parts = (np.einsum("ij,ij->j", one, other).tolist() for one, other in ((h, h), (h, m), (m, m)))
            total = [t + (hh << 52) + (hm << 27) + mm for t, hh, hm, mm in zip(total, *parts, strict=True)]
        return total
    return [sum(v * v for v in column) for column in values.T.tolist()]


def _blocks(values: np.ndarray) -> list[np.ndarray]:
    return [values[at : at + BLOCK] for at in range(0, max(len(values), 1), BLOCK)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S; Python numbers where 64 bits might not do."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _exact(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], EXACT)


def _totals(vectors: DataFrame, vector_col: str) -> tuple[int, list[int]]:
    """Rows that hold a vector, and the sums of their whole numbers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, dims = 0, [], None
        for batch in batches:
            rows, x = whole_numbers(batch.column(0), dims)
            if len(rows):
                n, dims = n + len(rows), x.shape[1]
                own = [sum(c) for c in zip(*(b.sum(0).tolist() for b in _blocks(x)), strict=True)]
                sums = [a + b for a, b in zip(sums or [0] * dims, own, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()), _exact(sums)], ["i", "n", "total"])

    parts = vectors.select(F.col(vector_col).alias("v")).mapInArrow(add, "i int, n long, total decimal(38,0)")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()  # one row per dimension
    if len({r["n"] for r in rows}) > 1:
        raise ValueError("vectors of different lengths")
    return (rows[0]["n"] if rows else 0), [int(r["total"]) for r in rows]


def _covariance(vectors: DataFrame, vector_col: str, n: int, sums: list[int]) -> np.ndarray:
    """The covariance matrix times n squared, each entry rounded once: from Var(a), Var(b) and Var(a + b)."""
    dims = len(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0] * (dims - i) for i in range(dims)]
        for batch in batches:
            _, x = whole_numbers(batch.column(0), dims)
            for block in _blocks(centred(x, n, sums)) if len(x) else ():
                for i in range(dims):
                    pairs = block[:, i:] + block[:, i : i + 1]
                    pairs[:, 0] = block[:, i]  # the dimension itself stands where its sum with itself would
                    total[i] = [a + b for a, b in zip(total[i], sums_of_squares(pairs), strict=True)]
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _exact([v for row in total for v in row])], ["i", "j", "squares"])

    parts = vectors.select(F.col(vector_col).alias("v")).mapInArrow(add, "i int, j int, squares decimal(38,0)")
    squares = {(r["i"], r["j"]): int(r["squares"]) for r in parts.groupBy("i", "j").agg(F.sum("squares").alias("squares")).collect()}
    out = np.zeros((dims, dims))
    for (i, j), both in squares.items():
        twice = 2 * both if i == j else both - squares[i, i] - squares[j, j]
        out[i, j] = out[j, i] = float(Fraction(twice, 2 * n))
    return out


def fit(vectors: DataFrame, vector_col: str = "embedding", most: int = 32) -> Whitening:
    """Components of the vectors' covariance, by falling eigenvalue.

    Only vectors without null or non-finite entries count (see `whole_numbers`).
    Repeated rows count as often as they occur. A direction in which the vectors do
    not vary, up to rounding, is no component, as nothing can be divided by its
    deviation; there are none without vectors, or if all are equal.
    """
    n, sums = _totals(vectors, vector_col)
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros(0), np.zeros((0, 0)))
    scaled = _covariance(vectors, vector_col, n, sums)
    values, directions = np.linalg.eigh(scaled)
    values, directions = values[::-1], directions[:, ::-1]
    count = min(most, int((values > len(sums) * np.finfo(float).eps * max(values[0], 0)).sum()))
    trace = float(np.trace(scaled))
    return Whitening(n, sums, values[:count] / n / n, values[:count] / trace if trace else values[:count], np.ascontiguousarray(directions[:, :count]))


def _projected(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """(n x - S, whitened) of some rows."""
    y = centred(x, model.n, model.sums)
    return y, (y.astype(np.float64) / model.n) @ model.vectors / np.sqrt(model.values)


def transform(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, component, n, deviation, whitened, explained: one row per vector and component.

    deviation is the sum over the dimensions of (n x - S)**2, a whole number of 38 digits
    at most. Rows without a vector have no rows; a null id stays null and repeated rows
    are repeated.
    """
    count = len(model.values)
    kind = vectors.schema[id_col]
    schema = StructType([kind, *StructType.fromDDL("component int, n long, deviation decimal(38,0), whitened double, explained double").fields])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = whole_numbers(batch.column(1), len(model.sums))
            for at in range(0, len(rows), BLOCK):
                y, out = _projected(x[at : at + BLOCK], model)
                deviation = sums_of_squares(np.ascontiguousarray(y.T))
                ids = batch.column(0).take(pa.array(np.repeat(rows[at : at + BLOCK], count)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(y))), pa.array(np.full(len(y) * count, model.n)),
                     _exact(deviation).take(pa.array(np.repeat(np.arange(len(y)), count))), pa.array(out.ravel()), pa.array(np.tile(model.explained, len(y)))],
                    schema.names)

    chosen = vectors.select(F.col(id_col), F.col(vector_col).alias("v"))
    return (chosen if count else chosen.where("false")).mapInArrow(project, schema)


def identity_error(vectors: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity; 0 without components."""
    count = len(model.values)
    if not count:
        return 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, scatter = 0, np.zeros(count), np.zeros((count, count))
        for batch in batches:
            _, x = whole_numbers(batch.column(0), len(model.sums))
            for at in range(0, len(x), BLOCK):
                _, w = _projected(x[at : at + BLOCK], model)
                own = w.mean(0)
                step = own - mean
                scatter += (w - own).T @ (w - own) + np.outer(step, step) * n * len(w) / (n + len(w))
                mean, n = mean + step * len(w) / (n + len(w)), n + len(w)
        i, j = np.triu_indices(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (i.astype(np.int32), j.astype(np.int32), n * mean[i], n * mean[j], n * mean[i] * mean[j] + scatter[i, j])], ["i", "j", "a", "b", "ab"])

    parts = vectors.select(F.col(vector_col).alias("v")).mapInArrow(add, "i int, j int, a double, b double, ab double")
    n = model.n
    worst = F.max(F.abs(F.col("ab") / n - F.col("a") / n * F.col("b") / n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))
    return float(parts.groupBy("i", "j").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("ab").alias("ab")).agg(worst).first()[0])
