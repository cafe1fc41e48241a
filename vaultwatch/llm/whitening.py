"""Embedding whitening by spectral divide-and-conquer on polar decompositions.

Vectors are mapped to whole numbers, so that sums, scatter and covariance are exact and the same whatever the order
of the partitions. The tasks reduce the distinct vectors to one table of products each; the driver gets that table,
whose size is the square of the dimension, and nothing that grows with the rows.

The eigenvectors come from the covariance alone, by polar decompositions (QDWH: dynamically weighted Halley steps by
QR). The polar factor U of A - sI has the eigenvalues 1 and -1, so (U + I) / 2 projects on the eigenvectors above
the shift s. Bases of its range and of the rest split A into two smaller blocks, which are split in turn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwatch.llm.common import settle

SCALE, LIFT = 64, 1_000_000
COMPONENTS = 16
_EPS = np.finfo(float).eps
_EXACT = 2.0**52  # whole numbers below are sums of doubles without an error
_BATCH = 4_096


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric nonsingular matrix, by QDWH steps."""
    x = a / np.linalg.norm(a)
    eye = np.eye(len(x))
    # The least singular value from below: every norm of the inverse bounds that of the spectrum.
    low = max(_EPS / 2, 0.9 / np.linalg.norm(np.linalg.inv(x)))
    for _ in range(60):
        g = (4 * (1 - low**2) / low**4) ** (1 / 3) if low < 1 else 0.0
        f = math.sqrt(1 + g) + math.sqrt(max(0.0, 8 - 4 * g + 8 * (2 - low**2) / (low**2 * math.sqrt(1 + g)))) / 2
        f = max(f, 1.0)
        b = (f - 1) ** 2 / 4
        c = f + b - 1
        q, _r = np.linalg.qr(np.vstack([math.sqrt(c) * x, eye]))
        new = b / c * x + (f - b / c) / math.sqrt(c) * (q[: len(x)] @ q[len(x) :].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (f + b * low**2) / (1 + c * low**2))
        moved = np.linalg.norm(new - x)
        x = new
        if moved < _EPS ** (1 / 3) and 1 - low < 8 * _EPS:
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below the shift; none if the shift parts nothing cleanly."""
    size = len(a)
    try:
        u = polar(a - shift * np.eye(size))
    except np.linalg.LinAlgError:  # the shift is an eigenvalue
        return None
    above = (u + np.eye(size)) / 2
    rank = round(float(np.trace(above)))
    if not 0 < rank < size:
        return None
    # The projector's columns of largest norm span its range; a second pass makes the basis clean.
    order = np.argsort(-np.linalg.norm(above, axis=0), kind="stable")
    q, _ = np.linalg.qr(above[:, order[:rank]])
    q, _ = np.linalg.qr(above @ q, mode="complete")
    high, rest = q[:, :rank], q[:, rank:]
    if np.linalg.norm(rest.T @ a @ high) > 64 * size * _EPS * np.linalg.norm(a):
        return None
    return high, rest


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    whole = np.linalg.norm(a)
    found: list[tuple[float, np.ndarray]] = []
    left = [(a, np.eye(len(a)))]
    while left:
        block, basis = left.pop()
        size = len(block)
        center = float(np.trace(block)) / size
        if size == 1 or np.linalg.norm(block - center * np.eye(size)) <= _EPS * whole:
            found += [(center if size == 1 else float(block[i, i]), basis[:, i]) for i in range(size)]
            continue
        parts = None
        # The middle of the diagonal parts evenly; the mean lies within the spectrum; the others are a little beside it.
        spread = np.linalg.norm(block - center * np.eye(size)) / math.sqrt(size)
        for shift in [float(np.median(np.diag(block))), center, *(center + spread * t for t in (0.1, -0.1, 0.23, -0.23, 0.41, -0.41, 0.67, -0.67, 0.9, -0.9))]:
            parts = _split(block, shift)
            if parts:
                break
        if not parts:  # eigenvalues so close that no shift parts them: any basis is theirs
            found += [(float(block[i, i]), basis[:, i]) for i in range(size)]
            continue
        for part in parts:
            inner = part.T @ block @ part
            left.append(((inner + inner.T) / 2, basis @ part))
    found.sort(key=lambda f: -f[0])
    vectors = _refined(a, np.stack([v for _, v in found], axis=1))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _refined(a: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Newton steps towards orthogonal columns and a diagonal, the last one towards orthogonal columns alone: takes
    away what the splits have rounded."""
    for _ in range(2):
        r = np.eye(len(a)) - q.T @ q
        s = q.T @ a @ q
        values = np.diag(s) / (1 - np.diag(r))
        gap = values[None, :] - values[:, None]
        close = np.abs(gap) <= 2 * (np.linalg.norm(s - np.diag(values)) + np.linalg.norm(a) * np.linalg.norm(r))
        step = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1.0, gap))
        q = q + q @ step
    for _ in range(2):
        q = q + q @ (np.eye(len(a)) - q.T @ q) / 2
    return q


def whole_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, x (whole numbers as little-endian 64-bit integers) and dim, of the rows with all entries finite.

    An entry beyond 64-bit integers after scaling counts as not finite.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            column = column.cast(pa.list_(pa.float64()))
            lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
            values = pc.fill_null(column.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            with np.errstate(invalid="ignore", over="ignore"):
                scaled = np.floor(values * SCALE)
                fine = np.isfinite(values) & (np.abs(scaled) < 2.0**62)
            bad = np.concatenate([[0], np.cumsum(~fine)])
            good = (lengths > 0) & (bad[ends] == bad[ends - lengths])
            x = np.where(fine, scaled, 0).astype("<i8") + LIFT
            chosen = np.flatnonzero(good)
            packed = [x[ends[i] - lengths[i] : ends[i]].tobytes() for i in chosen]
            yield pa.record_batch([batch.column("key").take(pa.array(chosen)), pa.array(packed, pa.binary()), pa.array(lengths[chosen])], names=["key", "x", "dim"])

    rows = table.select(table[key].alias("key"), table[vector].alias("vector"))
    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, x binary, dim long")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), dim)


def _halves(cells: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Whole numbers as two longs that can be summed: high * 2**32 + low."""
    cells = cells.ravel()
    return pa.array((cells >> 32).astype(np.int64)), pa.array((cells & (2**32 - 1)).astype(np.int64))


def _summed(parts: DataFrame, size: int) -> list[int]:
    out = [0] * size
    for cell, high, low in parts.groupBy("cell").agg(F.sum("high"), F.sum("low")).collect():
        out[cell] = int(high) * 2**32 + int(low)
    return out


def _gram(y: np.ndarray) -> np.ndarray:
    """y'y without an error: by doubles where these hold all sums, else by Python's integers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(1, len(y)) < _EXACT:
        return np.rint(y.astype(float).T @ y.astype(float)).astype(np.int64)
    big = y.astype(object)
    return big.T @ big


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """How many vectors there are, and their sum per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim, object), 0
        for batch in batches:
            x = _matrix(batch.column("x"), dim)
            n += len(x)
            total = total + (x >> 32).sum(axis=0).astype(object) * 2**32 + (x & (2**32 - 1)).sum(axis=0).astype(object)
        high, low = _halves(np.append(total, n).astype(object))
        yield pa.record_batch([pa.array(np.arange(dim + 1)), high, low], names=["cell", "high", "low"])

    *total, n = _summed(fit.select("x").mapInArrow(run, "cell long, high long, low long"), dim + 1)
    return n, total


def _covariance(fit: DataFrame, dim: int, n: int, total: list[int]) -> np.ndarray:
    """The covariance, divisor n, each entry rounded once: vectors are centred at the mean rounded to whole numbers
    before they are multiplied, and what that leaves of the mean is taken out in whole numbers too."""
    center = np.array([round(s / n) if abs(s) < 2**52 else (2 * s + n) // (2 * n) for s in total], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter = np.zeros((dim, dim), object)
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH):
                scatter = scatter + _gram(_matrix(batch.column("x").slice(start, _BATCH), dim) - center)
        high, low = _halves(scatter)
        yield pa.record_batch([pa.array(np.arange(dim * dim)), high, low], names=["cell", "high", "low"])

    cells = _summed(fit.select("x").mapInArrow(run, "cell long, high long, low long"), dim * dim)
    left = [s - n * int(c) for s, c in zip(total, center)]
    # int / int is rounded once in Python, however long the integers are.
    return np.array([[(n * cells[i * dim + j] - left[i] * left[j]) / (n * n) for j in range(dim)] for i in range(dim)])


class Whitening:
    """What is learned: n, sums per dimension, components (columns), their eigenvalues and the trace."""

    def __init__(self, n: int, total: list[int], vectors: np.ndarray, values: np.ndarray, trace: float):
        self.n, self.total, self.vectors, self.values, self.trace = n, total, vectors, values, trace
        # The mean as whole part and rest, so that nothing is lost in x - S/n where x is large.
        self.whole = np.array([s // n for s in total], np.int64)
        self.rest = np.array([(s % n) / n for s in total])
        self.project = vectors / np.sqrt(values)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.whole) - self.rest) @ self.project

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per vector the exact sum of (n x - S)^2; null where it is beyond a long."""
        off = x - self.whole
        left = np.array([s - self.n * int(w) for s, w in zip(self.total, self.whole)], object)
        most = self.n * int(np.abs(off).max(initial=0)) + self.n
        if most * most * x.shape[1] < 2**63:
            out = (off * self.n - left.astype(np.int64)) ** 2
            return out.sum(axis=1).tolist()
        out = ((off.astype(object) * self.n - left) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in out]


def learn(fit: DataFrame, dim: int, most: int = COMPONENTS) -> Whitening | None:
    """Fit on the settled column x of distinct vectors; none where the vectors have no spread.

    Components without spread (up to rounding) cannot be scaled to one and are left out.
    """
    n, total = _sums(fit, dim)
    if n == 0:
        return None
    covariance = _covariance(fit, dim, n, total)
    values, vectors = eigen(covariance)
    real = int((values > dim * _EPS * max(values[0], 0)).sum()) if values[0] > 0 else 0
    chosen = min(real, most)
    return Whitening(n, total, vectors[:, :chosen], values[:chosen], float(np.trace(covariance))) if chosen else None


def identity_error(fit: DataFrame, dim: int, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance, centred by its own mean, less the identity."""
    shared = fit.sparkSession.sparkContext.broadcast(model)
    size = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH):
                w = shared.value(_matrix(batch.column("x").slice(start, _BATCH), dim))
                sums += w.sum(axis=0)
                products += w.T @ w
        yield pa.record_batch([pa.array(np.arange(size + size * size)), pa.array(np.concatenate([sums, products.ravel()]))], names=["cell", "v"])

    cells = np.zeros(size + size * size)
    for cell, v in fit.select("x").mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v")).collect():
        cells[cell] = v
    mean = cells[:size] / model.n
    covariance = cells[size:].reshape(size, size) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(size)).max())


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Per row with a vector and component: key, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are left out, and an empty vector is as a null one.
    Of vectors of several lengths those of the most frequent length (of equally frequent ones the longer) are one
    set, and the others are left out. Each distinct vector counts once in the fit, however many rows hold it; each
    of these rows has its results. Repeated and null keys change nothing. Where the vectors have no spread, or the
    table is empty, there are no components and no rows. Eigenvalues are in falling order; of equal ones any basis
    of their space is the right one, the same for all rows. Other columns are not used.
    """
    spark = table.sparkSession
    rows = settle(whole_vectors(table, key, vector), "whole-vectors")
    kind = dict(rows.dtypes)["key"]
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = int(lengths["dim"])
    rows = rows.filter(F.col("dim") == dim)
    fit = settle(rows.select("x").distinct(), "whitening-fit")
    model = learn(fit, dim, most)
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(fit, dim, model)
    shared = spark.sparkContext.broadcast(model)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(explained)
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH):
                part = batch.slice(start, _BATCH)
                x = _matrix(part.column("x"), dim)
                at = np.repeat(np.arange(len(x)), size)
                yield pa.record_batch(
                    [
                        part.column("key").take(pa.array(at)),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(at), shared.value.n)),
                        pa.array(shared.value.deviations(x), pa.int64()).take(pa.array(at)),
                        pa.array(shared.value(x).ravel()),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(len(at), error)),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select("key", "x").mapInArrow(run, schema)
