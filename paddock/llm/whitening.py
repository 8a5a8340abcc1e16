"""Embedding whitening by shifted CholeskyQR.

Entries become whole numbers, x = floor(1024 c) + 100000. The fit list is every vector that takes part; its n
and its sums per dimension S are exact. The centred rows (n x - S) / n are orthogonalised by passes over the
data: each pass sums the rows' Gram matrix (by task, then by row of the matrix over tasks), its Cholesky factor,
shifted in the first pass, is divided out of the rows by triangular solves in the next one, and the factors
are composed into R. The singular values and right vectors of R are those of the centred rows:
variances e (divisor n) and components. ``whitened`` is the centred row's projection on a component over sqrt(e).

What reaches the driver is one d x d matrix a pass, whatever the number of rows; what the tasks get is the
factors, of the same size. Every pass reads the rows anew, so a lost executor costs its tasks alone.

Rows whose vector is null or holds null or non-finite entries go. Vectors of different lengths are fitted and whitened
apart, each length with its own n; an empty vector has no components and gives no row. Repeated rows count
and come as often as they are there; a null vec_id is kept. Entries beyond 2^53 / 1024 count as that bound. A deviation
beyond a long is null. A component without variance (constant or dependent dimensions, one row) has a
null ``whitened``; ``identity_error`` is over those that have variance, null if none has. Where nothing varies
``explained`` is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import ship_package

SCALE, OFFSET = 1024.0, 100_000
LARGEST = float(1 << 53)
COMPONENTS = 8
PASSES = 6              # at most; three do unless dimensions depend on each other
NEAR_IDENTITY = 1e-8    # a Gram matrix so near the identity gives the last factor
NO_VARIANCE = 1e-9      # singular values below this share of the largest count as none
FACTOR_BYTES = 1 << 25  # factors sent to the tasks at once; lengths beyond that wait for the next round
LONG = (1 << 63) - 1

Blocks = Iterator[tuple[np.ndarray, np.ndarray]]


def _vectors(vectors: pa.Array) -> Blocks:
    """For each length in a batch: places of its sound vectors, and their x as a matrix of longs."""
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null entries are NaN
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == d)
        c = flat[starts[at][:, None] + np.arange(d)]
        sound = np.isfinite(c).all(axis=1)
        if sound.any():
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(SCALE * c[sound]), -LARGEST, LARGEST).astype(np.int64) + OFFSET
            yield at[sound], x


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums per length and dimension, in two halves that can't overflow in a task."""
    held: dict[int, list] = {}
    for batch in batches:
        for _, x in _vectors(batch.column("v")):
            s = held.setdefault(x.shape[1], [0, 0, 0])
            s[0] += len(x)
            s[1] = s[1] + (x >> 32).sum(axis=0)
            s[2] = s[2] + (x & 0xFFFFFFFF).sum(axis=0)
    for d, (n, high, low) in held.items():
        yield pa.record_batch([pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)),
                               pa.array(high), pa.array(low)], names=["dim", "i", "n", "high", "low"])


class Fit:
    """What is known of the vectors of one length: n, sums, factors, and in the end the components."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.factors: list[np.ndarray] = []
        self.composed = np.eye(len(sums))
        self.variances = self.components = np.zeros(0)
        self.done = False

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: longs, or Python integers where longs might not hold it."""
        if self.n * int(np.abs(x).max()) + max(map(abs, self.sums)) < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        """The centred rows with every factor found so far divided out."""
        q = self.centred(x)
        for r in self.factors:
            q = solved(q, r)
        return q

    def add(self, gram: np.ndarray) -> None:
        """The next factor, from the Gram matrix of the rows that ``orthogonal`` gives."""
        d, first = len(gram), not self.factors
        if first:
            unit = np.finfo(np.float64).eps / 2
            size = np.linalg.norm(gram, 2)
            shift = 11 * (min(self.n, 1 << 20) * d + d * (d + 1)) * unit * size
            gram = gram + shift * np.eye(d)
        try:
            factor = np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:  # dependent dimensions: the symmetric root, which takes zeros
            values, vectors = np.linalg.eigh(gram)
            factor = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T
            self.done = True
        near = np.abs(gram - np.eye(d)).max() < NEAR_IDENTITY
        self.factors.append(factor)
        self.composed = factor @ self.composed
        self.done = self.done or (near and not first) or len(self.factors) == PASSES

    def finish(self) -> None:
        _, values, right = np.linalg.svd(self.composed)
        self.variances, self.components = values * values / self.n, right
        self.varies = values > NO_VARIANCE * values[0] if values[0] > 0 else np.zeros(len(values), bool)
        self.factors = []

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        """The first components of each row; NaN where there is no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            w = self.centred(x) @ self.components[:k].T / np.sqrt(self.variances[:k])
        return np.where(self.varies[:k], w, np.nan)

    def squares(self, x: np.ndarray) -> list[int | None]:
        """The sum of squared deviations of each row; None beyond a long."""
        dev = self.deviations(x)
        if dev.dtype != object and int(np.abs(dev).max()) ** 2 * dev.shape[1] < 1 << 62:
            return (dev * dev).sum(axis=1).tolist()
        sums = (dev.astype(object) ** 2).sum(axis=1)
        return [s if s <= LONG else None for s in sums.tolist()]


def solved(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q R = X for an upper triangular R, by substitution column by column."""
    q = np.empty_like(x)
    for j in range(r.shape[0]):
        q[:, j] = (x[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _matrix(rows_of):
    """Per task and length the Gram matrix of what ``rows_of(dim, x)`` gives, a row of the matrix in each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _vectors(batch.column("v")):
                if (q := rows_of(x.shape[1], x)) is not None:
                    held[x.shape[1]] = held.get(x.shape[1], 0.0) + q.T @ q
        part = TaskContext.get().partitionId()
        for d, g in held.items():
            k = len(g)
            yield pa.record_batch([pa.array(np.full(k, d, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(np.full(k, part, np.int32)),
                                   pa.array([row.tobytes() for row in g])], names=["dim", "i", "part", "row"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the same (dim, i) added up."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for dim, i, row in zip(*(batch.column(c).to_pylist() for c in ("dim", "i", "row")), strict=True):
            held[dim, i] = held.get((dim, i), 0.0) + np.frombuffer(row)
    keys = list(held)
    yield pa.record_batch([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                           pa.array([held[k].tobytes() for k in keys], pa.binary())], names=["dim", "i", "row"])


def _gram(rows: DataFrame, rows_of) -> dict[int, np.ndarray]:
    """The Gram matrices by length: a matrix each, however many rows there are."""
    parts = rows.mapInArrow(_matrix(rows_of), "dim int, i int, part int, row binary")
    sums = (parts.repartition("dim", "i").sortWithinPartitions("dim", "i", "part")
            .mapInArrow(_added, "dim int, i int, row binary").orderBy("dim", "i").collect())
    found: dict[int, list] = {}
    for r in sums:
        found.setdefault(r["dim"], []).append(np.frombuffer(r["row"]))
    return {d: np.array(g) for d, g in found.items()}


def _rounds(lengths: list[int]) -> Iterator[list[int]]:
    """Lengths whose factors may be sent to the tasks together."""
    some, size = [], 0
    for d in lengths:
        if some and size + PASSES * d * d * 8 > FACTOR_BYTES:
            yield some
            some, size = [], 0
        some.append(d)
        size += PASSES * d * d * 8
    if some:
        yield some


def fit(rows: DataFrame, lengths: list[int]) -> dict[int, Fit]:
    """The fits of some lengths. ``rows`` has v, the vectors as arrays of doubles."""
    big = "decimal(38,0)"
    sums = (rows.mapInArrow(_sums, "dim int, i int, n long, high long, low long").filter(F.col("dim").isin(lengths))
            .groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(big)).alias("high"), F.sum(F.col("low").cast(big)).alias("low"))
            .orderBy("dim", "i").collect())
    by_length: dict[int, list] = {}
    for r in sums:
        by_length.setdefault(r["dim"], []).append((r["n"], (int(r["high"]) << 32) + int(r["low"])))
    fits = {d: Fit(s[0][0], [x for _, x in s]) for d, s in by_length.items()}
    while open_ := {d: f for d, f in fits.items() if not f.done}:
        grams = _gram(rows, lambda d, x, open_=open_: open_[d].orthogonal(x) if d in open_ else None)
        for d, f in open_.items():
            f.add(grams[d])
    for f in fits.values():
        f.finish()
    return fits


def _identity_errors(rows: DataFrame, fits: dict[int, Fit], k: int) -> dict[int, float | None]:
    """By length: how far the covariance of the whitened rows is from the identity."""
    def with_one(d: int, x: np.ndarray):
        if d not in fits:
            return None
        w = fits[d].whitened(x, k)
        return np.hstack([w[:, fits[d].varies[:k]], np.ones((len(w), 1))])
    out = {}
    for d, g in _gram(rows, with_one).items():
        n, mean = fits[d].n, g[-1, :-1] / fits[d].n
        cov = g[:-1, :-1] / n - np.outer(mean, mean)
        out[d] = float(np.abs(cov - np.eye(len(cov))).max()) if len(cov) else None
    return out


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whitened(fits: dict[int, Fit], errors: dict[int, float | None], most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").cast(pa.int64())
            for at, x in _vectors(batch.column("v")):
                if (f := fits.get(x.shape[1])) is None:
                    continue
                k, rows = min(most, x.shape[1]), len(x)
                whole = f.variances.sum()
                explained = [float(e / whole) if whole > 0 else None for e in f.variances[:k]]
                w = f.whitened(x, k).reshape(-1)
                squares = np.repeat(np.array(f.squares(x), object), k).tolist()
                yield pa.record_batch([
                    ids.take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, f.n, np.int64)), pa.array(squares, pa.int64()), pa.array(w, mask=np.isnan(w)),
                    pa.array(explained * rows, pa.float64()), pa.array([errors.get(x.shape[1])] * (rows * k), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whitened(spark: SparkSession, embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each sound vector and each of its first components."""
    ship_package(spark)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.size("v") > 0)
    # a row per length: never more than the longest vector has entries
    lengths = [r["dim"] for r in rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").collect()]
    out = None
    for some in _rounds(lengths):
        fits = fit(rows.filter(F.size("v").isin(some)), some)
        part = rows.filter(F.size("v").isin(some))
        errors = _identity_errors(part, fits, components)
        done = part.mapInArrow(_whitened(fits, errors, components), _OUT)
        out = done if out is None else out.unionByName(done)
    return out if out is not None else spark.createDataFrame([], _OUT)
