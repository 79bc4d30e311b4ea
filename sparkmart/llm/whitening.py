"""Embedding whitening by the FEAST eigensolver.

The covariance of integer-scaled vectors is summed by Spark in whole numbers, so it
does not depend on how the rows are dealt.  Its largest eigenvalues are sliced
into intervals by inertia counts (the signs of an LDL^T factorization tell how many
eigenvalues lie below a shift).  For each interval a task applies FEAST: a Gauss
quadrature of shifted complex solves on a circle around the interval filters a
subspace, Rayleigh-Ritz extracts eigenpairs from it, and both repeat until the
residuals vanish.  The pairs found must be as many as the inertia counts say;
otherwise the subspace is enlarged.  A pass over the rows then projects them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.session import reliable_checkpoint

COMPONENTS = 8
FACTOR = 1024.0
SHIFT = 100_000
BIGGEST = float(1 << 31)             # of a scaled entry; a vector beyond it counts as not finite
NODES = 8                            # quadrature nodes of the half circle
SLICE = 4                            # eigenvalues of one interval, unless they nearly coincide
SMALL = 1 << 20                      # centred entries below it are multiplied as doubles, exactly
SLAB = 1 << 12                       # rows of one such product: 2^40 * 2^12 < 2^53
LIMB = 40                            # sums travel as two numbers of this many low bits and the rest


def _scaled(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the usable vectors, their floor(1024 c) as longs)."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fits = lengths == size
    flat = vectors.filter(pa.array(fits)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(flat.reshape(-1, size) * FACTOR)
        good = (np.abs(scaled) < BIGGEST).all(axis=1)          # false for NaN
    return np.flatnonzero(fits)[good], scaled[good].astype(np.int64)


def _sums_of(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, np.int64)
        for batch in batches:
            _, y = _scaled(batch.column(0), size)
            n += len(y)
            total += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, size)), pa.array(np.concatenate(([n], total)))], names=["i", "s"])
    return run


def gram(y: np.ndarray) -> np.ndarray:
    """Exact y^T y of longs, as Python integers in an object array."""
    d = y.shape[1]
    small = (np.abs(y) < SMALL).all(axis=1) if len(y) else np.zeros(0, bool)
    near, far = y[small].astype(float), y[~small].astype(object)
    out = far.T @ far if len(far) else np.zeros((d, d), object)
    for i in range(0, len(near), SLAB):
        part = near[i:i + SLAB]
        out = out + (part.T @ part).astype(np.int64)
    return out


def _grams_of(size: int, centre: np.ndarray):
    """Rows (i, high, low): the task's sums of products of centred entry i with all
    entries, as whole multiples of 2^LIMB and the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), object)
        for batch in batches:
            total = total + gram(_scaled(batch.column(0), size)[1] - centre)
        high = np.array([[int(v) >> LIMB for v in row] for row in total], np.int64).reshape(size, size)
        low = np.array([[int(v) & ((1 << LIMB) - 1) for v in row] for row in total], np.int64).reshape(size, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(list(high), pa.list_(pa.int64())), pa.array(list(low), pa.list_(pa.int64()))],
            names=["i", "high", "low"])
    return run


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums (i, high, low) rows of equal i."""
    total: dict = {}
    for batch in batches:
        i = batch.column(0).to_pylist()
        parts = [np.array(batch.column(j).to_pylist(), np.int64) for j in (1, 2)]
        for r, key in enumerate(i):
            if key in total:
                total[key] += (parts[0][r], parts[1][r])
            else:
                total[key] = np.array([parts[0][r], parts[1][r]])
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total)), *(pa.array([v[j] for v in total.values()], pa.list_(pa.int64())) for j in (0, 1))],
            names=["i", "high", "low"])


def below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric matrix lie below the shift: the negative
    pivots of LDL^T with complete pivoting (each 2x2 pivot has one)."""
    m = a - shift * np.eye(len(a))
    alpha = (1 + 17 ** 0.5) / 8
    count = 0
    while len(m):
        diagonal = np.abs(np.diag(m))
        k = int(diagonal.argmax())
        off = np.abs(m)
        np.fill_diagonal(off, 0)
        r, s = divmod(int(off.argmax()), len(m))
        if diagonal[k] >= alpha * off[r, s]:
            if diagonal[k] == 0:                # the rest is zero
                return count
            count += m[k, k] < 0
            pivot = [k]
        else:
            count += 1
            pivot = [r, s]
        rest = np.setdiff1d(np.arange(len(m)), pivot)
        side = m[np.ix_(rest, pivot)]
        m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(m[np.ix_(pivot, pivot)], side.T)
        m = (m + m.T) / 2
    return int(count)


def slices(a: np.ndarray, wanted: int, most: int = SLICE) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in it) of intervals, highest first, that hold at least the
    ``wanted`` largest positive eigenvalues of a positive semidefinite matrix."""
    d = len(a)
    top = float(np.abs(a).sum(axis=1).max()) * (1 + 1e-9)
    floor = top * d * float(np.finfo(float).eps)
    found: list[tuple[float, float, int]] = []
    if not top > 0:
        return found
    todo = [(floor, top, below(a, floor), below(a, top))]
    while todo and sum(f[2] for f in found) < wanted:
        lo, hi, under_lo, under_hi = todo.pop()
        if under_hi == under_lo:
            continue
        if under_hi - under_lo <= most or hi - lo <= 1e-12 * top:
            found.append((lo, hi, under_hi - under_lo))
            continue
        middle = (lo + hi) / 2 if hi < 4 * lo else float(np.sqrt(lo * hi))
        under = below(a, middle)
        todo += [(lo, middle, under_lo, under), (middle, hi, under, under_hi)]
    return found


def feast(a: np.ndarray, lo: float, hi: float, count: int, rounds: int = 30, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of the symmetric matrix in the interval, whose number
    inertia counts gave."""
    d = len(a)
    radius, centre = (hi - lo) / 2, (hi + lo) / 2
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi / 2 * (1 - x))
    scale = np.abs(a).sum(axis=1).max()
    width = min(d, 2 * count + 4)
    while True:
        y = np.random.default_rng(seed).standard_normal((d, width))
        for _ in range(rounds):
            if width < d:
                q = np.zeros((d, width))
                for node, weight in zip(turn, w, strict=True):
                    solved = np.linalg.solve((centre + radius * node) * np.eye(d) - a, y)
                    q += weight / 2 * (radius * node * solved).real
            else:
                q = y
            q = np.linalg.qr(q)[0]
            values, inner = np.linalg.eigh(q.T @ a @ q)        # Rayleigh-Ritz
            y = q @ inner
            best = np.argsort(np.maximum(np.abs(values - centre) - radius, 0), kind="stable")[:count]
            residual = np.linalg.norm(a @ y[:, best] - y[:, best] * values[best], axis=0)
            inside = np.abs(values[best] - centre) <= radius + 1e-12 * scale
            if inside.all() and (residual <= 4e-15 * d ** 0.5 * scale).all():
                return values[best], y[:, best]
        if width == d:
            return values[best], y[:, best]
        width, seed = min(d, 2 * width), seed + 1


@dataclass(frozen=True)
class Whitening:
    """What the fit learned: ``vectors`` has a column for each component."""
    n: int
    centre: np.ndarray               # whole numbers near the mean of floor(1024 c)
    rest: list[int]                  # sums of the centred entries
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def fit(embeddings: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    spark = embeddings.sparkSession
    vectors = embeddings.select("embedding")
    got = {r.i: int(r.s) for r in vectors.mapInArrow(_sums_of(size), "i bigint, s bigint").groupBy("i")
           .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    n, total = got.get(-1, 0), [got.get(i, 0) for i in range(size)]
    if not n:
        return Whitening(0, np.zeros(size, np.int64), [0] * size, np.zeros(0), np.zeros((size, 0)), 0.0)
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    rest = [s - n * int(c) for s, c in zip(total, centre, strict=True)]
    rows = (vectors.mapInArrow(_grams_of(size, centre), "i bigint, high array<bigint>, low array<bigint>")
            .repartition(min(size, 64), "i").mapInArrow(_add_rows, "i bigint, high array<bigint>, low array<bigint>").collect())
    cov = np.zeros((size, size))
    for r in rows:                   # exact in whole numbers up to the last division
        cov[r.i] = [(n * ((h << LIMB) + lo) - rest[r.i] * rest[j]) / (n * n) for j, (h, lo) in enumerate(zip(r.high, r.low, strict=True))]
    found = slices(cov, components)
    if not found:
        return Whitening(n, centre, rest, np.zeros(0), np.zeros((size, 0)), float(np.trace(cov)))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, vectors = feast(shared.value, lo, hi, count)
                yield pa.RecordBatch.from_arrays([pa.array(list(vectors.T), pa.list_(pa.float64()))], names=["vector"])

    shared = spark.sparkContext.broadcast(cov)         # size x size, whatever the rows
    intervals = spark.createDataFrame(found, "lo double, hi double, n int").repartition(len(found))
    basis = np.linalg.qr(np.array([r.vector for r in intervals.mapInArrow(solve, "vector array<double>").collect()]).T)[0]
    values, inner = np.linalg.eigh(basis.T @ cov @ basis)      # neighbours of different intervals become orthogonal
    order = np.argsort(-values)[:components]
    return Whitening(n, centre, rest, values[order], basis @ inner[:, order], float(np.trace(cov)))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, deviation decimal, whitened array<double>, n, explained array<double>, identity_error)
    of every usable row of ``embeddings`` (vec_id, embedding).

    A vector that is null, empty, holds a null or non-finite entry or one of 2^21 or
    more, or has another length than most vectors (of equally frequent lengths the
    greatest) is not usable.  ``whitened`` has an entry for each of the ``components``
    largest positive eigenvalues, fewer where the rows vary in fewer directions;
    ``explained`` has their shares of the total variance.  Repeated rows and null
    ids are rows like others, other columns are ignored, no usable rows give none."""
    table = embeddings.select("vec_id", "embedding")
    common = (table.select(F.size("embedding").alias("size")).where("embedding IS NOT NULL AND size > 0").groupBy("size").count()
              .orderBy(F.desc("count"), F.desc("size")).first())
    size = common.size if common else 1
    model = fit(table, size, components)
    k = len(model.values)
    kept = f"vec_id {table.schema['vec_id'].dataType.simpleString()}"
    mean_left = np.array([r / model.n for r in model.rest]) if model.n else np.zeros(size)
    scale = model.vectors / np.sqrt(model.values)
    n, rest = model.n, np.array(model.rest, object)
    largest = max((abs(int(r)) for r in model.rest), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, y = _scaled(batch.column(1), size)
            if not len(at):
                continue
            y = y - model.centre
            biggest = max(int(np.abs(y).max()), 1)
            whole = y if max(biggest * biggest, biggest * largest) * size < 1 << 62 else y.astype(object)
            # the sum of (n y - rest)^2, multiplied out so that only three numbers a row leave 64 bits
            square = (whole * whole).sum(axis=1).astype(object)
            cross = (whole * (rest if whole.dtype == object else rest.astype(np.int64))).sum(axis=1).astype(object)
            deviation = n * n * square - 2 * n * cross + int((rest * rest).sum())
            # row by row the same sums, however the rows are batched
            out = np.einsum("ri,ik->rk", y - mean_left, scale)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0)),
                 pa.array(list(out), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])

    rows = reliable_checkpoint(table.mapInArrow(run, f"{kept}, deviation decimal(38,0), whitened array<double>"))
    entries = [F.col("whitened")[i] for i in range(k)]
    error = F.greatest(*[F.abs(F.covar_pop(entries[i], entries[j]) - float(i == j)) for i in range(k) for j in range(i + 1)],
                       F.lit(0.0), F.lit(0.0))
    measured = rows.agg(error.alias("identity_error"))             # one row
    return rows.crossJoin(F.broadcast(measured)).withColumn("n", F.lit(n).cast("long")).withColumn(
        "explained", F.array(*[F.lit(float(v) / model.trace) for v in model.values]).cast("array<double>"))
