"""Whitening of embeddings by polarisation: a covariance matrix from variances alone.

For every dimension i and every pair i < j the squares of the centred x_i and x_i + x_j are
summed; cov(x_i, x_j) = (var(x_i + x_j) - var(x_i) - var(x_j)) / 2. Entries are whole numbers, so
every sum is exact whatever the order and the split, and the matrix is the true one, rounded once.
Its eigenvectors are found on the driver, which holds a matrix of the dimension's square and
nothing that grows with the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import by_value

by_value(__name__)

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Sums travel as high and low halves, which Spark adds up as 64-bit integers.
HALF = 32
SUMS = "i int, j int, high bigint, low bigint"
CHUNK_ROWS = 4096
# Squares of larger entries would not fit the two halves that sums travel in.
LARGEST = 2.0**36


class Fit(NamedTuple):
    """n vectors with sums S; centre = S // n, rest = S - n * centre, both per dimension.

    components: a row for each, to be multiplied by x - S / n; variances: their eigenvalues.
    """

    n: int
    centre: np.ndarray
    rest: list
    components: np.ndarray
    variances: np.ndarray
    total: float


def vectors(table: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """key, as vec_id, and vector (array<double>) of the rows whose vector is whole and finite."""
    rows = table.select(
        F.col(key).cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("vector")
    )
    broken = F.exists("vector", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return rows.where(F.col("vector").isNotNull() & ~broken)


def whole_numbers(column: pa.Array) -> np.ndarray:
    """x = floor(64 c) + 1000000 of all entries, a row for each vector."""
    sizes = np.unique(np.asarray(pa.compute.list_value_length(column)))
    if len(sizes) > 1:
        raise ValueError(f"vectors of {sizes[0]} and of {sizes[-1]} entries cannot share a covariance")
    entries = np.asarray(column.flatten(), np.float64).reshape(len(column), int(sizes[0]))
    if entries.size and np.abs(entries).max() >= LARGEST:
        raise ValueError("an entry is too large for 64-bit whole numbers")
    return np.floor(entries * SCALE).astype(np.int64) + SHIFT


def exact(values: np.ndarray, bound: int) -> np.ndarray:
    """As 64-bit integers where numbers up to bound fit, else as Python's, which always do."""
    return values if bound < 1 << 62 else values.astype(object)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            yield whole_numbers(batch.column("vector").slice(at, CHUNK_ROWS))


def halves(i: np.ndarray, j: np.ndarray, sums: list) -> pa.RecordBatch:
    high, low = [s >> HALF for s in sums], [s & (1 << HALF) - 1 for s in sums]
    return pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(high, pa.int64()),
         pa.array(low, pa.int64())], ["i", "j", "high", "low"],
    )


def plain_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each dimension, and as i = -1 the number of rows and dimensions."""
    n, sums = 0, None
    for x in chunks(batches):
        part = exact(x, len(x) * (int(np.abs(x).max()) if x.size else 0)).sum(axis=0).tolist()
        if sums is not None and len(sums) != len(part):
            raise ValueError(f"vectors of {len(sums)} and of {len(part)} entries cannot share a covariance")
        n, sums = n + len(x), part if sums is None else [a + b for a, b in zip(sums, part, strict=True)]
    if sums is not None:
        yield halves(np.arange(-1, len(sums)), np.full(len(sums) + 1, len(sums)), [n, *sums])


def pair_squares(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of u_i ** 2, as (i, i), and of (u_i + u_j) ** 2, as (i, j), for u = x - centre."""
    d, totals = len(centre), None
    for x in chunks(batches):
        u = x - centre
        u = exact(u, 4 * len(u) * int(np.abs(u).max()) ** 2)
        squares = []
        for i in range(d):
            pairs = u[:, i : i + 1] + u[:, i:]
            pairs[:, 0] = u[:, i]
            squares += (pairs * pairs).sum(axis=0).tolist()
        totals = squares if totals is None else [a + b for a, b in zip(totals, squares, strict=True)]
    if totals is not None:
        i, j = np.triu_indices(d)
        yield halves(i, j, totals)


def added(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Sums over all tasks: one row for each dimension or pair of dimensions."""
    found = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r.i, r.j): (r.high << HALF) + r.low for r in found.collect()}


def fit(rows: DataFrame) -> Fit | None:
    """The exact covariance of all vectors (vec_id, vector) and its eigenvectors; None without rows."""
    sums = added(rows.select("vector").mapInArrow(plain_sums, SUMS))
    if not sums:
        return None
    if len({j for _, j in sums}) > 1:
        raise ValueError(f"vectors of {sorted({j for _, j in sums})} entries cannot share a covariance")
    d = next(iter(sums))[1]
    n = sums[-1, d]
    totals = [sums[i, d] for i in range(d)]
    centre, rest = [s // n for s in totals], [s % n for s in totals]
    middle = np.array(centre, np.int64)
    if not d:
        return Fit(n, middle, rest, np.zeros((0, 0)), np.zeros(0), 0.0)
    squares = added(rows.select("vector").mapInArrow(lambda it: pair_squares(it, middle), SUMS))
    # n * n times a variance is the sum of squares of n * x - S, over n; with u = x - centre that
    # is n * sum(u * u) - sum(u) ** 2, and sum(u) is the rest.
    single = [n * squares[i, i] - rest[i] ** 2 for i in range(d)]
    matrix = np.empty((d, d))
    for i in range(d):
        matrix[i, i] = Fraction(single[i], n * n)
        for j in range(i + 1, d):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            matrix[i, j] = matrix[j, i] = Fraction(both - single[i] - single[j], 2 * n * n)
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(COMPONENTS, d)
    total = float(Fraction(sum(single), n * n))
    noise = d * np.finfo(float).eps * max(values[0], 0.0)
    variances = np.where(values[:kept] > noise, values[:kept], 0.0)
    return Fit(n, middle, rest, axes[:, :kept].T.copy(), variances, total)


def projections(x: np.ndarray, found: Fit) -> np.ndarray:
    """x - S / n on the components, over their standard deviation; 0 where there is none."""
    shares = np.array([r / found.n for r in found.rest])
    spread = np.sqrt(found.variances)
    scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
    return ((x - found.centre).astype(np.float64) - shares) @ (found.components.T * scale)


def deviations(x: np.ndarray, found: Fit) -> pa.Array:
    """The sum of (n x - S) ** 2 over the dimensions, exact: n x - S = n u - rest."""
    u = x - found.centre
    if not u.size:
        return pa.array([0] * len(u), pa.int64()).cast(pa.decimal128(38, 0))
    bound = found.n * (int(np.abs(u).max()) + 1)
    small = u.shape[1] * bound * bound < 1 << 62
    away = (u if small else u.astype(object)) * found.n
    away = away - np.array(found.rest, np.int64 if small else object)
    sums = (away * away).sum(axis=1)
    if small:
        return pa.array(sums).cast(pa.decimal128(19, 0)).cast(pa.decimal128(38, 0))
    from decimal import Context

    wide = Context(prec=38)
    return pa.array([wide.create_decimal(int(s)) for s in sums], pa.decimal128(38, 0))


def comoments(batches: Iterator[pa.RecordBatch], found: Fit) -> Iterator[pa.RecordBatch]:
    """Sums of the products of whitened components, which are centred."""
    k = len(found.variances)
    total = np.zeros((k, k))
    for x in chunks(batches):
        w = projections(x, found)
        total += w.T @ w
    i, j = np.triu_indices(k)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "total"]
    )


def identity_error(rows: DataFrame, found: Fit) -> float:
    """The largest entry of the whitened covariance minus the identity, over components that vary."""
    parts = rows.select("vector").mapInArrow(lambda it: comoments(it, found), "i int, j int, total double")
    varied = found.variances > 0
    errors = [
        abs(r.total / found.n - (r.i == r.j))
        for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
        if varied[r.i] and varied[r.j]
    ]
    return max(errors, default=0.0)


def whiten_batches(batches: Iterator[pa.RecordBatch], found: Fit) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(at, CHUNK_ROWS)
            x = whole_numbers(part.column("vector"))
            w = projections(x, found)
            ends = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), deviations(x, found),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))],
                ["vec_id", "deviation", "whitened"],
            )


def whiten(rows: DataFrame, found: Fit) -> DataFrame:
    """vectors() rows as vec_id, deviation decimal(38, 0), whitened array<double>."""
    return rows.mapInArrow(
        lambda it: whiten_batches(it, found),
        "vec_id bigint, deviation decimal(38,0), whitened array<double>",
    )


def whitened_components(table: DataFrame) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Defined cases: vectors that are NULL or hold a NULL or an entry that is not finite are left
    out. Repeated rows and ids count each for itself, a NULL vec_id is kept. A component without
    variance (fewer different vectors than dimensions) has whitened 0 and explained 0 and is not
    part of the identity error. No vectors, or vectors without entries, give no rows. deviation is
    NULL where a long cannot hold it (whiten() has it as a decimal). Vectors of different lengths,
    and entries of 2 ** 36 and more, stop the job. Other columns are not read.
    """
    rows = vectors(table)
    found = fit(rows)
    if found is None:
        found = Fit(0, np.zeros(0, np.int64), [], np.zeros((0, 0)), np.zeros(0), 0.0)
    error = identity_error(rows, found) if len(found.variances) else 0.0
    return components(whiten(rows, found), found, error)


def components(whitened: DataFrame, found: Fit, error: float) -> DataFrame:
    shares: Callable = lambda v: v / found.total if found.total > 0 else 0.0
    explained = F.array(*[F.lit(float(shares(v))) for v in found.variances]).cast("array<double>")
    return whitened.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"),
        F.lit(found.n).cast("long").alias("n"), F.col("deviation").try_cast("long").alias("deviation"),
        "whitened", F.get(explained, F.col("at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
