"""Embedding whitening: covariances out of variances alone, exact up to the eigenvectors.

An entry c counts as the whole number x = floor(64 c) + 1,000,000. For every dimension and every
sum of two dimensions the tasks add up squared centred values; since
var(a + b) = var(a) + var(b) + 2 cov(a, b), differences of those variances give all covariances.

All sums are whole numbers. Values are centred at the whole number m nearest to their mean before
they are squared; with z = x - m, r = sum of z and Q = sum of z^2 over n vectors, the sum of
(n x - S)^2 is n (n Q - r^2) without any rounding. Division comes last.

Defined cases: vectors that are null, empty or hold a null, non-finite or over-long entry
(|c| >= 2^56, whose x is no long) are dropped; of vectors with differing lengths those of the most
frequent length stay (of two as frequent, the longer). Repeated rows, ids and null ids count as
often as they occur. A component without variance has no whitened value (null). With no vector
left there are no rows. Other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table

COMPONENTS = 32
OFFSET = 1_000_000
LONGEST = float(1 << 56)
#: Sums leave a task as two whole numbers below this base and above it, so no sum can overflow.
LIMB = 10 ** 18
_LONG = 1 << 62
_SUMS = "i int, j int, low decimal(38,0), high decimal(38,0)"
_PARTS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("low", pa.decimal128(38, 0)), ("high", pa.decimal128(38, 0))])


@dataclass(frozen=True)
class Whitening:
    """The fit: ``centre`` + ``rest`` / ``n`` is the mean of x, ``axes`` has a component per column."""

    n: int
    centre: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    trace: float

    @property
    def scales(self) -> np.ndarray:
        """Square roots of the eigenvalues; NaN for components without variance."""
        floor = self.values[0] * len(self.centre) * np.finfo(float).eps if len(self.values) else 0.0
        return np.sqrt(np.where(self.values > max(floor, 0.0), self.values, np.nan))

    def project(self, x: np.ndarray) -> np.ndarray:
        offsets = (x - self.centre).astype(np.float64) - self.rest.astype(np.float64) / self.n
        return offsets @ self.axes / self.scales

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2 per vector; None where it is no long."""
        z = x - self.centre
        reach = self.n * int(np.abs(z).max(initial=0)) + int(np.abs(self.rest).max(initial=0))
        if z.shape[1] * reach * reach < _LONG:
            y = self.n * z - self.rest
            return np.einsum("ij,ij->i", y, y).tolist()
        exact = [sum((self.n * a - b) ** 2 for a, b in zip(row, self.rest.tolist())) for row in z.tolist()]
        return [d if d < 1 << 63 else None for d in exact]


def usable(vectors: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and ``v`` (array of doubles) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    # nanvl turns NaN into infinity, so one comparison finds NaN, infinity and over-long entries.
    fit = F.forall(v, lambda c: F.coalesce(F.abs(F.nanvl(c, F.lit(float("inf")))) < LONGEST, F.lit(False)))
    whole = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(fit).select(*columns, v.alias("v"))
    lengths = whole.groupBy(F.size("v").alias("d")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return whole.where(F.size("v") == (most["d"] if most else -1))


def whole_numbers(column: pa.Array) -> np.ndarray:
    """A column of vectors of one length as their x."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    x = np.floor(64.0 * flat).astype(np.int64) + OFFSET
    return x.reshape(len(column), -1) if len(column) else x.reshape(0, 0)


def squares(z: np.ndarray) -> dict[tuple[int, int], int]:
    """Per dimension (i, i) the sum of z_i^2, per pair (i, j) the sum of (z_i + z_j)^2, exact."""
    rows, d = z.shape
    largest = 2 * int(np.abs(z).max(initial=0))
    if largest * largest * max(rows, 1) >= _LONG:
        if largest * largest < _LONG and rows > 1:
            half = rows // 2
            first, second = squares(z[:half]), squares(z[half:])
            return {key: first[key] + second[key] for key in first}
        z = z.astype(object)
    found = {}
    for i in range(d):
        sums = np.concatenate([z[:, i:i + 1], z[:, i + 1:] + z[:, i:i + 1]], axis=1)
        totals = (sums * sums).sum(axis=0) if sums.dtype == object else np.einsum("ij,ij->j", sums, sums)
        found.update(((i, i + k), int(total)) for k, total in enumerate(totals))
    return found


def column_sums(x: np.ndarray) -> dict[tuple[int, int], int]:
    largest = int(np.abs(x).max(initial=0))
    sums = (x if largest * max(len(x), 1) < _LONG else x.astype(object)).sum(axis=0)
    return {(i, i): int(total) for i, total in enumerate(sums)}


def _added(vectors: DataFrame, part) -> dict[tuple[int, int], int]:
    """The sums that ``part`` gives per batch, over all vectors: a row per sum leaves a task, and
    the driver gets one row per dimension or pair of dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], int] = {}
        for batch in batches:
            if batch.num_rows:
                for key, total in part(whole_numbers(batch.column("v"))).items():
                    held[key] = held.get(key, 0) + total
        if held:
            cut = [divmod(total, LIMB) for total in held.values()]
            columns = [[i for i, _ in held], [j for _, j in held], [low for _, low in cut], [high for high, _ in cut]]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _PARTS.types)], schema=_PARTS)

    summed = vectors.select("v").mapInArrow(run, _SUMS).groupBy("i", "j").agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    return {(row.i, row.j): int(row.low) + int(row.high) * LIMB for row in summed.collect()}


def covariances(n: int, rest: list[int], totals: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix, each entry the double nearest to the exact quotient."""
    def spread(key: tuple[int, int]) -> int:
        i, j = key
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * totals[key] - r * r

    spreads = {key: spread(key) for key in totals}
    matrix = np.empty((len(rest), len(rest)))
    for i, j in totals:
        twice = 2 * spreads[i, i] if i == j else spreads[i, j] - spreads[i, i] - spreads[j, j]
        matrix[i, j] = matrix[j, i] = twice / (2 * n * n)
    return matrix


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The fit over all ``vectors`` (see ``usable``); None if there are none."""
    n = vectors.count()
    if not n:
        return None
    sums = _added(vectors, column_sums)
    sums = [sums[i, i] for i in range(len(sums))]
    nearest = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, nearest)]
    centre = np.array(nearest, np.int64)
    matrix = covariances(n, rest, _added(vectors, lambda x: squares(x - centre)))
    values, axes = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    return Whitening(n, centre, np.array(rest, np.int64), values[order], axes[:, order], float(np.trace(matrix)))


def whitened(vectors: DataFrame, fit: Whitening, *columns: str) -> DataFrame:
    """``columns`` of each vector with ``deviation`` and ``whitened``, an entry per component."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(fit)  # a matrix of dimensions by components

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch.column("v"))
            if not len(x):
                continue
            w = shared.value.project(x)
            ends = np.arange(0, w.size + 1, w.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel(), pa.float64(), from_pandas=True))
            yield pa.record_batch(
                [*(batch.column(name) for name in columns), pa.array(shared.value.deviations(x), pa.int64()), lists],
                [*columns, "deviation", "whitened"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.select(*columns).schema)
    return vectors.select(*columns, "v").mapInArrow(run, f"{kinds}, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, n: int) -> float | None:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity, over the
    components that have variance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            if batch.num_rows:
                w = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                full = np.concatenate([np.ones((len(w), 1)), w], axis=1)
                sums = full.T @ full + (0.0 if sums is None else sums)
        if sums is not None:
            i, j = np.triu_indices(len(sums))
            yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(sums[i, j])], ["i", "j", "s"])

    added = rows.select("whitened").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    if not added:
        return None
    size = 1 + max(row.j for row in added)
    products = np.zeros((size, size))
    for row in added:
        products[row.i, row.j] = products[row.j, row.i] = np.nan if row.s is None else row.s
    mean = products[0, 1:] / n
    covariance = products[1:, 1:] / n - np.outer(mean, mean)
    there = ~np.isnan(np.diag(covariance))
    return float(np.abs(covariance - np.eye(size - 1))[np.ix_(there, there)].max()) if there.any() else None


def whitening_report(vectors: DataFrame, key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``, a row per vector and component."""
    rows = usable(vectors, key)
    fit = fit_whitening(rows, components)
    if fit is None:
        return rows.select(
            key, F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            *[F.lit(0.0).alias(name) for name in ("whitened", "explained", "identity_error")])
    done = whitened(rows, fit, key)
    error = identity_error(done, fit.n)
    shares = [F.lit(float(e / fit.trace) if fit.trace > 0 else None).cast("double") for e in fit.values]
    entry = F.posexplode("whitened").alias("_at", "_w")
    return done.select(key, "deviation", entry).select(
        key, (F.col("_at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation",
        F.col("_w").alias("whitened"), F.get(F.array(*shares), F.col("_at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_report(table(spark, sf_dir, "embeddings"))
