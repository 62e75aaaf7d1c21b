"""Whitening of embeddings by an incremental eigendecomposition.

Vectors become integers, x = floor(scale * c) + OFFSET, and the distinct ones are the fit list. Each task keeps the spectrum of the
scatter of the vectors that it has seen: one more vector is a centred rank-one update, whose eigenvalues are the roots of a secular
equation. Entries that the update does not touch and equal eigenvalues are deflated first. Spectra of tasks are
combined in rounds of ``FAN``: the other's eigenpairs, and the difference of the means, are rank-one updates one after the other.
The last spectrum's basis is orthonormal to rounding only, and its eigenvalues carry the errors of many updates, so a
Rayleigh-Ritz step refines it: tasks project the centred fit list on the basis, sum up the products, and the eigenvectors of that
small matrix turn the basis. As the basis spans all dimensions, this gives eigenvectors of the covariance to double precision.

Scale: a task holds one spectrum, dimensions squared in size, and one batch. An update costs dimensions cubed (about a millisecond
for 64), so the work grows with the rows and is spread over all tasks. What passes from task to task, and to the driver at the end, is one such
matrix. Counts and sums of integers are exact; centring is (n * x - S) / n of exact integers.

Defined cases: a null vector, or one that holds null or non-finite entries, is dropped; vectors of unequal length are taken as if zeros
followed; equal vectors count once in the fit and are returned each; null ids come back as null; components without variance (an
eigenvalue under ``dimensions * 4e-15`` of the greatest) are not returned, so a single vector gives no rows; of equal eigenvalues any
basis may come; a component's entry of greatest size is positive; deviations past 64 bits stop at the limit; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm._arrow import tidy
from vellum.llm._shared import drop_written, written

SCALE, OFFSET = 64, 1_000_000
#: Spectra that a task combines.
FAN = 8
EPS = np.finfo(float).eps
_STATE = "part bigint, n bigint, mean array<double>, values array<double>, vectors array<double>"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> DataFrame:
    """(id, x): integer vectors of the rows that take part."""
    fine = F.forall(vector_col, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(F.coalesce(c, F.lit(0.0))))
    kept = vectors.filter(F.col(vector_col).isNotNull() & fine)
    return kept.select(F.col(id_col).alias("id"), F.transform(vector_col, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(offset)).alias("x"))


def _rows(column: pa.Array, offset: int) -> np.ndarray:
    """The vectors of a column without their offset, as a matrix of integers."""
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) - offset if len(column) else flat.reshape(0, 0)


# ---- rank-one updates


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - t)) = 0 for ascending, different ``d`` and positive ``z2``: (pole nearest to each root, root minus pole).

    Each root lies between two poles, the last one up to sum(z2) above. Sought as the distance from the nearer pole; a step solves
    the equation with the sums on both sides of the root replaced by one term each, and stays inside a bracket that halves otherwise.
    """
    k = len(d)
    right = np.append(d[1:], d[-1] + 2 * z2.sum())  # of the last root a bound that it stays away from
    gap = d[None, :] - d[:, None]  # row: root, column: pole, from the pole on the root's left
    width = right - d
    middle = 1 + (z2 / (gap - width[:, None] / 2)).sum(1)
    near = np.arange(k) + (middle < 0)  # the root is in the right half
    near[-1] = k - 1
    gap = d[None, :] - d[near][:, None]
    low, high = np.where(near == np.arange(k), 0.0, -width / 2), np.where(near == np.arange(k), width / 2, 0.0)
    high[-1] = width[-1]
    left = np.tri(k, dtype=bool)
    t = (low + high) / 2
    a, b = d - d[near], right - d[near]  # the poles on both sides
    for _ in range(80):
        delta = gap - t[:, None]
        term = z2 / delta
        f = 1 + term.sum(1)
        slope = term / delta
        size = 1 + np.abs(term).sum(1)
        low, high = np.where(f < 0, t, low), np.where(f < 0, high, t)
        found = (np.abs(f) <= 4 * k * EPS * size) | (high - low <= 2 * EPS * np.abs(t))
        if found.all():
            break
        psi, phi = np.where(left, slope, 0).sum(1), np.where(left, 0, slope).sum(1)
        da, db = a - t, b - t
        # c + psi * da^2 / (a - s) + phi * db^2 / (b - s) = 0 agrees with f and its slope at t; s = t + step
        p, q = psi * da * da, phi * db * db
        c = f - psi * da - phi * db
        # c (da - y)(db - y) + p (db - y) + q (da - y) = 0 for the step y
        one, two = c * (da + db) + p + q, c * da * db + p * db + q * da
        half = (one + np.copysign(np.sqrt(np.maximum(one * one - 4 * c * two, 0)), one)) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            y, other = two / half, half / c
        y = np.where((y > a - t) & (y < b - t), y, other)  # the solution between the poles
        new = t + y
        t = np.where(found, t, np.where((new > low) & (new < high), new, (low + high) / 2))
    return near, t


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and eigenvectors (columns) of U diag(values) U' + v v'."""
    z = vectors.T @ v
    top = max(values[-1], 0.0) + z @ z
    if top == 0:
        return values, vectors
    tiny = 8 * EPS * top
    z, vectors = z.copy(), vectors.copy()
    # equal eigenvalues: turn their plane until only one of them is touched
    last = -1
    for i in range(len(values)):
        if abs(z[i]) * np.sqrt(top) <= tiny:
            continue
        if last >= 0 and values[i] - values[last] <= tiny:
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            vectors[:, [last, i]] = np.column_stack((c * vectors[:, last] - s * vectors[:, i], s * vectors[:, last] + c * vectors[:, i]))
            z[last], z[i] = 0.0, r
        last = i
    live = np.flatnonzero(np.abs(z) * np.sqrt(top) > tiny)  # the rest is deflated
    if not len(live):
        return values, vectors
    d, z2 = values[live], z[live] ** 2
    near, t = secular_roots(d, z2)
    diff = (d[None, :] - d[near][:, None]) - t[:, None]  # pole minus root
    # the update whose exact roots these are (Gu and Eisenstat 1994): its vectors are orthogonal
    ratio = -diff.copy()
    np.fill_diagonal(ratio, 1.0)
    poles = d[:, None] - d[None, :]
    np.fill_diagonal(poles, 1.0)
    k = len(live)
    own = np.abs(np.diagonal(diff)) * np.prod(np.abs(ratio / np.where(np.eye(k, dtype=bool), 1.0, poles)), axis=0)
    turn = np.sqrt(own) * np.sign(z[live]) / diff
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    values = values.copy()
    values[live] = d[near] + t
    vectors[:, live] = vectors[:, live] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, mean, and eigenpairs of the scatter around the mean of the vectors seen so far."""

    def __init__(self, width: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(width), np.zeros(width), np.eye(width)

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, away * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + away / self.n

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.__dict__.update(other.__dict__)
            return
        away, n = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, np.sqrt(value) * vector)
        self.values, self.vectors = rank_one(self.values, self.vectors, away * np.sqrt(self.n * other.n / n))
        self.mean, self.n = self.mean + away * (other.n / n), n

    def row(self, part: int) -> pa.RecordBatch:
        arrays = [pa.array([x], pa.list_(pa.float64())) for x in (self.mean, self.values, self.vectors.ravel())]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([self.n], pa.int64()), *arrays], ["part", "n", "mean", "values", "vectors"])


def _fitter(width: int, offset: int):
    @tidy
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum(width)
        for batch in batches:
            for x in _rows(batch.column(0), offset):
                own.add(x.astype(float))
        if own.n:
            yield own.row(TaskContext.get().partitionId())

    return fit


def _combiner(width: int):
    @tidy
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, Spectrum] = {}
        for batch in batches:
            for part, n, mean, values, vectors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                other = Spectrum(width)
                other.n, other.mean, other.values, other.vectors = n, np.array(mean), np.array(values), np.array(vectors).reshape(width, width)
                groups.setdefault(part // FAN, Spectrum(width)).combine(other)
        for part, own in groups.items():
            yield own.row(part)

    return combine


def spectrum(fit: DataFrame, width: int, offset: int = OFFSET) -> Spectrum:
    """The spectrum of a table (x): tasks' spectra, combined in rounds until one is left."""
    now = written(fit.mapInArrow(_fitter(width, offset), _STATE), "spectra")
    most = now.agg(F.max("part")).first()[0]
    while most:
        groups = most // FAN + 1
        after = written(now.repartition(groups, F.expr(f"part div {FAN}")).sortWithinPartitions("part").mapInArrow(_combiner(width), _STATE), "spectra")
        drop_written(now)
        now, most = after, groups - 1
    own = Spectrum(width)
    for row in now.collect():  # one
        own.n, own.mean, own.values, own.vectors = row.n, np.array(row["mean"]), np.array(row["values"]), np.array(row["vectors"]).reshape(width, width)
    drop_written(now)
    return own


# ---- passes over the fit list


def _summed(rows: DataFrame, task, kind: str) -> list:
    """The sum over tasks, entry by entry, of an array that each gives."""
    parts = rows.mapInArrow(task, f"a array<{kind}>").select(F.posexplode("a").alias("i", "a"))
    return [r["a"] for r in parts.groupBy("i").agg(F.sum("a").alias("a")).orderBy("i").collect()]


def _totals(width: int, offset: int):
    @tidy
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in batches:
            x = _rows(batch.column(0), offset)
            n += len(x)
            if len(x):
                sums = [a + int(b) for a, b in zip(sums, x.sum(0) if np.abs(x).max() < 2**62 // len(x) else x.astype(object).sum(0), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([[n, *sums]], pa.list_(pa.int64()))], ["a"])

    return totals


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S of every entry, exact; as Python integers where 64 bits are too few."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    return n * x - np.array(sums, np.int64) if most < 2**62 else n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (deviations(x, n, sums) / n).astype(float)


def _products(n: int, sums: list[int], basis, offset: int, with_sum: bool = False):
    """The matrix of inner products of the projected list, and its sums behind it."""

    @tidy
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = basis.value
        matrix, total = np.zeros((own.shape[1],) * 2), np.zeros(own.shape[1])
        for batch in batches:
            if batch.num_rows:
                z = centred(_rows(batch.column(0), offset), n, sums) @ own
                matrix += z.T @ z
                total += z.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate((matrix.ravel(), total if with_sum else []))], pa.list_(pa.float64()))], ["a"])

    return products


def _scorer(n: int, sums: list[int], basis, offset: int):
    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = 2**63 - 1
        for batch in batches:
            if not batch.num_rows:
                continue
            away = deviations(_rows(batch.column(1), offset), n, sums)
            if away.dtype != object and float(np.abs(away).max(initial=0)) ** 2 * away.shape[1] >= 2**62:
                away = away.astype(object)
            deviation = [min(int(v), limit) for v in (away * away).sum(1)]
            z = ((away / n).astype(float)) @ basis.value
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), lists], ["id", "deviation", "z"])

    return score


def whitened(
    vectors: DataFrame, components: int = 16, scale: int = SCALE, offset: int = OFFSET, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row and component."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, scale, offset)
    id_type = rows.schema["id"].dataType.simpleString()
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    none = spark.createDataFrame([], f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    if not width:
        return none
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(offset).cast("bigint"), F.lit(width) - F.size("x"))))
    fit = written(rows.select("x").distinct(), "fit")
    n, *sums = _summed(fit, _totals(width, offset), "bigint")
    basis, _ = np.linalg.qr(spectrum(fit, width, offset).vectors[:, ::-1])
    held = spark.sparkContext.broadcast(basis)
    ritz = np.array(_summed(fit, _products(n, sums, held, offset), "double")).reshape(width, width) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, chosen = values[::-1], (basis @ turn)[:, ::-1]
    have = min(components, int((values > 4e-15 * width * max(values[0], 0)).sum()))
    if not have:
        return none
    chosen = chosen[:, :have] * np.sign(chosen[np.abs(chosen[:, :have]).argmax(0), np.arange(have)])
    held = spark.sparkContext.broadcast(chosen / np.sqrt(values[:have]))
    sums_of = np.array(_summed(fit, _products(n, sums, held, offset, with_sum=True), "double"))
    mean = sums_of[have * have :] / n
    error = float(np.abs(sums_of[: have * have].reshape(have, have) / n - np.outer(mean, mean) - np.eye(have)).max())
    drop_written(fit)
    explained = F.array(*(F.lit(float(v)) for v in values[:have] / values.sum()))
    scored = rows.mapInArrow(_scorer(n, sums, held, offset), f"id {id_type}, deviation bigint, z array<double>")
    out = scored.select("id", "deviation", F.posexplode("z").alias("i", "whitened"))
    return out.select(
        F.col("id").alias("vec_id"), (F.col("i") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"),
    )
