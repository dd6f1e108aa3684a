"""Embedding whitening by shifted CholeskyQR.

The covariance's eigenvectors come from the R factor of the centred rows A, never from a matrix of rows in one place.
Every pass computes Q = A R^-1 by a triangular solve where the rows lie, and the Gram matrix of Q as one small
matrix a task, summed by a tree. Its Cholesky factor, of the first pass with a shift so that it always exists, is
composed into R until Q is orthonormal. The singular vectors of R are the components, its squared singular values
over n the eigenvalues.

What a task or the driver holds is one frame of rows and a few matrices of dimension x dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_schema, batch_of, limit_frames, partition_number, save, table

# An entry c of a vector counts as floor(SCALE * c) + OFFSET.
SCALE = 64.0
OFFSET = 1_000_000
# Greater entries are taken as this, so that no integer leaves the 53 bits that doubles hold exactly.
LARGEST = 1 << 52

COMPONENTS = 16
# Gram passes: done as soon as the rows are orthonormal to this, at the latest after so many.
ORTHONORMAL = 1e-13
PASSES = 8
# Eigenvalues below this share of the greatest are those of a direction the rows do not have.
RANK = 1e-20

# Matrices that one task adds up in a level of the tree.
FAN_IN = 32
ROWS_AT_ONCE = 4096


def as_integers(vector: Column) -> Column:
    """The vector's entries as integers, floor(64 c) + 1000000."""
    entry = lambda c: F.floor(F.lit(SCALE) * c.cast("double")) + F.lit(OFFSET)
    return F.transform(vector, lambda c: F.least(F.greatest(entry(c), F.lit(-LARGEST)), F.lit(LARGEST)).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor empty, without null or non-finite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, x): usable vectors as integers.

    Vectors of another length than most (of equally many: than the longest) cannot share a basis and are left out.
    """
    found = vectors.where(usable(F.col(vector_column))).select(
        F.col(id_column).alias("vec_id"), as_integers(F.col(vector_column)).alias("x")
    )
    lengths = found.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return found.where(F.size("x") == F.lit(lengths["length"] if lengths else 0))


# --- sums of matrices ---


def _matrices(frame: pa.RecordBatch, column: str = "x") -> Iterator[np.ndarray]:
    """The frame's vectors, some rows at a time, as one integer matrix each."""
    for start in range(0, frame.num_rows, ROWS_AT_ONCE):
        values = frame.slice(start, ROWS_AT_ONCE).column(column)
        rows = len(values)
        yield values.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def summed(rows: DataFrame, measure: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``measure(matrix of x)`` over all rows: one matrix a task, added by a tree of ``FAN_IN`` branches."""
    schema = arrow_schema(rows.sparkSession, "task long, total binary")

    def local(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for frame in frames:
            for x in _matrices(frame):
                part = measure(x)
                total = part if total is None else total + part
        if total is not None:
            yield batch_of({"task": [partition_number()], "total": [np.ascontiguousarray(total, np.float64).tobytes()]}, schema)

    def add(group: pa.Table) -> pa.Table:
        parts = sorted(zip(group.column("task").to_pylist(), group.column("total").to_pylist()))
        total = np.zeros(shape)
        for _, part in parts:
            total += np.frombuffer(part).reshape(shape)
        return pa.table({"task": [parts[0][0] // FAN_IN], "total": [total.tobytes()]}, schema=schema)

    sums = rows.select("x").mapInArrow(local, "task long, total binary")
    tasks = rows.rdd.getNumPartitions()
    while tasks > FAN_IN:
        sums = sums.groupBy(F.floor(F.col("task") / FAN_IN)).applyInArrow(add, "task long, total binary")
        tasks = -(-tasks // FAN_IN)
    total = np.zeros(shape)
    for r in sorted(sums.collect()):  # at most FAN_IN matrices
        total += np.frombuffer(r["total"]).reshape(shape)
    return total


# --- the fit ---


@dataclass
class Whitener:
    """``n`` vectors with entry sums ``sums``; components in rows, by falling eigenvalue; ``trace`` of the covariance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passes: int = 0
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.components.T) / np.sqrt(self.eigenvalues)


def _fits(n: int, sums: np.ndarray, x: np.ndarray) -> bool:
    """Whether n x - S stays within 62 bits."""
    return n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0) < 1 << 62


def _shifted(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: in 64 bits, or as Python's integers where they do not hold it."""
    if _fits(n, sums, x):
        return x * np.int64(n) - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n with a single rounding of the exact difference."""
    return np.asarray(_shifted(x, n, sums) / n, np.float64)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over the entries of (n x - S)^2, exact; null if 64 bits do not hold it."""
    d = _shifted(x, n, sums)
    if d.dtype != object and d.shape[1] * float(np.abs(d).max(initial=0)) ** 2 < 1 << 62:
        return (d * d).sum(axis=1).tolist()
    exact = (d.astype(object) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def fit_list(found: DataFrame) -> DataFrame:
    """Every distinct vector once, written. Repeated ones meet as one row a task before they are shuffled."""
    return save(found.select("x").distinct(), "fit-list")


def exact_sums(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows, and the exact sum of every entry: a row for each dimension."""
    parts = (
        distinct.select(F.posexplode("x").alias("at", "value"))
        .groupBy("at")
        .agg(F.sum(F.col("value").cast("decimal(28,0)")).alias("total"), F.count(F.lit(1)).alias("n"))
        .orderBy("at")
        .collect()
    )
    return (parts[0]["n"] if parts else 0), np.array([int(p["total"]) for p in parts], object)


def triangular_solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows R^-1 for an upper triangular R, column by column."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitener:
    """Components of the written table ``distinct`` of (x), each row once.

    No more components come out than the rows have directions: none for an empty table, for a single row, or if all
    are equal.
    """
    n, sums = exact_sums(distinct)
    d = len(sums)
    if n < 2:
        return Whitener(n, sums, np.empty((0, d)), np.empty(0), 0.0)
    spark = distinct.sparkSession
    factors: list[np.ndarray] = []
    gram, passes = None, 0
    trace = 0.0
    while True:
        shared = spark.sparkContext.broadcast((n, sums, factors))

        def measure(x: np.ndarray) -> np.ndarray:
            count, totals, steps = shared.value
            q = _centred(x, count, totals)
            for step in steps:
                q = triangular_solve(q, step)
            return q.T @ q

        gram = summed(distinct, measure, (d, d))
        gram = (gram + gram.T) / 2
        if not passes:
            trace = float(np.trace(gram)) / n
            if trace == 0:
                return Whitener(n, sums, np.empty((0, d)), np.empty(0), 0.0)
        passes += 1
        if _orthonormal(gram) or passes == PASSES:
            break
        factors = factors + [_cholesky(gram, n, shift=passes == 1)]

    r = np.eye(d)
    for step in factors:
        r = step @ r
    # The last Gram matrix is the identity up to rounding, or a projector where A lacks directions: A'A = R' G R.
    weights, axes = np.linalg.eigh(gram)
    last = np.sqrt(np.clip(weights, 0, None))[:, None] * axes.T
    _, singular, turned = np.linalg.svd(last @ r)
    eigenvalues = singular**2 / n
    kept = min(components, int((eigenvalues > RANK * eigenvalues[0]).sum()))
    return Whitener(n, sums, turned[:kept], eigenvalues[:kept], trace, passes)


def _orthonormal(gram: np.ndarray) -> bool:
    """Whether G is a projector: the identity, or with zeros where there is no direction."""
    return bool(np.abs(gram @ gram - gram).max() <= ORTHONORMAL * len(gram))


def _cholesky(gram: np.ndarray, n: int, shift: bool) -> np.ndarray:
    """Upper factor of G, or of G + s I: in the first pass, and where G is not numerically positive."""
    d, norm = len(gram), float(np.linalg.norm(gram, 2))
    least = 11 * (n * d + d * (d + 1)) * np.finfo(np.float64).eps / 2 * norm
    s = min(least, norm * 1e-3) if shift else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + s * np.eye(d)).T
        except np.linalg.LinAlgError:
            s = max(least if least < norm * 1e-3 else norm * 1e-12, 10 * s)


def measured(whitener: Whitener, distinct: DataFrame) -> Whitener:
    """With the largest entry of the whitened fit list's covariance minus the identity."""
    k = len(whitener.eigenvalues)
    if not k:
        return whitener
    shared = distinct.sparkSession.sparkContext.broadcast(whitener)

    def measure(x: np.ndarray) -> np.ndarray:
        w = shared.value.whitened(x)
        return np.vstack((w.sum(axis=0), w.T @ w))

    found = summed(distinct, measure, (k + 1, k)) / whitener.n
    covariance = found[1:] - np.outer(found[0], found[0])
    whitener.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return whitener


# --- use ---


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> tuple[Whitener, DataFrame]:
    """The fit, and for each usable vector (vec_id, deviation, whitened), ``whitened`` with an entry for each component.

    Null vectors and those with null or non-finite entries are left out; vectors of another length than most too.
    Repeated vectors count once in the fit and are all returned; null ids are ids like others. Other columns, whatever
    their names, are not read. An empty table, and one without two different vectors, has no components.
    Entries whose integer would leave 53 bits count as the last one within; a deviation beyond 64 bits is null.
    """
    limit_frames(vectors.sparkSession)
    found = integer_vectors(vectors, id_column, vector_column)
    distinct = fit_list(found)
    whitener = measured(fit(distinct, components), distinct)
    spark = vectors.sparkSession
    out = f"vec_id {found.schema['vec_id'].dataType.simpleString()}, deviation long, whitened array<double>"
    schema = arrow_schema(spark, out)
    shared = spark.sparkContext.broadcast(whitener)

    def project(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for frame in frames:
            done = 0
            for x in _matrices(frame):
                columns = {
                    "vec_id": frame.column("vec_id").slice(done, len(x)).to_pylist(),
                    "deviation": deviations(x, w.n, w.sums),
                    "whitened": list(w.whitened(x)),
                }
                done += len(x)
                yield batch_of(columns, schema)

    return whitener, found.mapInArrow(project, out)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every usable row of ``embeddings``, one row for each component up to 16."""
    whitener, rows = whiten(table(spark, sf_dir, "embeddings"))
    share = [float(e) / whitener.trace for e in whitener.eigenvalues]
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(whitener.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*[F.lit(s) for s in share]).cast("array<double>"), F.col("at") + 1).alias("explained"),
        F.lit(whitener.identity_error).cast("double").alias("identity_error"),
    )
