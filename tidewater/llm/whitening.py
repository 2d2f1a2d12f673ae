"""Operator 12: embedding whitening by Chebyshev-filtered subspace iteration.

Entries become integers ``x = floor(64 c) + 1000000``; column sums are exact. The covariance
V (divisor n) is never formed: a pass over the table gives ``V Q`` for a block Q of at most
``components + GUARD`` columns as the sum of ``Z^T (Z Q)`` over batches of centred rows Z, one
partial d x k matrix per task, added up by Spark cell by cell. The driver holds d x k
matrices only, whatever the number of rows.

Each round rotates the block to its Ritz vectors (Rayleigh-Ritz), then applies a Chebyshev
polynomial of V through its three-term recurrence, one pass a step. The polynomial stays
within [-1, 1] on the unwanted spectrum, from 0 to the smallest Ritz value of the block,
and grows fast above it. Its degree keeps the growth inside the block below ``GROWTH``, so that no
column drowns in another. Columns whose residual ``|V q - e q|`` reaches rounding level are locked
and projected out of the others. QR makes the block orthonormal again. Once all wanted columns
are locked, fresh random columns orthogonal to them are filtered too: only if none has a Ritz value above
the wanted ones are the components certified, otherwise the columns join the block.

Defined cases: rows whose vector is null or empty, holds null or non-finite entries or
entries of 2^56 and more (no long holds the scaled sums) take no part, nor do vectors of another length than
the commonest (ties: the longest). Components without variance (below 1e-12 of the
largest) cannot be whitened and are left out, so equal rows or a single row give no rows; fewer
dimensions than components give as many as there are. Repeated rows and ids, null ids too, each get
their own result rows; a deviation beyond a long is null; components of equal
eigenvalue come in any order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import read_table, written

COMPONENTS, GUARD = 32, 16
OFFSET, SCALE = 1_000_000, 64
GROWTH, DEGREE = 1e7, 24
ROUNDS = 500
EPS = float(np.finfo(np.float64).eps)
LONG = 2**62


@dataclass
class Model:
    """``sums`` of ``x - OFFSET`` per dimension; ``axes`` are unit eigenvectors in columns."""

    n: int
    sums: list[int]
    largest: int
    axes: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def scaled(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, y`` of the usable rows, ``y = floor(64 c)``, as a written table."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(float(2**56))))
    usable = v.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(~F.coalesce(bad, F.lit(True)))
    y = usable.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("y"))
    y = written(y.withColumn("dim", F.size("y")), "whiten-rows")
    common = y.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    return y.where(F.col("dim") == F.lit(common["dim"] if common else 0)).select("vec_id", "y")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column with rows of equal length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n, largest = None, 0, 0
    for b in batches:
        if not b.num_rows:
            continue
        y = matrix(b.column(0))
        top = int(np.abs(y).max())
        part = y.sum(axis=0) if top * len(y) < LONG else y.astype(object).sum(axis=0)
        part = [int(p) for p in part]
        total = part if total is None else [p + q for p, q in zip(total, part)]
        n, largest = n + len(y), max(largest, top)
    if total is not None:
        d = len(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)),
             pa.array([n] * d, pa.int64()), pa.array([largest] * d, pa.int64())], ["dim", "s", "n", "largest"])


def deviations(y: np.ndarray, n: int, sums: list[int], largest: int) -> tuple[np.ndarray, list[int]]:
    """Centred rows in double precision and the exact sums of ``(n x - S)^2``."""
    bound = 2 * n * largest
    if bound < LONG:
        d = y * n - np.array(sums, np.int64)
        z = d / n
        if bound * bound * len(sums) < LONG:
            return z, (d * d).sum(axis=1).tolist()
    else:
        d = y.astype(object) * n - np.array(sums, object)
        z = (d / n).astype(np.float64)
    d = d.astype(object)
    return z, (d * d).sum(axis=1).tolist()


def _product(n: int, sums: list[int], largest: int, q: np.ndarray):
    """Partial ``Z^T (Z Q)`` of a task, flattened, and as the last cell the sum of all ``z^2``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(q.shape), 0.0
        mean = np.array([s / n for s in sums])
        exact = 2 * n * largest < LONG
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                y = matrix(b.column(0).slice(at, 4096))
                z = (y * n - np.array(sums, np.int64)) / n if exact else y - mean
                total += z.T @ (z @ q)
                square += float(np.einsum("nd,nd->", z, z))
        yield _cells(np.append(total.ravel(), square))

    return run


def _cells(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int64)), pa.array(values)], ["cell", "value"])


def summed(rows: DataFrame, task, size: int) -> np.ndarray:
    """The cell-wise sum of the ``size`` values every task gives."""
    found = rows.select("y").mapInArrow(task, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[found.column("cell").to_numpy()] = found.column("value").to_numpy()
    return out


def ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors, and V times the vectors."""
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    return values[::-1], q @ turn[:, ::-1], vq @ turn[:, ::-1]


def filtered(times_v, x: np.ndarray, vx: np.ndarray, cut: float, top: float, locked: np.ndarray) -> np.ndarray:
    """The Chebyshev polynomial of V, damped on [0, cut] and scaled to 1 at ``top``, times ``x``."""
    mid = half = cut / 2
    away = lambda m: m - locked @ (locked.T @ m)
    degree = int(np.clip(np.log(GROWTH) / np.arccosh(max(top - mid, half * 1.0001) / half), 2, DEGREE))
    first = s = half / (top - mid)
    y = away((vx - mid * x) * (s / half))
    for _ in range(degree - 1):
        t = 1 / (2 / first - s)
        x, y = y, away(2 * t / half * (times_v(y) - mid * y) - s * t * x)
        s = t
    return y


def eigenpairs(times_v, d: int, wanted: int, guard: int = GUARD, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues and vectors of the d x d operator ``times_v``."""
    rng = np.random.Generator(np.random.PCG64(seed))
    k = min(d, wanted + guard)
    wanted = min(d, wanted)
    q = np.linalg.qr(rng.standard_normal((d, k)))[0]
    before, certified = np.full(wanted, np.inf), False
    for _ in range(ROUNDS):
        values, q, vq = ritz(q, times_v(q))
        if values[0] <= 0 or q.shape[1] == d:  # no variance at all, or the block is the whole space
            return values[:wanted], q[:, :wanted]
        residual = np.linalg.norm(vq - q * values, axis=0)[:wanted]
        floor = 8 * EPS * values[0] * np.sqrt(d)
        done = (residual <= floor) | ((residual <= 1e-11 * values[0]) & (residual > before / 2))
        before = residual
        n = int(np.argmin(done)) if not done.all() else wanted
        if n == wanted:
            if certified:
                return values[:wanted], q[:, :wanted]
            # The certificate: nothing that random columns find outside exceeds the wanted values.
            locked = q[:, :wanted]
            probe = rng.standard_normal((d, min(guard, d - wanted)))
            probe = np.linalg.qr(probe - locked @ (locked.T @ probe))[0]
            cut = max(values[-1], values[0] * EPS)
            probe = filtered(times_v, probe, times_v(probe), cut, max(values[wanted - 1], cut * 1.01), locked)
            probe = np.linalg.qr(probe - locked @ (locked.T @ probe))[0]
            outside = ritz(probe, times_v(probe))[0]
            certified = outside[0] <= values[wanted - 1] * (1 + 1e-9) + floor
            if certified:
                return values[:wanted], q[:, :wanted]
            q = np.linalg.qr(np.concatenate((locked, probe, q[:, wanted:]), axis=1))[0][:, :min(d, k + probe.shape[1])]
            before = np.full(wanted, np.inf)
            continue
        locked = q[:, :n]
        cut = values[-1]
        if cut <= values[0] * d * EPS:  # the block holds all variance there is
            return values[:wanted], q[:, :wanted]
        y = filtered(times_v, q[:, n:], vq[:, n:], cut, values[n], locked)
        q = np.linalg.qr(np.concatenate((locked, y / np.linalg.norm(y, axis=0)), axis=1))[0]
    raise RuntimeError(f"components are not certified after {ROUNDS} rounds; residuals {residual}")


def fit(rows: DataFrame, components: int = COMPONENTS, guard: int = GUARD) -> Model | None:
    """The whitening of ``rows(y)``; None without rows."""
    sums = rows.select("y").mapInArrow(_sums, "dim int, s decimal(38,0), n long, largest long").groupBy("dim").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("largest").alias("largest")).orderBy("dim").collect()
    if not sums:
        return None
    d, n, largest = len(sums), sums[0]["n"], sums[0]["largest"]
    s = [int(r["s"]) for r in sums]
    trace = 0.0

    def times_v(q: np.ndarray) -> np.ndarray:
        nonlocal trace
        out = summed(rows, _product(n, s, largest, q), q.size + 1)
        trace = out[-1] / n
        return out[:-1].reshape(q.shape) / n

    values, axes = eigenpairs(times_v, d, components, guard)
    some = values > max(1e-12 * values[0], 0.0)
    values, axes = values[some], axes[:, some]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    model = Model(n, s, largest, axes, values, trace, 0.0)
    if len(values):
        cells = summed(rows, _moments(model), len(values) * (len(values) + 1)) / n
        mean, second = cells[:len(values)], cells[len(values):].reshape(len(values), -1)
        model.identity_error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(values))).max())
    return model


def _moments(m: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = len(m.values)
        first, second = np.zeros(p), np.zeros((p, p))
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                w = project(deviations(matrix(b.column(0).slice(at, 4096)), m.n, m.sums, m.largest)[0], m)
                first += w.sum(axis=0)
                second += w.T @ w
        yield _cells(np.concatenate((first, second.ravel())))

    return run


def project(z: np.ndarray, m: Model) -> np.ndarray:
    return (z @ m.axes) / np.sqrt(m.values)


def whiten(rows: DataFrame, model: Model) -> DataFrame:
    """``vec_id, deviation, whitened`` (an array, one entry per component) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                z, exact = deviations(matrix(b.column(1)), model.n, model.sums, model.largest)
                w = project(z, model)
                ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([e if e < 2**63 else None for e in exact], pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(w.ravel()))], ["vec_id", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "y").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scaled(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return digest(rows, fit(rows))


def digest(rows: DataFrame, model: Model | None) -> DataFrame:
    """A row per vector and component."""
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], RESULT)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    out = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"),
                      F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))


QUERIES = {"op12_embedding_whitening": op12_embedding_whitening}
ORACLE: dict[str, str] = {}
