"""Embedding whitening on the leading components, found by FEAST.

Entries become integers, so the row count and the sums are exact and a row's
deviation from the mean is an exact integer over n.  Tasks add up products of
centred rows; the d x d covariance is all that leaves them.  Inertia counts
(signs in the Sturm sequence of a tridiagonal form) cut the spectrum into
intervals; for each a task integrates the resolvent around it: complex shifted
solves at Gauss points of a half circle project a random block onto the
interval's eigenvectors, Rayleigh-Ritz extracts them, and the block grows until
as many are found as inertia counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthscore.session import stage_table

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
LARGEST = float(2**40)  # entries beyond this are no vectors: their sums would not fit a long
PER_INTERVAL = 8  # eigenvalues of an interval, where they can be told apart
NODES = 16  # quadrature points of a half circle
SMALLEST = 1e-10  # eigenvalues below this share of the trace count as zero
ROUNDS = 40


# --- integer rows -------------------------------------------------------------


def integer_rows(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """Staged ``id``, ``x`` (longs) of the usable vectors, and their length (0 if there are none)."""
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where((F.size("v") > 0) & F.forall("v", good))
    x = F.transform("v", lambda c: (F.floor(c * SCALE) + OFFSET).cast("long"))
    rows = stage_table(rows.select("id", x.alias("x")), "integer_vectors")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    d = usual.d if usual else 0
    return rows.where(F.size("x") == d), d


def matrix_of(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def totals(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and the sum of every dimension, exact at any size."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch.column("x"), d)
            for at in range(0, len(x), 4096):  # 2**12 entries below 2**47 fit a long
                part = x[at : at + 4096]
                sums = [len(part), *part.sum(axis=0).tolist()]
                yield pa.RecordBatch.from_pydict({"i": pa.array(range(d + 1), pa.int32()), "s": sums})

    sums = rows.select("x").mapInArrow(partial, "i int, s long")
    found = {r.i: int(r.s) for r in sums.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return found.get(0, 0), [found.get(i + 1, 0) for i in range(d)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: longs, or Python integers where those would overflow."""
    if n * max(1, int(np.abs(x).max(initial=0))) < 2**61:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squared(dev: np.ndarray) -> list[int | None]:
    """Sum of squares per row, exact; None where it does not fit a long."""
    if dev.dtype != object:
        estimate = (dev.astype(float) ** 2).sum(axis=1).max(initial=0)
        if estimate < 2.0**62:
            return (dev * dev).sum(axis=1).tolist()
        dev = dev.astype(object)
    return [s if s < 2**63 else None for s in (dev * dev).sum(axis=1).tolist()]


# --- covariance ---------------------------------------------------------------


def covariance(rows: DataFrame, d: int, n: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of outer products of ``centred`` rows over n.

    A task adds up its own rows and emits one row per line of the matrix; the
    lines add up in Spark, combined in the map tasks first.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            c = centred(matrix_of(batch.column("x"), d))
            total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            lines = pa.array(list(total), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), lines], ["i", "line"])

    lines = rows.select("x").mapInArrow(partial, "i int, line array<double>")
    summed = lines.groupBy("i").agg(Summarizer.metrics("sum").summary(array_to_vector("line")).alias("s"))
    found = summed.select("i", vector_to_array("s.sum").alias("line")).orderBy("i").collect()
    return np.array([r.line for r in found]) / n


# --- inertia ------------------------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to symmetric ``v``."""
    a = np.array(v, dtype=float)
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x /= norm
        a[k + 1 :, k:] -= 2 * np.outer(x, x @ a[k + 1 :, k:])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Inertia: how many eigenvalues exceed ``shift``."""
    diagonal, off = (x.tolist() for x in form)
    tiny = float(np.finfo(float).tiny)
    count, q = 0, 1.0
    for i, a in enumerate(diagonal):
        q = a - shift - (off[i - 1] ** 2 / q if i else 0.0)
        if q == 0:
            q = -tiny
        count += int(q > 0)
    return count


def intervals(v: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) that hold the ``k`` largest, or all above zero."""
    form = tridiagonal(v)
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)
    floor = SMALLEST * float(np.trace(v))
    k = min(k, count_above(form, floor))
    if k == 0:
        return []
    low, high = floor, top
    while count_above(form, low) > k and high - low > 1e-13 * top:
        middle = (low + high) / 2
        low, high = (middle, high) if count_above(form, middle) >= k else (low, middle)
    out, open_ones = [], [(low, top, count_above(form, low))]
    while open_ones:
        low, high, n = open_ones.pop()
        if n > PER_INTERVAL and high - low > 1e-9 * top:
            middle = (low + high) / 2
            above = count_above(form, middle) - count_above(form, high)
            open_ones += [(low, middle, n - above), (middle, high, above)]
        elif n:
            out.append((low, high, n))
    return sorted(out)


# --- contour integration --------------------------------------------------------


def feast(v: np.ndarray, low: float, high: float, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` eigenpairs of ``v`` in (low, high]; RuntimeError if some are missed."""
    d = len(v)
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(-0.5j * np.pi * (points - 1))
    scale = max(float(np.abs(v).sum(axis=1).max()), np.finfo(float).tiny)
    block = min(d, wanted + max(4, wanted // 2))
    rng = np.random.default_rng(1)
    y = rng.standard_normal((d, block))
    best = (np.inf, None, None)
    for _ in range(ROUNDS):
        q = np.zeros_like(y)
        for w, z in zip(weights, turn):
            solved = np.linalg.solve((centre + radius * z) * np.eye(d) - v, y.astype(complex))
            q += 0.5 * w * (radius * z * solved).real
        q = np.linalg.qr(q)[0]
        values, small = np.linalg.eigh(q.T @ v @ q)  # Rayleigh-Ritz
        y = q @ small
        inside = (values > low) & (values <= high)
        error = np.linalg.norm(v @ y - y * values, axis=0) / scale
        if inside.sum() == wanted:
            worst = error[inside].max()
            if worst >= best[0] / 2 and best[0] < 1e-10:  # rounding is all that is left
                return best[1], best[2]
            if worst < best[0]:
                best = (worst, values[inside], y[:, inside])
        elif block < d:  # some are missed, or strangers have come in
            extra = min(d - block, max(2, block // 2))
            y, block = np.hstack([y, rng.standard_normal((d, extra))]), block + extra
    if best[0] < 1e-10:
        return best[1], best[2]
    raise RuntimeError(f"{wanted} eigenvalues counted in ({low}, {high}], not all found")


def components(spark: SparkSession, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues above zero, falling, and their vectors as columns.

    One task per interval.  Signs: the largest entry of a vector is positive.
    """
    cut = intervals(v, k)
    if not cut:
        return np.zeros(0), np.zeros((len(v), 0))
    shared = spark.sparkContext.broadcast(v)  # d x d, whatever the number of rows

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, n in zip(*(c.to_pylist() for c in batch.columns)):
                values, vectors = feast(shared.value, low, high, n)
                lines = pa.array(list(vectors.T), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.float64()), lines], ["value", "vector"])

    tasks = spark.createDataFrame(cut, "low double, high double, n int").repartition(len(cut), "low")
    found = tasks.mapInArrow(solve, "value double, vector array<double>").collect()
    if len(found) != sum(n for _, _, n in cut):
        raise RuntimeError("an interval returned too few components")
    # Vectors of neighbouring intervals are made orthogonal to the last digit.
    basis = np.linalg.qr(np.array([r.vector for r in sorted(found, key=lambda r: -r.value)]).T)[0]
    values, small = np.linalg.eigh(basis.T @ v @ basis)
    values, vectors = values[::-1][:k], (basis @ small)[:, ::-1][:, :k]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors * signs


# --- operator -----------------------------------------------------------------

WHITENED = pa.schema(
    [
        ("id", pa.int64()),
        ("component", pa.int32()),
        ("n", pa.int64()),
        ("deviation", pa.int64()),
        ("whitened", pa.float64()),
        ("explained", pa.float64()),
        ("identity_error", pa.float64()),
    ]
)
WHITENED_DDL = (
    "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS
) -> DataFrame:
    """One row per usable vector and component, for up to ``k`` components.

    Columns: id, component (1 is the largest eigenvalue), n, deviation (exact, null
    where it exceeds a long), whitened, explained and identity_error.  Vectors that
    are null or empty, that hold null, non-finite or entries beyond 2**40, or whose
    length is not the most frequent one (the larger of equally frequent ones) are
    dropped.  Components without variance do not appear, so equal vectors alone,
    a single vector and an empty table give an empty result.  Repeated rows and
    null ids count as rows; other columns are ignored.
    """
    spark = df.sparkSession
    rows, d = integer_rows(df, id_col, vector_col)
    n, sums = totals(rows, d)
    if n == 0:
        return spark.createDataFrame([], WHITENED_DDL).withColumnRenamed("id", id_col)

    def centred(x: np.ndarray) -> np.ndarray:
        return (deviations(x, n, sums) / n).astype(float)

    v = covariance(rows, d, n, centred)
    values, vectors = components(spark, v, k)
    size = len(values)
    if size == 0:
        return spark.createDataFrame([], WHITENED_DDL).withColumnRenamed("id", id_col)
    onto = vectors / np.sqrt(values)
    explained = values / np.trace(v)
    check = covariance(rows, d, n, lambda x: centred(x) @ onto)
    identity_error = float(np.abs(check - np.eye(size)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch.column("x"), d)
            dev = deviations(x, n, sums)
            rows_in = len(x)
            at = np.repeat(np.arange(rows_in), size)
            columns = [
                batch.column("id").take(pa.array(at)).cast(pa.int64()),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows_in)),
                pa.array(np.full(rows_in * size, n)),
                pa.array(squared(dev), pa.int64()).take(pa.array(at)),
                pa.array(((dev / n).astype(float) @ onto).ravel()),
                pa.array(np.tile(explained, rows_in)),
                pa.array(np.full(rows_in * size, identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=WHITENED)

    return rows.mapInArrow(project, WHITENED_DDL).withColumnRenamed("id", id_col)
