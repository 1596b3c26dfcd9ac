"""Least squares from sufficient statistics: one pass for all folds and penalties."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Products of rows (1, z, y) with z the columns in units of deviation, centred."""

    gram: np.ndarray

    @property
    def n(self) -> float:
        return self.gram[0, 0]

    def solve(self, penalty: float) -> tuple[np.ndarray, float]:
        """Slopes and intercept that minimise squared error plus penalty * |slopes|^2."""
        g, n = self.gram, self.n
        mean, target = g[0, 1:-1] / n, g[0, -1] / n
        left = g[1:-1, 1:-1] - n * np.outer(mean, mean)
        right = g[1:-1, -1] - n * mean * target
        # A column without variance on these rows has a zero line and gets no weight.
        slopes = np.linalg.lstsq(left + penalty * np.eye(len(mean)), right, rcond=None)[0]
        return slopes, float(target - slopes @ mean)

    def r2(self, slopes: np.ndarray, intercept: float) -> float:
        """Explained variance of these rows by a line, without reading them again."""
        line = np.r_[intercept, slopes, -1.0]
        error = line @ self.gram @ line
        total = self.gram[-1, -1] - self.gram[0, -1] ** 2 / self.n
        return 1.0 - error / total if total > 0 else 0.0


def moments_by_fold(
    df: DataFrame, features: str, target: str, fold: Column, mean: Sequence[float], deviation: Sequence[float]
) -> dict[int, Moments]:
    """The products per fold, in one pass.

    ``mean`` and ``deviation`` shift and scale the columns before they are
    multiplied, so that no digits cancel.  A task holds one square matrix per
    fold and emits its lines; they add up in Spark, in the map tasks first.
    """
    shift, unit = np.array(mean), np.array(deviation)
    unit = np.where(unit > 0, unit, 1.0)
    size = len(shift)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            rows = np.column_stack([np.ones(len(x)), (x - shift) / unit, batch.column("y").to_numpy()])
            folds = batch.column("fold").to_numpy()
            for f in np.unique(folds).tolist():
                own = rows[folds == f]
                total[f] = total.get(f, 0.0) + own.T @ own
        for f, gram in total.items():
            lines = pa.array(list(gram), pa.list_(pa.float64()))
            n = len(gram)
            columns = [pa.array([f] * n, pa.int32()), pa.array(range(n), pa.int32()), lines]
            yield pa.RecordBatch.from_arrays(columns, ["fold", "i", "line"])

    rows = df.select(
        fold.cast("int").alias("fold"),
        F.col(target).cast("double").alias("y"),
        vector_to_array(features).alias("x"),
    )
    lines = rows.mapInArrow(partial, "fold int, i int, line array<double>")
    summed = lines.groupBy("fold", "i").agg(
        Summarizer.metrics("sum").summary(array_to_vector("line")).alias("s")
    )
    found = summed.select("fold", "i", vector_to_array("s.sum").alias("line")).collect()
    out: dict[int, list] = {}
    for r in sorted(found, key=lambda r: (r.fold, r.i)):
        out.setdefault(r.fold, []).append(r.line)
    return {f: Moments(np.array(lines)) for f, lines in out.items()}


def best_penalty(folds: dict[int, Moments], penalties: Sequence[float]) -> float:
    """The penalty of the highest mean R2 over held-out folds, the first of equal ones."""
    total = sum(m.gram for m in folds.values())
    if len(folds) < 2:
        return penalties[0]

    def score(penalty: float) -> float:
        return float(np.mean([m.r2(*Moments(total - m.gram).solve(penalty)) for m in folds.values()]))

    return max(penalties, key=score)
