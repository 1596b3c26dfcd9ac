"""Cluster quality, K-Means segments and segment profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthscore.config import NURTURE_LABEL, SEGMENT_LABELS, Settings

PROFILE_COLUMNS = (
    "income_mean",
    "credit_ranges_mean",
    "member_tenure_years_mean",
    "number_of_children_mean",
    "product_count",
    "total_ers_calls",
    "is_high_income",
    "is_long_term_member",
    "has_used_ers",
)


# --- cluster quality ----------------------------------------------------------


def cluster_moments(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Size, mean and sum of squares per cluster: one row each, one pass."""
    stats = Summarizer.metrics("count", "mean", "normL2").summary(F.col(vector))
    return df.groupBy(F.col(label).alias("cluster")).agg(stats.alias("s")).select(
        "cluster",
        F.col("s.count").alias("n"),
        vector_to_array("s.mean").alias("mean"),
        F.transform(vector_to_array("s.normL2"), lambda x: x * x).alias("squares"),
    )


def _moments(df: DataFrame, vector: str, label: str):
    rows = cluster_moments(df, vector, label).collect()
    n = np.array([r.n for r in rows], dtype=float)
    return n, np.array([r["mean"] for r in rows]), np.array([r["squares"] for r in rows])


def inertia(df: DataFrame, vector: str, label: str) -> float:
    """Squared distance of every point to its cluster mean, summed."""
    n, mean, squares = _moments(df, vector, label)
    return float((squares - n[:, None] * mean**2).sum())


def calinski_harabasz(df: DataFrame, vector: str, label: str) -> float:
    """Between-cluster over within-cluster variance, each per degree of freedom."""
    n, mean, squares = _moments(df, vector, label)
    k, total = len(n), float(n.sum())
    centre = (n[:, None] * mean).sum(axis=0) / total
    between = float((n[:, None] * (mean - centre) ** 2).sum())
    within = float((squares - n[:, None] * mean**2).sum())
    return 1.0 if within == 0 else between * (total - k) / (within * (k - 1))


def silhouette(df: DataFrame, vector: str, label: str) -> float:
    """Mean silhouette over all rows with squared distances (linear in rows)."""
    evaluator = ClusteringEvaluator(
        featuresCol=vector, predictionCol=label, distanceMeasure="squaredEuclidean"
    )
    return evaluator.evaluate(df.select(vector, label))


def centroid_silhouette(df: DataFrame, vector: str, label: str) -> float | None:
    """Mean silhouette over all rows with Euclidean distances to cluster means.

    A row's distances to the members of a cluster are replaced by its distance to the
    cluster's mean, so one pass over the rows is enough.  As for the form with pairs, a
    row alone in its cluster, or as near to both means, counts 0.  Null without rows or
    with a single cluster.
    """
    rows = cluster_moments(df, vector, label).collect()
    if len(rows) < 2:
        return None
    names, alone = np.array([r.cluster for r in rows]), np.array([r.n == 1 for r in rows])
    means = np.array([r["mean"] for r in rows])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0.0, 0
        for batch in batches:
            all_x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, means.shape[1])
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            for at in range(0, len(all_x), 2048):
                x, label = all_x[at : at + 2048], labels[at : at + 2048]
                far = np.sqrt(((x[:, None, :] - means[None, :, :]) ** 2).sum(axis=2))
                own = names[None, :] == label[:, None]
                a, b = far[own], np.where(own, np.inf, far).min(axis=1)
                top = np.maximum(a, b)
                value = np.divide(b - a, top, out=np.zeros(len(x)), where=top > 0)
                total, n = total + value[~(own & alone).any(axis=1)].sum(), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.float64()), pa.array([n], pa.int64())], ["total", "n"])

    values = df.select(vector_to_array(vector).alias("x"), F.col(label).alias("label"))
    sums = values.mapInArrow(partial, "total double, n bigint")
    return sums.agg(F.sum("total") / F.sum("n")).first()[0]


# --- K-Means ------------------------------------------------------------------


def score_vector(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``features``: the columns scaled to mean 0 and population deviation 1."""
    n = df.count()
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
    ]
    out = Pipeline(stages=stages).fit(df).transform(df)
    # Spark's scaler divides by the sample deviation.
    factor = float(np.sqrt(n / (n - 1))) if n > 1 else 1.0
    scaled = F.transform(vector_to_array("_scaled"), lambda x: x * F.lit(factor))
    return out.withColumn("features", array_to_vector(scaled)).drop("_raw", "_scaled")


@dataclass(frozen=True)
class Segmentation:
    """Cluster centres, their cost over the rows they were fitted on, and the passes it took."""

    centres: np.ndarray
    cost: float
    passes: int

    def transform(self, df: DataFrame, vector: str = "features", label: str = "cluster") -> DataFrame:
        """Add ``label``: the nearest centre, the first of equally near ones."""
        x = vector_to_array(vector)
        distances = [
            sum(((x[i] - F.lit(float(v))) ** 2 for i, v in enumerate(centre)), F.lit(0.0)) for centre in self.centres
        ]
        found = F.array(*distances)
        return df.withColumn(label, (F.array_position(found, F.array_min(found)) - 1).cast("int"))


QUALITY_SCHEMA = "k int, inertia double, silhouette double, calinski_harabasz double"
START_ROWS = 4096  # rows that starting centres are drawn from; every pass reads all rows


def _starts(df: DataFrame, key: str, vector: str, sizes: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """Starting centres for every (clusters, seed), by distance-weighted draws.

    Draws come from the ``START_ROWS`` rows of the smallest key hashes, so they
    depend neither on partitions nor on the order of rows.
    """
    rows = df.orderBy(F.xxhash64(key), key).limit(START_ROWS).select(vector_to_array(vector).alias("x")).collect()
    points = np.array([r.x for r in rows])
    out = []
    for k, seed in sizes:
        rng = np.random.default_rng(seed)
        chosen = [points[rng.integers(len(points))]]
        nearest = ((points - chosen[0]) ** 2).sum(axis=1)
        while len(chosen) < k:
            total = nearest.sum()
            share = nearest / total if total > 0 else None
            chosen.append(points[rng.choice(len(points), p=share)])
            nearest = np.minimum(nearest, ((points - chosen[-1]) ** 2).sum(axis=1))
        out.append(np.array(chosen))
    return out


def _pass(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple]:
    """One pass for all fits: per fit the counts, sums and cost of its clusters.

    A task emits one row per fit and cluster, whatever the number of its points.
    """
    names = list(centres)
    together = np.vstack([centres[i] for i in names])
    cuts = np.cumsum([0, *(len(centres[i]) for i in names)])
    d = together.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(together), d + 2))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for at in range(0, len(x), 2048):
                rows = x[at : at + 2048]
                distance = ((rows[:, None, :] - together[None, :, :]) ** 2).sum(axis=2)
                for a, b in zip(cuts[:-1], cuts[1:]):
                    near = distance[:, a:b].argmin(axis=1)
                    own = np.zeros((len(rows), b - a))
                    own[np.arange(len(rows)), near] = 1.0
                    cost = distance[np.arange(len(rows)), a + near]
                    sums[a:b] += own.T @ np.column_stack([np.ones(len(rows)), cost, rows])
        lines = pa.array(list(sums), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), lines], ["i", "line"])

    lines = points.mapInArrow(partial, "i int, line array<double>")
    total = lines.groupBy("i").agg(Summarizer.metrics("sum").summary(array_to_vector("line")).alias("s"))
    found = np.zeros((len(together), d + 2))
    for r in total.select("i", vector_to_array("s.sum").alias("line")).collect():
        found[r.i] = r.line
    return {i: (f[:, 0], f[:, 2:], f[:, 1].sum()) for i, f in zip(names, np.split(found, cuts[1:-1]))}


def fit_many(
    df: DataFrame, key: str, fits: Sequence[tuple[int, int]], iterations: int, vector: str = "features", tolerance: float = 1e-4
) -> list[Segmentation]:
    """K-Means for every (clusters, seed) of ``fits`` at once.

    The centres of all fits go to every task together, so a pass over the rows
    moves all of them; a fit whose centres move less than ``tolerance`` leaves
    the later passes.  An empty cluster keeps its centre.  ``df`` is read once
    per pass: persist or stage it first.
    """
    points = df.select(vector_to_array(vector).alias("x"))
    open_fits = dict(enumerate(_starts(df, key, vector, fits)))
    done: dict[int, Segmentation] = {}
    final: dict[int, np.ndarray] = {}
    for turn in range(1, iterations + 2):
        for i, (n, sums, cost) in _pass(points, {**open_fits, **final}).items():
            if i in final:  # the cost of centres that no longer move
                done[i] = Segmentation(final.pop(i), float(cost), turn)
                continue
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], open_fits[i])
            shift = np.sqrt(((moved - open_fits[i]) ** 2).sum(axis=1)).max()
            open_fits[i] = moved
            if shift <= tolerance or turn >= iterations:
                final[i] = open_fits.pop(i)
        if not open_fits and not final:
            break
    return [done[i] for i in range(len(fits))]


def fit_kmeans(df: DataFrame, key: str, k: int, seed: int, starts: int, iterations: int) -> Segmentation:
    """Best of several seeded starts by cost over all rows, the first of equal ones.

    Costs are compared in nine digits: sums differ in the last ones from run to
    run, which must not decide between starts that reach the same optimum.
    """
    fits = fit_many(df, key, [(k, seed + i) for i in range(starts)], iterations)
    return min(fits, key=lambda f: float(f"{f.cost:.9g}"))


def kmeans_sweep(df: DataFrame, key: str, settings: Settings) -> DataFrame:
    """Inertia, silhouette and Calinski-Harabasz for each number of clusters.

    All starts of all numbers of clusters share their passes over ``df``; persist
    it first.
    """
    sizes = [(k, settings.seed + i) for k in settings.segment_range for i in range(settings.sweep_starts)]
    fits = fit_many(df, key, sizes, 300)
    rows = []
    for k in settings.segment_range:
        own = [f for f, (size, _) in zip(fits, sizes) if size == k]
        best = min(own, key=lambda f: float(f"{f.cost:.9g}"))
        labelled = best.transform(df)
        rows.append(
            (
                k,
                best.cost,
                silhouette(labelled, "features", "cluster"),
                calinski_harabasz(labelled, "features", "cluster"),
            )
        )
    return df.sparkSession.createDataFrame(rows, QUALITY_SCHEMA)


def best_k(sweep: DataFrame) -> DataFrame:
    return sweep.orderBy(F.desc("silhouette"), "k").limit(1)


# --- profiles and actions -----------------------------------------------------


def cluster_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"))


def profile_clusters(df: DataFrame, score_columns: Sequence[str]) -> DataFrame:
    """Mean scores and household features per cluster, with its size."""
    columns = [*score_columns, *(c for c in PROFILE_COLUMNS if c in df.columns)]
    return df.groupBy("cluster").agg(
        *[F.round(F.avg(c), 4).alias(c) for c in columns],
        F.count(F.lit(1)).alias("cluster_size"),
    )


def normalised_profile(profile: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cluster means scaled to 0..1 within each feature (clusters x features rows)."""
    long = profile.select("cluster", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        ["cluster"], list(columns), "feature", "mean"
    )
    w = Window.partitionBy("feature")
    low, high = F.min("mean").over(w), F.max("mean").over(w)
    width = F.when(high == low, 1.0).otherwise(high - low)
    return long.withColumn("scaled", (F.col("mean") - low) / width)


def _best(score_columns: dict[str, str]) -> Column:
    """struct(score, place, product) of the highest score, first product on a tie."""
    options = [
        F.struct(
            F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("score"),
            F.lit(-i).alias("place"),
            F.lit(product).alias("product"),
        )
        for i, (product, c) in enumerate(score_columns.items())
    ]
    return F.array_max(F.array(*options))


def argmax_product(df: DataFrame, score_columns: dict[str, str]) -> DataFrame:
    """Add ``best_product`` and ``best_score``; the first product when none exceeds 0."""
    fallback = next(iter(score_columns), "Unknown")
    return df.withColumn("_best", _best(score_columns)).withColumns(
        {
            "best_score": F.greatest(F.col("_best.score"), F.lit(0.0)),
            "best_product": F.when(F.col("_best.score") > 0, F.col("_best.product")).otherwise(
                fallback
            ),
        }
    ).drop("_best")


def name_segments(profile: DataFrame, score_columns: dict[str, str]) -> DataFrame:
    """Add ``cluster_name``: the first rule that fits the cluster's profile."""

    def mean(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)) if name in profile.columns else F.lit(0)

    names = SEGMENT_LABELS
    best = _best(score_columns)
    before, after = names["dominant"].split("{}")
    other, tail = names["other"].split("{}")
    return profile.withColumn("_b", best).withColumn(
        "cluster_name",
        F.when(mean("product_count") >= 2.5, names["multi_product"])
        .when(mean("total_ers_calls") > 2.0, names["heavy_use"])
        .when(mean("income_mean") > 100_000, names["high_income"])
        .when(mean("member_tenure_years_mean") > 15, names["long_tenure"])
        .when(
            F.col("_b.score") > 0.30,
            F.concat(F.lit(before), F.col("_b.product"), F.lit(after)),
        )
        .otherwise(F.concat(F.lit(other), F.col("cluster").cast("string"), F.lit(tail))),
    ).drop("_b")


def action_table(
    profile: DataFrame, score_columns: dict[str, str], min_propensity: float = 0.15
) -> DataFrame:
    """One line per segment: what to offer, and who is in it; best score first."""

    def rounded(name: str, digits: int) -> Column:
        source = F.col(name) if name in profile.columns else F.lit(0.0)
        return F.round(source, digits)

    best = argmax_product(name_segments(profile, score_columns), score_columns)
    offer = F.when(F.col("best_score") >= min_propensity, F.col("best_product")).otherwise(
        NURTURE_LABEL
    )
    return best.select(
        "cluster",
        "cluster_name",
        "cluster_size",
        offer.alias("recommended_product"),
        F.round("best_score", 4).alias("avg_propensity"),
        rounded("income_mean", 0).alias("avg_income"),
        rounded("member_tenure_years_mean", 1).alias("avg_tenure_years"),
        rounded("product_count", 2).alias("avg_product_count"),
        rounded("has_used_ers", 3).alias("pct_ers_users"),
    ).orderBy(F.desc("avg_propensity"), "cluster")
