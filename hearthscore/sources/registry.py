"""Model registry: saved Spark ML models plus one metadata row per model."""

from __future__ import annotations

import threading
import uuid
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "task string, target string, model string, path string, trained_at string,"
    " feature_count int, feature_names array<string>, roc_auc double, f1 double,"
    " precision double, recall double, lift_at_10 double, rmse double, mae double,"
    " r2 double, validation double"
)


_appending = threading.Lock()  # two appends at once would clear each other's unfinished files


def write_metadata(rows: DataFrame, path: str) -> None:
    """Append metadata rows as JSON; absent fields read back as NULL."""
    with _appending:
        rows.write.mode("append").json(path)


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """All registered models with their headline metric (AUC, else R2)."""
    rows = spark.read.schema(SCHEMA).json(path)
    return rows.withColumn("metric", F.coalesce("roc_auc", "r2"))


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def save_model(model: PipelineModel, base: str, task: str, target: str, name: str) -> str:
    """Store a fitted pipeline under a fresh path and return it."""
    path = f"{base}/models/{task}/{target}/{name}-{uuid.uuid4().hex[:8]}"
    model.write().overwrite().save(path)
    return path


def register(spark: SparkSession, base: str, rows: list[dict]) -> None:
    stamp = datetime.now(UTC).isoformat()
    names = [part.split()[0] for part in SCHEMA.split(",")]
    table = [tuple({"trained_at": stamp, **r}.get(n) for n in names) for r in rows]
    write_metadata(spark.createDataFrame(table, SCHEMA), f"{base}/registry")


def best_models(spark: SparkSession, base: str, task: str) -> dict[str, str]:
    """Target -> path of its best model by validation metric in the task's latest run.

    All models of a run carry one time stamp, so a retrained model replaces
    older ones and targets that were not trained again are not served.
    """
    if not exists(spark, f"{base}/registry"):
        return {}
    rows = inventory(spark, f"{base}/registry").filter((F.col("task") == task) & F.col("path").isNotNull())
    latest = rows.agg(F.max("trained_at")).first()[0]
    best = rows.filter(F.col("trained_at") == latest).groupBy("target").agg(
        F.max(F.struct("validation", "path")).alias("best")
    )
    return {r.target: r.best.path for r in best.collect()}


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
