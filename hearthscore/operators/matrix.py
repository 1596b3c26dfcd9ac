"""Households to a numeric matrix without nulls, always with the key."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthscore.config import MISSING_LABEL
from hearthscore.operators.clean import assert_no_excluded, numeric_columns, text_columns
from hearthscore.operators.ordered import with_running
from hearthscore.operators.quantiles import exact_medians
from hearthscore.session import stage_table

log = logging.getLogger(__name__)


def split_columns(df: DataFrame, drop: Sequence[str]) -> tuple[dict[str, float], list[str]]:
    """Numeric inputs with their exact medians, and text inputs.

    A column without any value has no median and is left out, with a warning.
    """
    rest = assert_no_excluded(df.drop(*drop))
    medians = exact_medians(rest, numeric_columns(rest))
    empty = [c for c, m in medians.items() if m is None]
    if empty:
        log.warning("columns without any value are left out: %s", empty)
    return {c: m for c, m in medians.items() if m is not None}, text_columns(rest)


def fill_numbers(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in values.items()}
    )


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the exact column median."""
    medians = exact_medians(df, columns)
    return fill_numbers(df, {c: medians[c] for c in columns if medians[c] is not None})


def dummy_name(column: str, label: str) -> str:
    return f"{column}={label}".replace(".", "_").replace("`", "_")


def one_hot(df: DataFrame, columns: Sequence[str], labels: dict[str, list[str]]) -> DataFrame:
    """One 0/1 column per listed label; a label not listed gives all zeros.

    ``matrix_stages`` learns labels of any number and gives sparse vectors.
    """
    new = []
    for c in columns:
        value = F.coalesce(F.col(c), F.lit(MISSING_LABEL))
        new += [(value == v).cast("double").alias(dummy_name(c, v)) for v in labels[c]]
    return df.select(*[c for c in df.columns if c not in columns], *new)


def build_matrix(
    df: DataFrame, drop: Sequence[str], labels: dict[str, list[str]], key: str = "household_key"
) -> DataFrame:
    """Key, imputed numbers and label indicators as plain columns."""
    medians, text = split_columns(df, [*drop, key])
    return one_hot(fill_numbers(df.select(key, *medians, *text), medians), text, labels)


def label_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct labels as rows ``column``, ``label``, ``slot``: slots 0, 1, ... by column and label.

    Labels combine in the map tasks and are numbered by range, so their number is
    not bound by the driver; nulls count as the missing label.  Staged.
    """
    cells = F.array(*[_cell(c) for c in columns]) if columns else F.array().cast("array<struct<column:string,label:string>>")
    labels = df.select(F.explode(cells).alias("c")).select("c.column", "c.label").distinct()
    labels = stage_table(labels, "labels")
    numbered = with_running(labels, ["column", "label"], {}, "slot")
    return stage_table(numbered.select("column", "label", (F.col("slot") - 1).alias("slot")), "dictionary")


def _cell(column: str) -> Column:
    label = F.coalesce(F.col(_quoted(column)).cast("string"), F.lit(MISSING_LABEL))
    return F.struct(F.lit(column).alias("column"), label.alias("label"))


def sparse_matrix(
    df: DataFrame,
    drop: Sequence[str] = (),
    key: str = "household_key",
    dictionary: DataFrame | None = None,
    medians: dict[str, float] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Matrix rows (key, slots, values) and the names of the slots (slot, name).

    Numbers come first, with nulls replaced by the column's exact median, then one
    slot per label with value 1.  Labels and medians are learned on ``df`` unless
    given; a label outside the dictionary gives zeros.  Keys must be distinct;
    a column without any value is left out; ``df`` is read several times.
    """
    learned, text = split_columns(df, [*drop, key])
    medians = learned if medians is None else medians
    numbers = list(medians)
    dictionary = label_dictionary(df, text) if dictionary is None else dictionary
    first = len(numbers)
    filled = [F.coalesce(F.col(_quoted(c)).cast("double"), F.lit(float(m))) for c, m in medians.items()]
    rows = df.select(key, F.array(*filled).cast("array<double>").alias("numbers"))
    if text:
        cells = df.select(key, F.explode(F.array(*[_cell(c) for c in text])).alias("c"))
        cells = cells.select(key, F.col("c.column").alias("column"), F.col("c.label").alias("label"))
        found = cells.join(dictionary, ["column", "label"]).groupBy(key).agg(
            F.sort_array(F.collect_list(F.col("slot") + first)).alias("labels")
        )
        rows = rows.join(found, key, "left")
    else:
        rows = rows.withColumn("labels", F.lit(None).cast("array<bigint>"))
    labels = F.coalesce("labels", F.array().cast("array<bigint>"))
    matrix = rows.select(
        key,
        F.concat(F.array(*[F.lit(i) for i in range(first)]).cast("array<bigint>"), labels).alias("slots"),
        F.concat("numbers", F.transform(labels, lambda _: F.lit(1.0))).alias("values"),
    )
    spark = df.sparkSession
    names = spark.createDataFrame(list(enumerate(numbers)), "slot bigint, name string")
    dummies = dictionary.select(
        (F.col("slot") + first).alias("slot"), F.concat_ws("=", "column", "label").alias("name")
    )
    return matrix, names.unionByName(dummies)


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean 0 and population deviation 1; a constant column becomes 0."""
    stats = df.agg(
        *[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]
    ).first()
    return df.withColumns(
        {c: (F.col(c) - F.lit(stats[c].m)) / F.lit(stats[c].s or 1.0) for c in columns}
    )


def _quoted(name: str) -> str:
    return f"`{name}`"


def matrix_stages(
    train: DataFrame, drop: Sequence[str], features: str = "features"
) -> list:
    """Pipeline stages from a household row to a feature vector.

    Medians come from ``train`` and are kept in the saved pipeline as constants of
    a SQL step.  Labels become sparse indicators; a label unseen in training falls
    into the dropped last slot, that is all zeros.
    """
    medians, text = split_columns(train, drop)
    parts = [
        f"coalesce(cast({_quoted(c)} as double), cast({m!r} as double)) as {_quoted('n_' + c)}"
        for c, m in medians.items()
    ]
    parts += [f"coalesce({_quoted(c)}, '{MISSING_LABEL}') as {_quoted('t_' + c)}" for c in text]
    stages = [SQLTransformer(statement=f"select *, {', '.join(parts)} from __THIS__")]
    if text:
        stages.append(
            StringIndexer(
                inputCols=[f"t_{c}" for c in text],
                outputCols=[f"i_{c}" for c in text],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
        stages.append(
            OneHotEncoder(
                inputCols=[f"i_{c}" for c in text],
                outputCols=[f"o_{c}" for c in text],
                dropLast=True,
            )
        )
    inputs = [f"n_{c}" for c in medians] + [f"o_{c}" for c in text]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features))
    return stages


def fit_matrix(train: DataFrame, drop: Sequence[str], first: Sequence = ()) -> PipelineModel:
    """Fit the matrix steps, after optional steps that derive further columns."""
    ready = train
    for step in first:
        ready = step.transform(ready)
    fitted = Pipeline(stages=matrix_stages(ready, drop)).fit(ready)
    return PipelineModel(stages=[*first, *fitted.stages])


def feature_names(matrix: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's slots, from its column metadata, without the step prefix."""
    groups = matrix.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for g in groups for a in g), key=lambda a: a["idx"])
    return [a["name"][2:] for a in slots]
