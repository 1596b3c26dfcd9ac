"""Evaluation of scores and predictions.

Classification input: one row per (group..., key) with label ``y`` (0/1) and
score ``p``.  ``by`` names the group columns (for example product and model);
all groups are evaluated in the same jobs.  ``key`` is a number and breaks ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthscore.operators.ordered import with_running
from hearthscore.operators.quantiles import order_statistics, top_cutoffs

_G = "_group"


def _grouped(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One text column that stands for all group columns."""
    label = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in by]) if by else F.lit("")
    return df.withColumn(_G, label)


def _ratio(a: Column, b: Column) -> Column:
    """Division that gives 0 for an empty denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


# --- top share and lift -------------------------------------------------------


def mark_top_share(
    df: DataFrame, share: float, by: Sequence[str] = (), key: str = "key"
) -> DataFrame:
    """Add ``in_top``: is the row among the best ``share`` of its group.

    max(1, int(n * share)) rows per group, best score first, then lowest key.
    Found as a score cutoff plus, for the rows tied at the cutoff, a key cutoff:
    no sort and no shuffle of the scored rows.
    """
    spark = df.sparkSession
    g = _grouped(df, by)
    cuts = top_cutoffs(g, _G, "p", share)
    cut_table = spark.createDataFrame(
        [(name, float(p), n) for name, (p, n) in cuts.items()],
        f"{_G} string, _cut double, _want bigint",
    )
    near = g.join(F.broadcast(cut_table), _G)
    above = {
        r[_G]: r["n"]
        for r in near.groupBy(_G).agg(F.count_if(F.col("p") > F.col("_cut")).alias("n")).collect()
    }
    tied = near.filter("p = _cut").select(_G, F.col(key).cast("bigint").alias("_key"))
    last_key = order_statistics(
        tied, _G, "_key", lambda name, n: [cuts[name][1] - above[name] - 1]
    )
    key_table = spark.createDataFrame(
        [(name, cuts[name][0], int(v)) for (name, _), v in last_key.items()],
        f"{_G} string, _cut double, _last bigint",
    )
    top = (F.col("p") > F.col("_cut")) | (
        (F.col("p") == F.col("_cut")) & (F.col(key) <= F.col("_last"))
    )
    return (
        g.join(F.broadcast(key_table), _G)
        .withColumn("in_top", top)
        .drop(_G, "_cut", "_last")
    )


def top_k_percent(df, share, by=(), key="key") -> DataFrame:
    return mark_top_share(df, share, by, key).filter("in_top").drop("in_top")


def lift_at_k(
    df: DataFrame, share: float = 0.10, by: Sequence[str] = (), key: str = "key"
) -> DataFrame:
    """Positive rate in the top share over the overall rate; 0 without positives."""
    marked = mark_top_share(df, share, by, key)
    y = F.col("y").cast("bigint")
    rates = marked.groupBy(*by).agg(
        F.sum(F.when(F.col("in_top"), y)).alias("_top_pos"),
        F.count_if("in_top").alias("contacted"),
        F.sum(y).alias("_pos"),
        F.count(F.lit(1)).alias("n"),
    )
    lift = _ratio(
        _ratio(F.col("_top_pos"), F.col("contacted")), _ratio(F.col("_pos"), F.col("n"))
    )
    return rates.select(*by, "n", "contacted", lift.alias("lift"))


# --- curves -------------------------------------------------------------------


def _running_in_group(
    df: DataFrame, order: Sequence[str], sums: dict[str, str], position: str
) -> DataFrame:
    """Positions and running sums that restart in each group.

    One global pass ordered by (group, order); each group's start is taken off
    again from a table with one row per group.
    """
    starts = df.groupBy(_G).agg(
        F.count(F.lit(1)).alias(f"_all_{position}"),
        *[F.sum(c).alias(f"_all_{name}") for name, c in sums.items()],
    )
    before = Window.orderBy(_G).rowsBetween(Window.unboundedPreceding, -1)
    names = [position, *sums]
    starts = starts.select(
        _G,
        *[f"_all_{n}" for n in names],
        *[
            F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_start_{n}")
            for n in names
        ],
    )
    run = with_running(df, [_G, *order], sums, position)
    out = run.join(F.broadcast(starts), _G)
    return out.withColumns({n: F.col(n) - F.col(f"_start_{n}") for n in names}).drop(
        *[f"_start_{n}" for n in names]
    )


def lift_curve(df: DataFrame, by: Sequence[str] = (), key: str = "key") -> DataFrame:
    """Share of population, share of positives captured and lift for every prefix."""
    g = _grouped(df, by).select(_G, *by, key, "p", F.col("y").cast("bigint").alias("y"))
    run = _running_in_group(g, ["-p", key], {"caught": "y"}, "position")
    pop = F.col("position") / F.col("_all_position")
    captured = F.col("caught") / F.greatest(F.col("_all_caught"), F.lit(1))
    return run.select(*by, key, "position", pop.alias("pct_pop"), captured.alias("pct_captured")).withColumn(
        "lift", F.col("pct_captured") / F.col("pct_pop")
    )


def curve_lift_at(curve: DataFrame, share: float = 0.10, by: Sequence[str] = ()) -> DataFrame:
    """Lift of the last prefix within ``share``; 1 when none is that short."""
    within = F.when(F.col("pct_pop") <= share, F.struct("position", "lift"))
    last = curve.groupBy(*by).agg(F.max(within).alias("_last"))
    return last.select(*by, F.coalesce(F.col("_last.lift"), F.lit(1.0)).alias("lift"))


def _by_score(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score: combined before any shuffle."""
    y = F.col("y").cast("bigint")
    return (
        _grouped(df, by)
        .groupBy(_G, *by, "p")
        .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    )


def roc_points(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at every distinct score, best score first."""
    run = _running_in_group(
        _by_score(df, by), ["-p"], {"tp": "pos", "fp": "neg"}, "position"
    )
    return run.select(
        *by,
        F.col("p").alias("threshold"),
        "tp",
        "fp",
        _ratio(F.col("tp"), F.col("_all_tp")).alias("tpr"),
        _ratio(F.col("fp"), F.col("_all_fp")).alias("fpr"),
    )


def roc_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half.

    Summed over distinct scores, from the running count of lower negatives.
    """
    run = _running_in_group(_by_score(df, by), ["p"], {"below": "neg"}, "position")
    below = F.col("below") - F.col("neg")
    wins = F.col("pos") * (2 * below + F.col("neg"))
    sums = run.groupBy(*by).agg(
        F.sum(wins).alias("_wins"), F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg")
    )
    auc = F.try_divide(
        F.col("_wins").cast("double"), 2 * F.col("_pos").cast("double") * F.col("_neg").cast("double")
    )
    return sums.select(*by, auc.alias("roc_auc"))


# --- decisions at a threshold -------------------------------------------------


def with_decision(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add ``pred``, the decision at a score threshold, unless the model made one."""
    if "pred" in df.columns:
        return df
    return df.withColumn("pred", (F.col("p") > threshold).cast("int"))


def confusion_matrix(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return with_decision(df).groupBy(*by, "y", "pred").agg(F.count(F.lit(1)).alias("n"))


def _counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    y, d = F.col("y"), F.col("pred")
    return (
        with_decision(df)
        .groupBy(*by)
        .agg(
            F.count_if((y == 1) & (d == 1)).alias("_tp"),
            F.count_if((y == 0) & (d == 1)).alias("_fp"),
            F.count_if((y == 1) & (d == 0)).alias("_fn"),
            F.count_if((y == 0) & (d == 0)).alias("_tn"),
        )
    )


def precision_recall_f1(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """For the positive class; an empty denominator gives 0."""
    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")
    return _counts(df, by).select(
        *by,
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def classification_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, with averages and accuracy."""
    c = F.col

    def row(label: str, hit: str, wrong: str, missed: str) -> Column:
        h, w, m = c(hit), c(wrong), c(missed)
        return F.struct(
            F.lit(label).alias("class"),
            _ratio(h, h + w).alias("precision"),
            _ratio(h, h + m).alias("recall"),
            _ratio(2 * h, 2 * h + w + m).alias("f1"),
            (h + m).alias("support"),
        )

    both = _counts(df, by).withColumns(
        {"_c0": row("0", "_tn", "_fn", "_fp"), "_c1": row("1", "_tp", "_fp", "_fn")}
    )
    total = c("_c0.support") + c("_c1.support")

    def average(label: str, w0: Column, w1: Column) -> Column:
        parts = [
            _ratio(w0 * c(f"_c0.{m}") + w1 * c(f"_c1.{m}"), w0 + w1).alias(m)
            for m in ("precision", "recall", "f1")
        ]
        return F.struct(F.lit(label).alias("class"), *parts, total.alias("support"))

    right = _ratio(c("_tp") + c("_tn"), total)
    accuracy = F.struct(
        F.lit("accuracy").alias("class"),
        *[right.alias(m) for m in ("precision", "recall", "f1")],
        total.alias("support"),
    )
    one = F.lit(1.0)
    lines = F.array(
        c("_c0"),
        c("_c1"),
        average("macro avg", one, one),
        average("weighted avg", c("_c0.support"), c("_c1.support")),
        accuracy,
    )
    return both.select(*by, F.inline(lines))


def classification_scorecard(
    df: DataFrame, by: Sequence[str], key: str = "key", share: float = 0.10
) -> DataFrame:
    """One row per group: AUC, F1, precision, recall and lift."""
    lift = lift_at_k(df, share, by, key).select(*by, F.round("lift", 3).alias("lift_at_10"))
    auc = roc_auc(df, by).select(*by, F.round("roc_auc", 4).alias("roc_auc"))
    rest = precision_recall_f1(df, by).select(
        *by, *[F.round(m, 4).alias(m) for m in ("f1", "precision", "recall")]
    )
    return auc.join(rest, list(by)).join(lift, list(by))


# --- regression ---------------------------------------------------------------


def regression_scorecard(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R2 of ``yhat`` against ``y`` from one pass."""
    miss = F.col("y") - F.col("yhat")
    sums = df.groupBy(*by).agg(
        F.avg(miss * miss).alias("_mse"),
        F.avg(F.abs(miss)).alias("_mae"),
        F.var_pop("y").alias("_var"),
    )
    return sums.select(
        *by,
        F.round(F.sqrt("_mse"), 4).alias("rmse"),
        F.round("_mae", 4).alias("mae"),
        F.round(1 - F.try_divide(F.col("_mse"), F.col("_var")), 4).alias("r2"),
    )


def residuals(df: DataFrame) -> DataFrame:
    return df.withColumn("residual", F.col("y") - F.col("yhat"))


def residual_qq(df: DataFrame, key: Sequence[str], points: int = 101) -> DataFrame:
    """Residual quantiles against normal quantiles at evenly spaced probabilities.

    The wanted ranks are known from the row count, so the global position of
    each residual is all that is needed; about two rows per point are kept.
    """
    from statistics import NormalDist

    spark = df.sparkSession
    values = residuals(df).select("residual", *key)
    n = values.count()
    probs = [(i + 0.5) / points for i in range(points)]
    places = [(n - 1) * p for p in probs]
    wanted = sorted({int(x) + d for x in places for d in (0, 1) if int(x) + d < n})
    at = with_running(values, ["residual", *key], {})
    at = at.filter((F.col("position") - 1).isin(wanted)).select(
        (F.col("position") - 1).alias("place"), "residual"
    )
    frame = spark.createDataFrame(
        [
            (i, p, NormalDist().inv_cdf(p), int(x), min(int(x) + 1, n - 1), x - int(x))
            for i, (p, x) in enumerate(zip(probs, places))
        ],
        "point int, prob double, theoretical double, lo bigint, hi bigint, part double",
    )
    low = at.select(F.col("place").alias("lo"), F.col("residual").alias("_a"))
    high = at.select(F.col("place").alias("hi"), F.col("residual").alias("_b"))
    return (
        frame.join(low, "lo")
        .join(high, "hi")
        .select(
            "point",
            "prob",
            "theoretical",
            (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("part")).alias("observed"),
        )
    )
