import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hearthscore.config import SHORT_RUN
from hearthscore.operators import matrix as mx
from hearthscore.operators import models as md
from hearthscore.operators.split import class_weights, with_class_weight

PRODUCTS = ["alpha", "beta"]


@pytest.fixture(scope="module")
def households(spark):
    """Learnable: alpha follows income, cost follows calls."""
    rng = np.random.default_rng(7)
    n = 600
    income = rng.normal(60000, 20000, n)
    calls = rng.poisson(2, n).astype(float)
    alpha = (income + rng.normal(0, 8000, n) > 75000).astype(int)
    beta = (rng.random(n) < 0.02).astype(int)
    cost = 50 * calls + rng.exponential(5, n) * (calls > 0)
    rows = [
        (i, None if i % 17 == 0 else float(income[i]), float(calls[i]), "abc"[i % 3] if i % 11 else None,
         int(alpha[i]), int(beta[i]), int(alpha[i] + beta[i]), int(alpha[i] + beta[i] >= 2), float(cost[i]))
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "household_key long, income_mean double, total_ers_calls double, zip string, alpha int, beta int,"
        " product_count int, is_multi_product int, total_cost_sum double",
    ).persist()


def labels_in(df):
    texts = [c for c, kind in df.dtypes if kind == "string"]
    rows = df.select(*texts).collect()
    return {c: sorted({"Not Set" if r[c] is None else r[c] for r in rows}) for c in texts}


def test_matrix_has_no_nulls_and_keeps_the_key(households):
    out = mx.build_matrix(households, PRODUCTS, labels_in(households))
    assert out.count() == 600 and "household_key" in out.columns
    assert not set(PRODUCTS) & set(out.columns)
    nulls = out.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in out.columns]).first()
    assert sum(nulls) == 0
    assert {"zip=a", "zip=b", "zip=c", "zip=Not Set"} <= set(out.columns)


def test_sparse_matrix_against_plain_python(spark, households):
    """Slots, medians, missing labels and labels outside a given dictionary."""
    df = households.withColumns({
        "mark": F.when(F.col("household_key") % 3 == 0, "ä b").when(F.col("household_key") % 3 == 1, "a`="),
        "never": F.lit(None).cast("double"),
    }).repartition(4)
    matrix, names = mx.sparse_matrix(df, PRODUCTS)
    name = {r.slot: r.name for r in names.collect()}
    assert sorted(name) == list(range(len(name))) and "never" not in name.values()
    rows = {r.household_key: r for r in df.collect()}
    median = float(np.median([r.income_mean for r in rows.values() if r.income_mean is not None]))
    got = matrix.collect()
    assert len(got) == 600
    for r in got:
        cells, row = dict(zip((name[i] for i in r.slots), r["values"])), rows[r.household_key]
        want = {f"zip={row.zip or 'Not Set'}": 1.0, f"mark={row.mark or 'Not Set'}": 1.0}
        numbers = {c: row[c] for c in ("income_mean", "total_ers_calls", "product_count", "is_multi_product", "total_cost_sum")}
        numbers["income_mean"] = median if numbers["income_mean"] is None else numbers["income_mean"]
        assert cells == {**numbers, **want} and list(r.slots) == sorted(r.slots)
    few = mx.label_dictionary(df.where("zip = 'a'"), ["mark", "zip"])
    part, _ = mx.sparse_matrix(df, PRODUCTS, dictionary=few, medians={"total_ers_calls": 0.0})
    known = {r.household_key: r for r in part.where("household_key in (1, 3)").collect()}
    assert known[1]["values"] == [rows[1].total_ers_calls]  # neither label is in the dictionary
    assert known[3]["values"] == [rows[3].total_ers_calls, 1.0, 1.0]


def test_sparse_matrix_without_text_or_rows(spark, households):
    matrix, names = mx.sparse_matrix(households.select("household_key", "income_mean"))
    assert names.count() == 1 and all(list(r.slots) == [0] for r in matrix.collect())
    matrix, names = mx.sparse_matrix(households.limit(0))
    assert matrix.count() == 0 and names.count() == 0


def test_empty_column_is_left_out(households):
    df = households.withColumn("never", F.lit(None).cast("double"))
    assert "never" not in mx.build_matrix(df, PRODUCTS, labels_in(df)).columns


def test_medians_and_labels_come_from_the_training_rows(households):
    train = households.filter("household_key < 100 and zip = 'a' or zip is null")
    model = mx.fit_matrix(train, ["household_key", *PRODUCTS])
    row = households.filter("household_key = 1").withColumns(
        {"income_mean": F.lit(None).cast("double"), "zip": F.lit("b")}
    )
    ready = model.transform(row)
    got = dict(zip(mx.feature_names(ready), ready.select(vector_to_array("features")).first()[0]))
    want = train.selectExpr("percentile(income_mean, 0.5)").first()[0]
    assert got["income_mean"] == pytest.approx(want)
    assert got["zip_a"] == 0.0 and "zip_b" not in got


def test_exact_median_is_used(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, None])], "k long, a double")
    assert mx.impute_median(df, ["a"]).orderBy("k").collect()[-1].a == 2.5


def test_unseen_label_is_all_zero(spark, households):
    model = mx.fit_matrix(households, ["household_key", *PRODUCTS])
    row = households.limit(1).withColumn("zip", F.lit("never seen"))
    ready = model.transform(row)
    names = mx.feature_names(ready)
    values = ready.select(vector_to_array("features")).first()[0]
    assert [v for n, v in zip(names, values) if n.startswith("zip_")] == [0.0] * 4


def test_forbidden_column_is_refused(households):
    with pytest.raises(ValueError, match="cancel_date"):
        mx.build_matrix(households.withColumn("cancel_date", F.lit("x")), PRODUCTS, {})


def test_target_is_not_among_its_own_features(households):
    fitted, scored = md.train_product(households, "alpha", PRODUCTS, SHORT_RUN, ["random_forest"])
    names = fitted[0].features
    assert "other_products" in names
    assert not {"alpha", "product_count", "is_multi_product"} & set(names)
    assert {r.split for r in scored.select("split").distinct().collect()} == {"test", "validation"}


def test_all_estimators_learn(households):
    fitted, scored = md.train_all_products(households, PRODUCTS, SHORT_RUN)
    assert {f.target for f in fitted} == {"alpha"}  # beta is too rare
    out = {r.model: r for r in md.classification_summary(scored).collect()}
    assert set(out) == set(md.CLASSIFIERS)
    assert all(r.roc_auc > 0.8 and r.lift_at_10 > 1.5 for r in out.values())
    rows = md.feature_importance(fitted[0], 3)
    assert rows[0][3] == "income_mean"


def test_failing_estimator_fails_the_training(households, monkeypatch):
    def broken(*_):
        raise RuntimeError("no luck")

    monkeypatch.setitem(md.CLASSIFIERS, "random_forest", broken)
    with pytest.raises(RuntimeError, match="no luck"):
        md.train_product(households, "alpha", PRODUCTS, SHORT_RUN, ["random_forest", "boosted_trees"])


def test_one_class_gives_no_model(households):
    same = households.withColumn("alpha", F.lit(1))
    assert md.train_product(same, "alpha", PRODUCTS, SHORT_RUN, ["random_forest"]) == ([], None)


def test_logistic_reaches_the_penalised_optimum(households):
    """Gradient of the balanced, unit-strength L2 problem vanishes at the solution."""
    data = households.select("household_key", "alpha", F.coalesce("income_mean", F.lit(0.0)).alias("a"), "total_ers_calls")
    from pyspark.ml.feature import VectorAssembler

    ready = VectorAssembler(inputCols=["a", "total_ers_calls"], outputCol="features").transform(
        data.withColumn("label", F.col("alpha"))
    )
    ready = with_class_weight(ready, "label", class_weights(ready, "label"))
    n = ready.count()
    scaler, model = md.logistic_regression(ready, SHORT_RUN, n)
    rows = ready.collect()
    x = np.array([[r.a, r.total_ers_calls] for r in rows])
    x = (x - x.mean(0)) / x.std(0)
    y, w = np.array([r.label for r in rows]), np.array([r.weight for r in rows])
    coef = model.coefficients.toArray() * np.sqrt((n - 1) / n)
    raw = np.array([[r.a, r.total_ers_calls] for r in rows])
    z = raw / raw.std(0, ddof=1) @ model.coefficients.toArray() + model.intercept
    grad = x.T @ (w * (1 / (1 + np.exp(-z)) - y)) + coef
    assert np.abs(grad).max() / n < 1e-5


def test_cost_models(households):
    fitted, scored = md.train_cost_models(households, PRODUCTS, SHORT_RUN)
    out = {r.model: r for r in md.regression_summary(scored).collect()}
    assert set(out) == set(md.REGRESSORS)
    assert all("cost" not in name for f in fitted for name in f.features)
    assert scored.agg(F.min("yhat")).first()[0] >= 0
    assert out["huber"].r2 > 0.9 and out["random_forest"].r2 > 0.8


def test_ridge_matches_the_closed_form(households):
    from pyspark.ml.feature import VectorAssembler
    from dataclasses import replace

    data = VectorAssembler(inputCols=["a", "total_ers_calls"], outputCol="features").transform(
        households.select("household_key", F.coalesce("income_mean", F.lit(0.0)).alias("a"), "total_ers_calls",
                          F.log1p("total_cost_sum").alias("log_target"))
    )
    n = data.count()
    stages = md.ridge(data, replace(SHORT_RUN, ridge_alphas=(50.0,)), n)
    model = stages[1]
    rows = data.collect()
    x = np.array([[r.a, r.total_ers_calls] for r in rows])
    x = (x - x.mean(0)) / x.std(0)
    y = np.array([r.log_target for r in rows])
    want = np.linalg.solve(x.T @ x + 50 * np.eye(2), x.T @ (y - y.mean()))
    got = model.coefficients.toArray() * np.sqrt((n - 1) / n)
    assert got == pytest.approx(want, rel=1e-6)


def test_ridge_chooses_the_penalty_by_held_out_folds(households):
    """Folds, penalties and predictions against numpy, with a constant and a doubled column."""
    from dataclasses import replace

    from pyspark.ml.feature import VectorAssembler

    from hearthscore.operators.split import key_hash

    s = replace(SHORT_RUN, ridge_alphas=(0.01, 10.0, 300.0))
    noise = F.rand(3)
    inputs = households.select(
        "household_key", F.coalesce("income_mean", F.lit(0.0)).alias("a"), "total_ers_calls", noise.alias("e"),
        (F.col("total_ers_calls") * 2).alias("twice"), F.lit(2015.0).alias("same"),
        F.log1p("total_cost_sum").alias("log_target"),
        F.pmod(key_hash("household_key", s.seed + 1), F.lit(s.folds)).cast("int").alias("f"),
    )
    names = ["a", "total_ers_calls", "e", "twice", "same"]
    data = VectorAssembler(inputCols=names, outputCol="features").transform(inputs).persist()
    stages = md.ridge(data, s, data.count())
    rows = data.collect()
    x = np.array([[r[c] for c in names] for r in rows])
    y, f = np.array([r.log_target for r in rows]), np.array([r.f for r in rows])
    sd = np.where(x.std(0) > 0, x.std(0), 1.0)
    z = (x - x.mean(0)) / sd

    def fit(z, y, a):
        m = z.mean(0)
        w = np.linalg.solve((z - m).T @ (z - m) + a * np.eye(z.shape[1]), (z - m).T @ (y - y.mean()))
        return w, y.mean() - w @ m

    def score(a):
        out = []
        for k in range(s.folds):
            w, b = fit(z[f != k], y[f != k], a)
            e = y[f == k] - z[f == k] @ w - b
            out.append(1 - e @ e / ((y[f == k] - y[f == k].mean()) ** 2).sum())
        return np.mean(out)

    w, b = fit(z, y, max(s.ridge_alphas, key=score))
    out = stages[1].transform(stages[0].transform(data)).select("household_key", "prediction").collect()
    got = {r.household_key: r.prediction for r in out}
    want = z @ w + b
    assert all(got[r.household_key] == pytest.approx(v, abs=1e-8) for r, v in zip(rows, want))


def test_ridge_line_is_saved_with_its_pipeline(households, tmp_path):
    from pyspark.ml import PipelineModel

    fitted, scored = md.train_cost_models(households, PRODUCTS, SHORT_RUN, ["ridge"])
    path = f"file://{tmp_path}/ridge"
    fitted[0].pipeline.save(path)
    again = PipelineModel.load(path).transform(households).select("household_key", "yhat")
    known = {r.household_key: r.yhat for r in scored.collect()}
    assert all(known[r.household_key] == pytest.approx(r.yhat) for r in again.collect() if r.household_key in known)
