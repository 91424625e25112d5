"""Fitted models: the optimum of the penalised loss, balanced weights, reload, rules and importances."""

import threading
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlake.catalog import QUERIES, modelling, relations
from churnlake.session import scratch_path
from churnlake.training import crossval, models

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 600
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(1.2 * a - 0.7 * b - 1)))).astype(int)
    frame = pd.DataFrame({"customerID": [str(i) for i in range(n)], "a": a, "b": b, "Churn": y, "fold": np.arange(n) % 5})
    return frame, models.balanced(spark.createDataFrame(frame)).persist()


def test_logistic_regression_minimises_the_summed_loss(data):
    """Coefficients of C = 1 with balanced weights, against Newton steps in NumPy."""
    frame, df = data
    x = np.column_stack([np.ones(len(frame)), frame.a, frame.b])
    y = frame.Churn.to_numpy()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta, penalty = np.zeros(3), np.diag([0.0, 1.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (w * (p - y)) + penalty @ beta
        beta -= np.linalg.solve(x.T @ (x * (w * p * (1 - p))[:, None]) + penalty, gradient)
    fitted = models.fit("Logistic Regression", df, FEATURES, tol=1e-10).stages[-1]
    assert fitted.intercept == pytest.approx(beta[0], abs=1e-4)
    assert list(fitted.coefficients) == pytest.approx(list(beta[1:]), abs=1e-4)


@pytest.mark.parametrize("name, settings", [
    ("Decision Tree", {}), ("Random Forest", {"numTrees": 10}), ("Gradient Boosting", {"maxIter": 5})])
def test_tree_models_learn_and_report(spark, data, name, settings):
    _, df = data
    model = models.fit(name, df, FEATURES, **settings)
    scored = models.score(model, df)
    assert scored.where("p < 0 OR p > 1").count() == 0 and "features" not in scored.columns
    importances = models.feature_importances(spark, model, FEATURES).collect()
    assert importances[0].feature == "a" and sum(r.importance for r in importances) == pytest.approx(1)


def test_forest_keeps_the_node_of_each_row_and_stays_the_same(data):
    """Else every tree is walked from its root for every row at every level: half of the time of a fit."""
    _, df = data
    kept, walked = (models.fit("Random Forest", df, FEATURES, numTrees=20, **s) for s in ({}, {"cacheNodeIds": False}))
    assert kept.stages[-1].getCacheNodeIds()
    assert kept.stages[-1].toDebugString.splitlines()[1:] == walked.stages[-1].toDebugString.splitlines()[1:]


def test_models_are_fitted_side_by_side(data, monkeypatch):
    """Each fit waits for the other to have begun; the models are those of single fits."""
    _, df = data
    settings = {"Random Forest": {"numTrees": 5}}
    alone = {n: models.fit(n, df, FEATURES, **settings.get(n, {})) for n in ("Decision Tree", "Random Forest")}
    begun, fit = threading.Barrier(2, timeout=60), models.fit
    monkeypatch.setattr(models, "fit", lambda *a, **b: (begun.wait(), fit(*a, **b))[1])
    together = models.fit_all(list(alone), df, FEATURES, overrides=settings)
    for name, model in alone.items():
        assert together[name].stages[-1].toDebugString.splitlines()[1:] == model.stages[-1].toDebugString.splitlines()[1:]


def test_test_scores_are_written_before_they_are_evaluated(spark, folder):
    """The evaluation reads a table; it does not run the models once per pass."""
    ready = modelling.Prepared(modelling.Tables(spark, folder, True))
    metrics = ready.test_metrics(ready.fit_all(["Decision Tree"]))
    assert "InMemory" not in metrics._jdf.queryExecution().optimizedPlan().toString()
    assert metrics.count() == 1


def test_reload_gives_equal_scores(spark, data):
    _, df = data
    model = models.fit("Decision Tree", df, FEATURES)
    path = scratch_path(spark, "tree")
    models.save(model, path)
    row = models.reload_difference(models.score(model, df), models.score(models.load(path), df)).first()
    assert (row.n_rows, row.max_difference) == (600, 0.0)


def test_tree_rules_name_the_features(spark, data):
    _, df = data
    rules = models.tree_rules(spark, models.fit("Decision Tree", df, FEATURES), FEATURES, max_depth=2).collect()
    assert rules[0].rule.startswith("If (a <=") and all("feature " not in r.rule for r in rules)
    assert max(r.depth for r in rules) <= 2
    with pytest.raises(ValueError):
        models.feature_importances(spark, models.fit("Logistic Regression", df, FEATURES), FEATURES)
    with pytest.raises(ValueError):
        models.estimator("Other")


def test_every_training_row_is_scored_once_out_of_fold(data):
    _, df = data
    scored = crossval.fold_scores(df.drop("weight"), ["Decision Tree"], FEATURES)
    assert scored.count() == 600 and scored.select("customerID").distinct().count() == 600
    row = crossval.cross_validate(scored).first()
    assert 0.6 < row.roc_auc <= 1 and row.threshold == 0.5
    assert scored.where(F.col("model") != "Decision Tree").count() == 0


def test_the_registered_cross_validation_takes_every_model(spark, data, monkeypatch):
    """The whole queries over rows of this test, with small ensembles: no model is without out-of-fold metrics."""
    _, df = data
    part = F.when(F.col("customerID").cast("int") % 6 == 0, "test").otherwise("train")
    fold = F.when(F.col("split") == "train", F.col("fold"))
    rows = df.drop("weight").coalesce(1).withColumn("split", part).withColumn("fold", fold)
    small = {"Random Forest": {"numTrees": 3, "maxDepth": 3}, "Gradient Boosting": {"maxIter": 3, "maxDepth": 2}}
    estimator = models.estimator
    monkeypatch.setattr(models, "estimator", lambda name, *a, **b: estimator(name, *a, **{**small.get(name, {}), **b}))
    monkeypatch.setattr(relations, "Tables", lambda *a: SimpleNamespace(spark=spark, split=rows, feature_names=FEATURES))
    validated = {r.model: r for r in QUERIES["ml_6_cross_validation"](spark, "").collect()}
    report = {r.model: r for r in QUERIES["evl_8_comparison_report"](spark, "").collect()}
    assert set(validated) == set(report) == set(models.MODEL_NAMES)
    for name, row in report.items():
        alone = validated[name]
        assert [row.cv_accuracy, row.cv_f1, row.cv_recall, row.cv_roc_auc] == pytest.approx(
            [alone.accuracy, alone.f1, alone.recall, alone.roc_auc], abs=1e-4)
        assert 0.5 < row.cv_roc_auc <= 1
    spark.catalog.clearCache()
