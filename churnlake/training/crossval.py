"""Cross-validation over the fold column: fit on the others, score the fold, evaluate all folds at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.numbers import round_even
from churnlake.operators.evaluation import evaluate
from churnlake.operators.scaling import apply_scaler, fit_scaler
from churnlake.training import models


def fold_scores(
    train: DataFrame, names: Sequence[str], features: Sequence[str], label: str = "Churn", folds: int = 5,
    overrides: Mapping[str, Mapping] | None = None, key: str = "customerID", parallelism: int = 4,
) -> DataFrame:
    """(model, fold, key, label, p) for every training row, scored by a model that did not see it.

    The scaler and the class weights are fitted inside the fold. ``train`` has unscaled features and ``fold``;
    persist it before. As in Spark's own cross-validator, ``parallelism`` fits are submitted at a time.
    """
    def run(task):
        k, name = task
        seen, held = train.where(F.col("fold") != k), train.where(F.col("fold") == k)
        parameters = fit_scaler(seen)
        weighted = models.balanced(apply_scaler(seen, parameters), label)
        model = models.fit(name, weighted, features, label, **(overrides or {}).get(name, {}))
        scored = models.score(model, apply_scaler(held, parameters))
        return scored.select(F.lit(name).alias("model"), "fold", key, label, models.PROBABILITY)

    # Fold by fold, so that what is fitted side by side are different models and not as many forests, which keep most.
    tasks = [(k, name) for k in range(folds) for name in names]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        parts = pool.map(inheritable_thread_target(train.sparkSession)(run), tasks, chunksize=1)
    return reduce(DataFrame.unionByName, parts)


def cross_validate(scored: DataFrame, label: str = "Churn", threshold: float = 0.50) -> DataFrame:
    """Mean fold metrics per model, four decimals. The default cut is the classifier's own 0.5."""
    names = ("accuracy", "f1", "recall", "precision", "roc_auc")
    per_fold = evaluate(scored, models.PROBABILITY, label, threshold, ["model", "fold"])
    return per_fold.groupBy("model").agg(
        F.lit(threshold).alias("threshold"), *[round_even(F.avg(n), 4).alias(n) for n in names])
