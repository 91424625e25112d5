"""Class-balanced estimators from ``pyspark.ml`` and what is read off a fitted model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.operators.splitting import class_weights

FEATURES, WEIGHT, PROBABILITY = "features", "weight", "p"
MODEL_NAMES = ("Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting")


def estimator(name: str, label: str = "Churn", total_weight: float = 1.0, seed: int = 42, **overrides):
    """The unfitted model of that name with its default settings; ``overrides`` are estimator parameters.

    Spark penalises the mean loss, the usual C form penalises the sum: C = 1 is ``regParam = 1 / total_weight``.
    Inputs are already scaled, hence no further standardisation.
    """
    common = {"featuresCol": FEATURES, "labelCol": label, "weightCol": WEIGHT}
    if name == "Logistic Regression":
        settings = {"regParam": 1.0 / total_weight, "elasticNetParam": 0.0, "standardization": False,
                    "maxIter": 1000, "tol": 1e-6}
        return LogisticRegression(**common, **{**settings, **overrides})
    trees = {"seed": seed, "maxBins": 128, "cacheNodeIds": False}
    if name == "Decision Tree":
        settings = {**trees, "maxDepth": 6, "minInstancesPerNode": 20}
        return DecisionTreeClassifier(**common, **{**settings, **overrides})
    if name == "Random Forest":
        # The same forest; each row's node per tree is kept, where Spark else walks every tree from its root at each level.
        settings = {**trees, "numTrees": 200, "maxDepth": 10, "featureSubsetStrategy": "sqrt", "minInstancesPerNode": 10,
                    "cacheNodeIds": True}
        return RandomForestClassifier(**common, **{**settings, **overrides})
    if name == "Gradient Boosting":
        settings = {**trees, "maxIter": 200, "stepSize": 0.05, "maxDepth": 4, "subsamplingRate": 0.8,
                    "featureSubsetStrategy": "sqrt"}
        return GBTClassifier(**common, **{**settings, **overrides})
    raise ValueError(f"unknown model {name!r}, known: {', '.join(MODEL_NAMES)}")


def balanced(train: DataFrame, label: str = "Churn") -> DataFrame:
    return class_weights(train, label, WEIGHT)


def fit(name: str, train: DataFrame, features: Sequence[str], label: str = "Churn", **overrides) -> PipelineModel:
    """Fit on rows that carry a ``weight``; the sum of balanced weights is the row count."""
    total = train.agg(F.sum(WEIGHT)).first()[0] if name == "Logistic Regression" else 1.0
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES)
    return Pipeline(stages=[assembler, estimator(name, label, total, **overrides)]).fit(train)


def fit_all(
    names: Sequence[str], train: DataFrame, features: Sequence[str], label: str = "Churn",
    overrides: Mapping[str, Mapping] | None = None,
) -> dict[str, PipelineModel]:
    """All named models on the same rows, submitted together: the short jobs of one fit use the cores that the
    last tasks of another leave idle. Persist ``train`` before."""
    def run(name):
        return fit(name, train, features, label, **(overrides or {}).get(name, {}))

    with ThreadPool(len(names)) as pool:
        return dict(zip(names, pool.map(inheritable_thread_target(train.sparkSession)(run), names, chunksize=1)))


def score(model: PipelineModel, df: DataFrame, probability: str = PROBABILITY) -> DataFrame:
    """Probability of the positive class as a plain column; the vector columns are dropped."""
    scored = model.transform(df).withColumn(probability, vector_to_array("probability")[1])
    return scored.drop(FEATURES, "rawPrediction", "probability", "prediction")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importances(spark: SparkSession, model: PipelineModel, features: Sequence[str], top: int = 20) -> DataFrame:
    """Importance per feature of a tree model, highest first; one row per feature."""
    fitted = model.stages[-1]
    if not hasattr(fitted, "featureImportances"):
        raise ValueError("only tree models have feature importances")
    values = fitted.featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(features, values)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature").limit(top)


def tree_rules(spark: SparkSession, model: PipelineModel, features: Sequence[str], max_depth: int = 3) -> DataFrame:
    """Rules of a decision tree down to ``max_depth`` as text lines with feature names."""
    lines = []
    for raw in model.stages[-1].toDebugString.splitlines()[1:]:
        text = raw.strip()
        depth = (len(raw) - len(raw.lstrip()) - 2)
        if not text or depth >= 2 * max_depth + 2 or depth > max_depth:
            continue
        head, found, tail = text.partition("feature ")
        if found:
            number, _, rest = tail.partition(" ")
            text = f"{head}{features[int(number)]} {rest}"
        lines.append((len(lines) + 1, depth, text))
    return spark.createDataFrame(lines, "line int, depth int, rule string")


def reload_difference(first: DataFrame, second: DataFrame, key: str = "customerID", probability: str = PROBABILITY) -> DataFrame:
    """Largest difference between two scorings of the same rows, joined on the key."""
    a = first.select(key, F.col(probability).alias("a"))
    b = second.select(key, F.col(probability).alias("b"))
    return a.join(b, key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_difference"))
