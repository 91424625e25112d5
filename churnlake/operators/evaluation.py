"""Classifier metrics from counts. ``by`` (model, fold, split) evaluates many models in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake import spec as S
from churnlake.functions.numbers import percent, ratio_or_zero, round_even
from churnlake.operators.ranking import cumulative_counts, score_counts

WEIGHTS = {"roc_auc": 0.40, "recall": 0.40, "f1": 0.20}


def confusion(
    df: DataFrame, score: str = "p", label: str = "Churn", threshold: float = S.THRESHOLD, by: Sequence[str] = (),
) -> DataFrame:
    """tp, fp, fn, tn for scores at or above ``threshold``; a single map-side aggregate."""
    said = F.col(score) >= F.lit(threshold)
    yes, no = F.col(label) == 1, F.col(label) == 0
    return df.groupBy(*by).agg(
        F.count_if(yes & said).alias("tp"), F.count_if(no & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"), F.count_if(no & ~said).alias("tn"),
    )


def rates(counts: DataFrame, keep: Sequence[str] = (), digits: int | None = 4) -> DataFrame:
    """accuracy, precision, recall and F1 of a confusion table; an undefined quotient is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    values = {
        "accuracy": ratio_or_zero(tp + tn, tp + fp + fn + tn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }
    return counts.select(*keep, *[
        (v if digits is None else round_even(v, digits)).alias(n) for n, v in values.items()])


def threshold_metrics(
    df: DataFrame, score: str = "p", label: str = "Churn", threshold: float = S.THRESHOLD, by: Sequence[str] = (),
) -> DataFrame:
    return rates(confusion(df, score, label, threshold, by), by)


def roc_auc(
    df: DataFrame, score: str = "p", label: str = "Churn", by: Sequence[str] = (), digits: int | None = 4,
) -> DataFrame:
    """Area under the ROC curve with ties counted half; null when a class is missing.

    Twice the number of correctly ordered pairs is an integer, summed exactly as DECIMAL.
    """
    steps = cumulative_counts(df, score, label, by)

    def big(c):
        return F.col(c).cast("decimal(18,0)")

    pairs = big("neg") * (big("pos_above") * 2 + big("pos"))
    sums = steps.groupBy(*by).agg(
        F.sum(pairs).alias("pairs2"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    area = F.try_divide(
        F.col("pairs2").cast("double"), F.lit(2.0) * F.col("pos").cast("double") * F.col("neg").cast("double"))
    return sums.select(*by, (area if digits is None else round_even(area, digits)).alias("roc_auc"))


def evaluate(
    df: DataFrame, score: str = "p", label: str = "Churn", threshold: float = S.THRESHOLD, by: Sequence[str] = (),
) -> DataFrame:
    """Threshold metrics and AUC side by side, one row per group.

    Both come from the counts per distinct score, whose exchange Spark builds once and uses twice.
    """
    said = F.col("score") >= F.lit(threshold)
    cells = score_counts(df, score, label, by).groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(where, F.col(n))), F.lit(0)).alias(cell)
        for cell, n, where in (("tp", "pos", said), ("fp", "neg", said), ("fn", "pos", ~said), ("tn", "neg", ~said))])
    metrics, area = rates(cells, by), roc_auc(df, score, label, by)
    if not by:
        return metrics.withColumn("roc_auc", area.scalar())
    return metrics.join(F.broadcast(area), list(by))


def confusion_cells(
    df: DataFrame, score: str = "p", label: str = "Churn", threshold: float = S.THRESHOLD, by: Sequence[str] = (),
) -> DataFrame:
    """Four cells with their share of the actual class."""
    c = confusion(df, score, label, threshold, by)
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(n).alias("n"), whole.alias("row_n"))
        for a, p, n, whole in (
            (0, 0, "tn", F.col("tn") + F.col("fp")), (0, 1, "fp", F.col("tn") + F.col("fp")),
            (1, 0, "fn", F.col("fn") + F.col("tp")), (1, 1, "tp", F.col("fn") + F.col("tp")))
    ])
    return c.select(*by, F.inline(cells)).select(
        *by, "actual", "predicted", "n", percent(F.col("n"), F.col("row_n")).alias("row_pct"))


def roc_curve(df: DataFrame, score: str = "p", label: str = "Churn", by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; the origin is the point before the highest score.

    Class totals are one row per group and come from the counts, not from a second pass over the data.
    """
    steps = cumulative_counts(df, score, label, by)
    totals = steps.groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    if by:
        same = F.lit(True)
        for k in by:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        joined = steps.join(F.broadcast(totals), same)
        p, n = F.col("P"), F.col("N")
    else:
        joined = steps.withColumn("_t", totals.select(F.struct("P", "N")).scalar())
        p, n = F.col("_t.P"), F.col("_t.N")
    return joined.select(
        *by, F.col("score").alias("threshold"),
        round_even(F.try_divide((F.col("neg_above") + F.col("neg")).cast("double"), n.cast("double")), 6).alias("fpr"),
        round_even(F.try_divide((F.col("pos_above") + F.col("pos")).cast("double"), p.cast("double")), 6).alias("tpr"),
    )


def threshold_sweep(
    df: DataFrame, score: str = "p", label: str = "Churn", by: Sequence[str] = (), first: int = 10, last: int = 90,
    digits: int | None = 6,
) -> DataFrame:
    """precision, recall and F1 at first/100 ... last/100.

    Each score is put once into the highest hundredth it reaches; the sweep is a running sum over those at
    most 101 counts per group.
    """
    s = F.col(score)
    guess = F.floor(s * 100)
    step = guess + F.when(s >= (guess + 1) / F.lit(100.0), 1).otherwise(0) - F.when(s < guess / F.lit(100.0), 1).otherwise(0)
    level = F.greatest(F.lit(first - 1), F.least(F.lit(last), step)).cast("int")
    counts = (
        df.where(s.isNotNull() & F.col(label).isNotNull()).groupBy(*by, level.alias("level"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    per_group = counts.groupBy(*by).agg(
        F.collect_list(F.struct("level", "pos", "neg")).alias("levels"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    swept = per_group.select(*by, "P", "N", "levels", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("cut"))

    def above(field):
        return F.aggregate(
            "levels", F.lit(0).cast("bigint"),
            lambda acc, x: acc + F.when(x["level"] >= F.col("cut"), x[field]).otherwise(F.lit(0)))

    points = swept.select(
        *by, (F.col("cut") / F.lit(100.0)).alias("threshold"), above("pos").alias("tp"), above("neg").alias("fp"), "P", "N",
    ).withColumns({"fn": F.col("P") - F.col("tp"), "tn": F.col("N") - F.col("fp")})
    return rates(points, [*by, "threshold"], digits).drop("accuracy")


def best_threshold(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The lowest threshold with the highest F1, per group of a sweep table."""
    order = F.struct(F.col("f1"), -F.col("threshold"))
    best = sweep.groupBy(*by).agg(F.max_by(F.struct("threshold", "precision", "recall", "f1"), order).alias("best"))
    return best.select(*by, "best.*")


def selection_score(metrics: DataFrame, weights: dict = WEIGHTS) -> DataFrame:
    """Weighted score per model and the winner mark; the metrics table has one row per model."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.lit(weight) * F.col(name)
    place = F.row_number().over(Window.orderBy(F.col("selection_score").desc(), "model"))
    return metrics.withColumn("selection_score", round_even(total, 6)).withColumn("is_best", place == 1)


def comparison_report(test: DataFrame, cv: DataFrame, threshold: float = S.THRESHOLD) -> DataFrame:
    """Test and cross-validation metrics side by side with the winner marked."""
    names = ("accuracy", "precision", "recall", "f1", "roc_auc")
    scored = selection_score(test)
    folds = cv.select("model", *[F.col(n).alias(f"cv_{n}") for n in names if n != "precision"])
    return scored.join(F.broadcast(folds), "model", "left").select(
        "model", *[F.col(n).alias(f"test_{n}") for n in names],
        "cv_accuracy", "cv_f1", "cv_recall", "cv_roc_auc",
        F.lit(threshold).alias("threshold"), F.when(F.col("is_best"), "★").otherwise("").alias("best_model"),
    )


def class_report(
    df: DataFrame, score: str = "p", label: str = "Churn", threshold: float = S.THRESHOLD,
) -> DataFrame:
    """precision, recall, F1 and support per class with macro and weighted means and accuracy."""
    c = confusion(df, score, label, threshold)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))

    def line(name, hit, false, missed):
        return F.struct(
            F.lit(name).alias("name"), ratio_or_zero(hit, hit + false).alias("precision"),
            ratio_or_zero(hit, hit + missed).alias("recall"),
            ratio_or_zero(2 * hit, 2 * hit + false + missed).alias("f1"), (hit + missed).alias("support"))

    base = c.select(
        line("No Churn", tn, fn, fp).alias("a"), line("Churned", tp, fp, fn).alias("b"),
        (tp + fp + fn + tn).alias("n"), ratio_or_zero(tp + tn, tp + fp + fn + tn).alias("acc"))

    def mean(name, wa, wb):
        return F.struct(
            F.lit(name).alias("name"),
            *[(wa * F.col(f"a.{m}") + wb * F.col(f"b.{m}")).alias(m) for m in ("precision", "recall", "f1")],
            F.col("n").alias("support"))

    share_a = ratio_or_zero(F.col("a.support"), F.col("n"))
    share_b = ratio_or_zero(F.col("b.support"), F.col("n"))
    accuracy = F.struct(
        F.lit("accuracy").alias("name"), *[F.col("acc").alias(m) for m in ("precision", "recall", "f1")],
        F.col("n").alias("support"))
    lines = F.array(
        F.col("a"), F.col("b"), accuracy, mean("macro avg", F.lit(0.5), F.lit(0.5)), mean("weighted avg", share_a, share_b))
    return base.select(F.inline(lines)).select(
        "name", *[round_even(F.col(m), 4).alias(m) for m in ("precision", "recall", "f1")], "support")


def naive_baseline(df: DataFrame, label: str = "Churn") -> DataFrame:
    """Accuracy and recall of always predicting no churn."""
    return df.agg(
        round_even(F.try_divide(F.count_if(F.col(label) == 0), F.count(label)), 6).alias("accuracy"),
        F.lit(0.0).alias("recall"))
