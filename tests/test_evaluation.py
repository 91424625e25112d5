"""Metrics and ranks against brute force, with ties, one class and concentrated scores."""

import numpy as np
import pytest

from churnlake.operators import evaluation, ranking, scoring
from churnlake.spec import TIERS


def frame(spark, pairs):
    return spark.createDataFrame([(int(y) if y is not None else None, float(p)) for y, p in pairs], "Churn int, p double")


def brute_auc(pairs):
    pos, neg = [p for y, p in pairs if y == 1], [p for y, p in pairs if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


RNG = np.random.default_rng(3)
SCORES = {
    "ties": [(1, .9), (0, .8), (1, .8), (0, .1)],
    "all_tied": [(1, .5), (0, .5), (0, .5)],
    "ends": [(1, 1.0), (0, 0.0), (1, 0.0), (0, 1.0)],
    "random": list(zip(RNG.integers(0, 2, 300), RNG.random(300))),
    "concentrated": list(zip(RNG.integers(0, 2, 300), 0.27 + RNG.random(300) * 1e-9)),
    "hot": list(zip(RNG.integers(0, 2, 300), np.where(RNG.random(300) < .5, .31, RNG.random(300)))),
}


@pytest.mark.parametrize("name", SCORES)
@pytest.mark.parametrize("depth", [2, 8])
def test_running_counts_and_auc(spark, name, depth):
    pairs = SCORES[name]
    df = frame(spark, pairs)
    for r in ranking.cumulative_counts(df, "p", "Churn", depth=depth).collect():
        assert r.pos_above == sum(y == 1 and p > r.score for y, p in pairs)
        assert r.neg_above == sum(y == 0 and p > r.score for y, p in pairs)
    assert evaluation.roc_auc(df, digits=None).first()[0] == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_four_row_auc(spark):
    assert evaluation.roc_auc(frame(spark, SCORES["ties"])).first()[0] == 0.875


def test_one_class_has_no_auc_and_zero_rates(spark):
    row = evaluation.evaluate(frame(spark, [(0, .1), (0, .2)])).first()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.roc_auc) == (1.0, 0.0, 0.0, 0.0, None)


def test_groups_are_separate(spark):
    rows = [("a", 1, .9), ("a", 0, .1), ("b", 1, .1), ("b", 0, .9), ("b", None, .5)]
    df = spark.createDataFrame(rows, "model string, Churn int, p double")
    got = {r.model: (r.accuracy, r.roc_auc) for r in evaluation.evaluate(df, by=["model"]).collect()}
    assert got == {"a": (1.0, 1.0), "b": (0.0, 0.0)}
    points = {(r.model, r.threshold): (r.fpr, r.tpr) for r in evaluation.roc_curve(df, by=["model"]).collect()}
    assert points[("a", .9)] == (0.0, 1.0) and points[("b", .9)] == (1.0, 0.0) and points[("b", .1)] == (1.0, 1.0)


def test_sweep_on_the_cut_points(spark):
    """Scores that sit on i/100 count as predicted at that threshold."""
    pairs = [(i % 3 == 0, i / 100) for i in range(0, 101)] + [(1, 0.2899999), (0, 0.5700001)]
    rows = {round(r.threshold * 100): r for r in evaluation.threshold_sweep(frame(spark, pairs), digits=None).collect()}
    assert sorted(rows) == list(range(10, 91))
    for i, r in rows.items():
        tp = sum(bool(y) and p >= i / 100 for y, p in pairs)
        fp = sum(not y and p >= i / 100 for y, p in pairs)
        fn = sum(bool(y) for y, p in pairs) - tp
        assert r.precision == pytest.approx(tp / (tp + fp) if tp + fp else 0)
        assert r.recall == pytest.approx(tp / (tp + fn)) and r.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_best_threshold_is_the_first_maximum(spark):
    sweep = evaluation.threshold_sweep(frame(spark, [(1, .8), (0, .2)]))
    assert evaluation.best_threshold(sweep).first().threshold == 0.21


def test_selection_score_picks_the_known_winner(spark):
    """The four published test rows: logistic regression wins by the formula."""
    rows = [("Logistic Regression", .8743, .6164, .8425), ("Decision Tree", .8743, .5860, .8274),
            ("Random Forest", .8342, .6172, .8468), ("Gradient Boosting", .8396, .6079, .8465)]
    table = spark.createDataFrame(rows, "model string, recall double, f1 double, roc_auc double")
    scored = {r.model: r for r in evaluation.selection_score(table).collect()}
    assert [m for m, r in scored.items() if r.is_best] == ["Logistic Regression"]
    assert [round(scored[m].selection_score, 4) for m, *_ in rows] == [.81, .7979, .7958, .796]


def test_min_rank_with_ties(spark):
    df = spark.createDataFrame([("a", .9), ("b", .5), ("c", .5), ("d", .1), ("e", None)], "customerID string, ChurnProbability double")
    got = {r.customerID: r.PriorityRank for r in ranking.priority_rank(df).collect()}
    assert got == {"a": 1, "b": 2, "c": 2, "d": 4, "e": None}


def test_predictions_on_the_thresholds(spark):
    columns = "customerID string, Churn int, p double, MonthlyCharges double, TotalCharges double, tenure int"
    rows = [("a", 1, .7, 50.0, 100.125, 40), ("b", 0, .4, 20.0, 10.0, 6), ("c", 1, .39999, 30.0, 0.0, 0),
            ("d", 0, .0001, 125.0, 9.0, 80), ("e", None, .995, 10.0, 1.0, 36)]
    got = {r.customerID: r for r in scoring.build_predictions(spark.createDataFrame(rows, columns)).collect()}
    assert [got[k].RiskCategory for k in "abcd"] == [TIERS[0], TIERS[1], TIERS[2], TIERS[2]]
    assert [got[k].PredictedChurn for k in "abcde"] == [1, 1, 0, 0, 1]
    assert [got[k].RevenueAtRisk for k in "abcde"] == [50.0, 20.0, 0.0, 0.0, 10.0]
    assert [got[k].EstimatedCLVAtRisk for k in "abcde"] == [0.0, 600.0, 0.0, 0.0, 0.0]
    assert [got[k].RiskScore for k in "abcde"] == [70, 40, 40, 1, 100]
    assert got["c"].ChurnProbability == 0.4 and got["b"].PriorityRank == got["c"].PriorityRank == 3
    assert got["a"].CLV == 100.12 and got["d"].ChargesBand == "nan"
    assert got["e"].ActualChurnLabel is None and got["a"].IsCorrectPrediction == 1 and got["b"].IsCorrectPrediction == 0
    unlabelled = scoring.build_predictions(spark.createDataFrame(rows, columns), actual=None).collect()
    assert {(r.ActualChurn, r.ActualChurnLabel, r.IsCorrectPrediction) for r in unlabelled} == {(None, "Unknown", None)}


def test_reports_on_an_empty_tier(spark):
    columns = "customerID string, Churn int, p double, MonthlyCharges double, TotalCharges double, tenure int"
    predictions = scoring.build_predictions(spark.createDataFrame([("a", 0, .1, 5.0, 5.0, 1)], columns))
    assert scoring.high_risk_stats(predictions).first().customers == 0
    assert scoring.revenue_by_tier(predictions).count() == 0
    assert scoring.kpi_measures(predictions.where("false")).first().predicted_churn_rate is None
    assert scoring.revenue_impact(predictions).first().high_risk_monthly == 0.0
