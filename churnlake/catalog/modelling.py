"""Registered queries: splits, scaling, training, evaluation and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake import spec as S
from churnlake.catalog.relations import Tables, query
from churnlake.catalog.sql import TIER, big, emean, over, pct, r, ratio
from churnlake.functions.bands import risk_tier
from churnlake.operators import evaluation, ranking, scaling, scoring, splitting
from churnlake.plans.scoring import Artefacts, score_customers
from churnlake.session import scratch_path
from churnlake.sources import sinks, tables
from churnlake.training import crossval, models

# ---- splits and scaling ----


@query("spl_1_split", over("split", "SELECT customerID, Churn, split FROM split"), staged=True)
def _(t: Tables):
    return t.split.select("customerID", "Churn", "split")


@query("spl_2_split_report", over("split", f"""SELECT split, {big("count(*)")} AS n_rows, {big("sum(Churn)")} AS churned,
  round_even(CAST(sum(Churn) AS DOUBLE) / count(Churn) * 100.0 * 10, 0) / 10 AS churn_pct FROM split GROUP BY split"""), staged=True)
def _(t: Tables):
    return splitting.split_report(t.split)


@query("spl_3_folds", over("split", "SELECT customerID, Churn, fold FROM split WHERE split = 'train'"), staged=True)
def _(t: Tables):
    return t.split.where(F.col("split") == "train").select("customerID", "Churn", "fold")


def _train(t: Tables) -> DataFrame:
    return t.split.where(F.col("split") == "train")


def _scale_sql(c: str) -> str:
    return f"CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1.0 END"


_PARAMS = "par AS MATERIALIZED (SELECT " + ", ".join(
    f"{emean(c)} AS m_{c}, {_scale_sql(c)} AS s_{c}" for c in S.SCALED) + " FROM split WHERE split = 'train')"


def _params_sql(digits: int) -> str:
    return over("split", " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'm_{c}', digits)} AS mean, {r(f's_{c}', digits)} AS scale FROM par" for c in S.SCALED),
        _PARAMS)


def _rounded(df: DataFrame, columns, digits: int) -> DataFrame:
    return df.withColumns({c: F.rint(F.col(c) * 10.0 ** digits) / 10.0 ** digits + F.lit(0.0) for c in columns})


@query("scl_1_fit", _params_sql(6), staged=True)
def _(t: Tables):
    return _rounded(scaling.fit_scaler(_train(t)), ["mean", "scale"], 6)


@query("scl_2_apply", over("split", "SELECT customerID, split, " + ", ".join(
    f"{r(f'({c} - m_{c}) / s_{c}', 6)} AS {c}" for c in S.SCALED) + " FROM split, par", _PARAMS), staged=True)
def _(t: Tables):
    scaled = scaling.apply_scaler(t.split, scaling.fit_scaler(_train(t)))
    return _rounded(scaled.select("customerID", "split", *S.SCALED), S.SCALED, 6)


@query("scl_3_report", _params_sql(2), staged=True)
def _(t: Tables):
    return _rounded(scaling.fit_scaler(_train(t)), ["mean", "scale"], 2)


@query("ml_1_class_weights", over("split", f"""SELECT customerID, Churn, {r("CAST(n AS DOUBLE) / (2.0 * n_class)", 6)} AS weight
FROM (SELECT customerID, Churn, count(*) OVER () AS n, count(*) OVER (PARTITION BY Churn) AS n_class
      FROM split WHERE split = 'train')"""), staged=True)
def _(t: Tables):
    weighted = splitting.class_weights(_train(t)).select("customerID", "Churn", "weight")
    return _rounded(weighted, ["weight"], 6)


# ---- fitted models: rows-only, checked by property tests ----

TREE_MODELS = ("Decision Tree", "Random Forest", "Gradient Boosting")


class Prepared:
    """Split table kept for the passes of a fit, its scaler, and the scaled table."""

    def __init__(self, t: Tables):
        self.t, self.names = t, t.feature_names
        self.split = t.split.persist()
        self.train = self.split.where(F.col("split") == "train")
        self.parameters = scaling.fit_scaler(self.train)
        self.scaled = scaling.apply_scaler(self.split, self.parameters)
        self.weighted = models.balanced(self.scaled.where(F.col("split") == "train"))

    def fit(self, name: str):
        return models.fit(name, self.weighted, self.names)

    def fit_all(self, names=models.MODEL_NAMES) -> dict:
        return models.fit_all(names, self.weighted, self.names)

    def test_metrics(self, fitted: dict) -> DataFrame:
        """Metrics per model from scores that are written first: the evaluation passes over them more than once."""
        test = self.scaled.where(F.col("split") == "test")
        parts = [models.score(m, test).select(F.lit(n).alias("model"), "Churn", "p") for n, m in fitted.items()]
        return evaluation.evaluate(_written(self.t, reduce(DataFrame.unionByName, parts), "test_scores"), by=["model"])


def _written(t: Tables, df: DataFrame, name: str) -> DataFrame:
    """A table that several passes read: write it to the shared folder and read it back."""
    path = scratch_path(t.spark, name)
    sinks.write_table(df, path)
    return tables.read_table(t.spark, path)


def _cross_validation(t: Tables, ready: Prepared) -> DataFrame:
    """Mean fold metrics of every model."""
    scores = crossval.fold_scores(ready.train, models.MODEL_NAMES, ready.names)
    return crossval.cross_validate(_written(t, scores, "fold_scores"))


def _fit_and_score(t: Tables, name: str) -> DataFrame:
    ready = Prepared(t)
    return models.score(ready.fit(name), ready.scaled).select("customerID", "Churn", "split", "p")


@query("ml_2_logistic_regression", staged=True)
def _(t: Tables):
    return _fit_and_score(t, "Logistic Regression")


@query("ml_3_decision_tree", staged=True)
def _(t: Tables):
    return _fit_and_score(t, "Decision Tree")


@query("ml_4_random_forest", staged=True)
def _(t: Tables):
    return _fit_and_score(t, "Random Forest")


@query("ml_5_gradient_boosting", staged=True)
def _(t: Tables):
    return _fit_and_score(t, "Gradient Boosting")


@query("ml_6_cross_validation", staged=True)
def _(t: Tables):
    return _cross_validation(t, Prepared(t))


@query("ml_7_final_fit", staged=True)
def _(t: Tables):
    ready = Prepared(t)
    return ready.test_metrics(ready.fit_all())


@query("ml_8_feature_importances", staged=True)
def _(t: Tables):
    """Importances of every tree model."""
    ready = Prepared(t)
    tables = [models.feature_importances(t.spark, m, ready.names).withColumn("model", F.lit(n))
              for n, m in ready.fit_all(TREE_MODELS).items()]
    return reduce(DataFrame.unionByName, tables)


@query("ml_9_tree_rules", staged=True)
def _(t: Tables):
    ready = Prepared(t)
    return models.tree_rules(t.spark, ready.fit("Decision Tree"), ready.names)


@query("ml_10_reload_parity", staged=True)
def _(t: Tables):
    ready = Prepared(t)
    model = ready.fit("Decision Tree")
    path = scratch_path(t.spark, "model")
    models.save(model, path)
    return models.reload_difference(models.score(model, ready.scaled), models.score(models.load(path), ready.scaled))


@query("ml_11_fixed_scorer", over("scored", "SELECT customerID, Churn, p FROM scored"))
def _(t: Tables):
    return t.scored.select("customerID", "Churn", "p")


@query("src_4_artefacts", staged=True)
def _(t: Tables):
    """Model and scaler are written, loaded again and applied to all customers."""
    ready = Prepared(t)
    path = scratch_path(t.spark, "artefacts")
    models.save(ready.fit("Logistic Regression"), f"{path}/model")
    sinks.write_table(ready.parameters, f"{path}/scaler")
    loaded = tables.read_table(t.spark, f"{path}/scaler")
    return models.score(models.load(f"{path}/model"), scaling.apply_scaler(ready.split, loaded)).select("customerID", "p")


@query("snk_5_models_and_report", staged=True)
def _(t: Tables):
    ready = Prepared(t)
    path = scratch_path(t.spark, "models")
    fitted = ready.fit_all()
    for name, model in fitted.items():
        models.save(model, f"{path}/{name.lower().replace(' ', '_')}")
    sinks.write_table(evaluation.selection_score(ready.test_metrics(fitted)), f"{path}/comparison")
    return tables.read_table(t.spark, f"{path}/comparison")


@query("evl_8_comparison_report", staged=True)
def _(t: Tables):
    ready = Prepared(t)
    test = ready.test_metrics(ready.fit_all())
    return evaluation.comparison_report(test, _cross_validation(t, ready))


# ---- evaluation over scorers with given coefficients ----

_CELLS = {
    "tp": "count(*) FILTER (WHERE Churn = 1 AND p >= 0.4)", "fp": "count(*) FILTER (WHERE Churn = 0 AND p >= 0.4)",
    "fn": "count(*) FILTER (WHERE Churn = 1 AND p < 0.4)", "tn": "count(*) FILTER (WHERE Churn = 0 AND p < 0.4)"}
_RATES = {
    "accuracy": ratio("tp + tn", "tp + fp + fn + tn"), "precision": ratio("tp", "tp + fp"),
    "recall": ratio("tp", "tp + fn"), "f1": ratio("2 * tp", "2 * tp + fp + fn")}
_METRICS = ", ".join(f'{r(x, 4)} AS "{n}"' for n, x in _RATES.items())
_CONF = "conf AS (SELECT model, " + ", ".join(f"{big(x)} AS {n}" for n, x in _CELLS.items()) + " FROM scored_models GROUP BY model)"
_AUC = f"""sc AS (
  SELECT model, p, count(*) FILTER (WHERE Churn = 1) AS pos, count(*) FILTER (WHERE Churn = 0) AS neg
  FROM scored_models GROUP BY model, p),
st AS (
  SELECT *, sum(pos) OVER w - pos AS pos_above, sum(neg) OVER w - neg AS neg_above,
    sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn
  FROM sc WINDOW w AS (PARTITION BY model ORDER BY p DESC)),
auc AS (
  SELECT model, {r("CAST(sum(neg * (2 * pos_above + pos)) AS DOUBLE) / (2.0 * CAST(max(np) AS DOUBLE) * CAST(max(nn) AS DOUBLE))", 4)}
    AS roc_auc FROM st GROUP BY model)"""


@query("evl_1_threshold_metrics", over("scored", f"SELECT model, {_METRICS} FROM conf", _CONF))
def _(t: Tables):
    return evaluation.threshold_metrics(t.scored_by_model, by=["model"])


@query("evl_2_roc_auc", over("scored", "SELECT model, roc_auc FROM auc", _AUC), staged=True)
def _(t: Tables):
    return evaluation.roc_auc(t.scored_by_model, by=["model"])


@query("evl_3_confusion", over("scored", " UNION ALL ".join(
    f"SELECT model, CAST({a} AS INTEGER) AS actual, CAST({p} AS INTEGER) AS predicted, {n} AS n, {pct(n, whole)} AS row_pct FROM conf"
    for a, p, n, whole in ((0, 0, "tn", "tn + fp"), (0, 1, "fp", "tn + fp"), (1, 0, "fn", "fn + tp"), (1, 1, "tp", "fn + tp"))),
    _CONF))
def _(t: Tables):
    return evaluation.confusion_cells(t.scored_by_model, by=["model"])


@query("evl_4_roc_curve", over("scored", f"""SELECT model, p AS threshold,
  {r("CAST(neg_above + neg AS DOUBLE) / nn", 6)} AS fpr, {r("CAST(pos_above + pos AS DOUBLE) / np", 6)} AS tpr FROM st""", _AUC), staged=True)
def _(t: Tables):
    return evaluation.roc_curve(t.scored_by_model, by=["model"])


_SWEEP = f"""grid AS (SELECT k / 100e0 AS threshold FROM range(10, 91) t(k)),
swc AS (
  SELECT threshold, count(*) FILTER (WHERE Churn = 1 AND p >= threshold) AS tp,
    count(*) FILTER (WHERE Churn = 0 AND p >= threshold) AS fp, count(*) FILTER (WHERE Churn = 1 AND p < threshold) AS fn
  FROM scored, grid GROUP BY threshold),
sweep AS (
  SELECT threshold, {r(_RATES["precision"], 6)} AS "precision", {r(_RATES["recall"], 6)} AS recall, {r(_RATES["f1"], 6)} AS f1 FROM swc)"""


@query("evl_5_threshold_sweep", over("scored", "SELECT * FROM sweep", _SWEEP))
def _(t: Tables):
    return evaluation.threshold_sweep(t.scored)


@query("evl_6_best_threshold", over("scored", "SELECT * FROM sweep ORDER BY f1 DESC, threshold LIMIT 1", _SWEEP))
def _(t: Tables):
    return evaluation.best_threshold(evaluation.threshold_sweep(t.scored))


@query("evl_7_model_choice", over("scored", f"""SELECT *, row_number() OVER (ORDER BY selection_score DESC, model) = 1 AS is_best FROM (
  SELECT model, "accuracy", "precision", recall, f1, roc_auc,
    {r("CAST(0.0 AS DOUBLE) + CAST(0.4 AS DOUBLE) * roc_auc + CAST(0.4 AS DOUBLE) * recall + CAST(0.2 AS DOUBLE) * f1", 6)} AS selection_score
  FROM (SELECT model, {_METRICS} FROM conf) JOIN auc USING (model))""", _CONF, _AUC), staged=True)
def _(t: Tables):
    return evaluation.selection_score(evaluation.evaluate(t.scored_by_model, by=["model"]))


def _class_lines() -> str:
    a = (ratio("tn", "tn + fn"), ratio("tn", "tn + fp"), ratio("2 * tn", "2 * tn + fn + fp"), "tn + fp")
    b = (ratio("tp", "tp + fp"), ratio("tp", "tp + fn"), ratio("2 * tp", "2 * tp + fp + fn"), "tp + fn")
    acc, n = ratio("tp + tn", "tp + fp + fn + tn"), "tp + fp + fn + tn"
    wa, wb = ratio("tn + fp", n), ratio("tp + fn", n)
    lines = [("No Churn", *a), ("Churned", *b), ("accuracy", acc, acc, acc, n),
             ("macro avg", *[f"CAST(0.5 AS DOUBLE) * {x} + CAST(0.5 AS DOUBLE) * {y}" for x, y in zip(a[:3], b[:3])], n),
             ("weighted avg", *[f"{wa} * {x} + {wb} * {y}" for x, y in zip(a[:3], b[:3])], n)]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS name, {r(p, 4)} AS \"precision\", {r(q, 4)} AS recall, {r(f, 4)} AS f1, {big(s)} AS support "
        "FROM conf WHERE model = 'alpha'" for name, p, q, f, s in lines)


@query("evl_9_class_report", over("scored", _class_lines(), _CONF))
def _(t: Tables):
    return evaluation.class_report(t.scored)


@query("evl_10_naive_baseline", over("split", f"""SELECT {r("CAST(count(*) FILTER (WHERE Churn = 0) AS DOUBLE) / count(Churn)", 6)} AS accuracy,
  CAST(0 AS DOUBLE) AS recall FROM split WHERE split = 'test'"""), staged=True)
def _(t: Tables):
    return evaluation.naive_baseline(t.split.where(F.col("split") == "test"))


@query("evl_11_exported_auc", over("predictions", "SELECT roc_auc FROM auc", _AUC.replace(
    "SELECT model, p,", "SELECT 'all' AS model, ChurnProbability AS p,").replace("Churn = ", "ActualChurn = ").replace(
    "FROM scored_models GROUP BY model, p", "FROM predictions GROUP BY ChurnProbability")), staged=True)
def _(t: Tables):
    return evaluation.roc_auc(t.predictions, "ChurnProbability", "ActualChurn")


# ---- scoring ----

@query("prd_1_fitted_probability", staged=True)
def _(t: Tables):
    """Every customer scored by a model fitted on the training rows, as the full prediction table."""
    ready = Prepared(t)
    artefacts = Artefacts(ready.fit("Logistic Regression"), "Logistic Regression", ready.names, ready.parameters)
    return scoring.build_predictions(score_customers(t.clean, artefacts))


def _prediction(name: str, columns: list[str], extra_sql: str = ""):
    shown = ", ".join(columns)

    @query(name, over("predictions", f"SELECT customerID, {shown} FROM predictions{extra_sql}"))
    def _(t: Tables):
        return t.predictions.select("customerID", *columns)


_prediction("prd_2_predicted_label", ["PredictedChurn", "PredictedChurnLabel"])
_prediction("prd_3_rounded_probability", ["ChurnProbability", "ChurnProbabilityPct"])


@query("prd_4_tier", over("scored", f"SELECT customerID, p, {TIER} AS RiskCategory FROM scored"))
def _(t: Tables):
    return t.scored.selectExpr("customerID", "p", f"{risk_tier('p')} AS RiskCategory")


_prediction("prd_5_risk_score", ["RiskScore"])
_prediction("prd_6_revenue_at_risk", ["RevenueAtRisk"])
_prediction("prd_7_clv", ["CLV"])
_prediction("prd_8_clv_at_risk", ["EstimatedCLVAtRisk"])


@query("prd_9_priority_rank", over(
    "scored", f"""SELECT customerID, ChurnProbability, {big("rank() OVER (ORDER BY ChurnProbability DESC)")} AS PriorityRank
FROM (SELECT customerID, {r("p", 4)} AS ChurnProbability FROM scored)"""), staged=True)
def _(t: Tables):
    rounded = t.scored.select("customerID", (F.rint(F.col("p") * 1e4) / 1e4).alias("ChurnProbability"))
    return ranking.priority_rank(rounded)


_prediction("prd_10_correctness", ["ActualChurn", "ActualChurnLabel", "IsCorrectPrediction"])


@query("prd_10_unlabelled", over("predictions", """SELECT customerID, CAST(NULL AS INTEGER) AS ActualChurn, 'Unknown' AS ActualChurnLabel,
  CAST(NULL AS INTEGER) AS IsCorrectPrediction FROM predictions"""))
def _(t: Tables):
    unlabelled = scoring.build_predictions(t.scored.drop("Churn", "ChurnLabel"), actual=None)
    return unlabelled.select("customerID", "ActualChurn", "ActualChurnLabel", "IsCorrectPrediction")


_prediction("prd_11_context", [*S.PREDICTION_CONTEXT, "TenureGroup", "ChargesBand"])


@query("prd_12_sorted_predictions", over("predictions", "SELECT * FROM predictions ORDER BY ChurnProbability DESC, customerID"), staged=True)
def _(t: Tables):
    return scoring.by_priority(t.predictions)


@query("prd_13_high_risk_list", over("predictions", "SELECT * FROM predictions WHERE RiskCategory = 'High Risk'"), staged=True)
def _(t: Tables):
    return scoring.tier_list(t.predictions, S.TIERS[0])


@query("prd_13_medium_risk_list", over("predictions", "SELECT * FROM predictions WHERE RiskCategory = 'Medium Risk'"), staged=True)
def _(t: Tables):
    return scoring.tier_list(t.predictions, S.TIERS[1])


def _top(name: str, k: int, columns: list[str], tier: str | None = None):
    where = f" WHERE RiskCategory = '{tier}'" if tier else ""

    @query(name, over("predictions", f"""SELECT {", ".join(columns)} FROM predictions{where}
ORDER BY ChurnProbability DESC, customerID LIMIT {k}"""))
    def _(t: Tables):
        rows = t.predictions if tier is None else t.predictions.where(F.col("RiskCategory") == tier)
        return scoring.top_customers(rows, k).select(*columns)


_top("prd_14_top_20", 20, ["customerID", "ChurnProbability", "RiskCategory"])
_top("prd_14_top_10", 10, ["customerID", "ActualChurnLabel", "PredictedChurnLabel", "ChurnProbabilityPct", "RiskCategory",
                           "RiskScore", "RevenueAtRisk", "Contract", "tenure"])
_top("prd_14_top_10_high_risk", 10, ["customerID", "ChurnProbabilityPct", "MonthlyCharges", "Contract", "tenure", "PaymentMethod"],
     "High Risk")
_top("prd_14_top_5", 5, ["customerID", "ChurnProbabilityPct", "RiskCategory", "MonthlyCharges", "Contract"])


@query("prd_15_prediction_stats", over("scored", f"""SELECT {big("count(*) FILTER (WHERE p >= 0.4)")} AS predicted_churners,
  {pct("count(*) FILTER (WHERE p >= 0.4)", "count(*)")} AS predicted_pct, {r("min(p)", 6)} AS min_p,
  {r(emean("p", 10), 6)} AS mean_p, {r("max(p)", 6)} AS max_p FROM scored"""))
def _(t: Tables):
    return scoring.prediction_stats(t.scored)


