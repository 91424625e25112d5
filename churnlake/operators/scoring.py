"""From a probability column to the table a retention team works with."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake import spec as S
from churnlake.functions.bands import charges_band, risk_tier, tenure_group, tier_order
from churnlake.functions.numbers import exact_mean, exact_sum, percent, round_even
from churnlake.functions.text import literal, mapped, quoted, rounded
from churnlake.operators.ranking import priority_rank


def logistic_score(coefficients: Mapping[str, float], intercept: float, digits: int | None = None) -> str:
    """Probability of a logistic model with given coefficients, as a column expression."""
    z = literal(float(intercept))
    for name, weight in coefficients.items():
        z = f"({z} + {literal(float(weight))} * {quoted(name)})"
    p = f"1.0D / (1.0D + exp(-({z})))"
    return p if digits is None else rounded(p, digits)


def build_predictions(
    df: DataFrame, probability: str = "p", actual: str | None = "Churn", threshold: float = S.THRESHOLD,
    high: float = S.HIGH_CUTOFF, medium: float = S.MEDIUM_CUTOFF, lifetime: int = S.EXPECTED_LIFETIME_MONTHS,
    outside: str = S.OUT_OF_RANGE_LABEL,
) -> DataFrame:
    """The 33 prediction columns. Customer attributes stay on their row, so no join brings them back; the
    only exchange is the count per rounded probability behind the rank."""
    p = quoted(probability)
    hit = f"{p} >= {literal(threshold)}"
    known = actual is not None
    yes_no = {1: "Yes", 0: "No"}
    columns = {
        "customerID": "customerID",
        "ActualChurn": f"CAST({quoted(actual)} AS INT)" if known else "CAST(NULL AS INT)",
        "ActualChurnLabel": mapped(actual, yes_no) if known else "'Unknown'",
        "PredictedChurn": f"CASE WHEN {hit} THEN 1 ELSE 0 END",
        "PredictedChurnLabel": f"CASE WHEN {hit} THEN 'Yes' ELSE 'No' END",
        "ChurnProbability": rounded(p, 4),
        "ChurnProbabilityPct": rounded(f"{p} * 100.0D", 2),
        "RiskCategory": risk_tier(p, high, medium),
        "RiskScore": f"greatest(1, least(100, CAST(rint({p} * 100.0D) AS INT)))",
        "MonthlyCharges": "MonthlyCharges",
        "TotalCharges": "TotalCharges",
        "tenure": "tenure",
        "RevenueAtRisk": f"CASE WHEN {hit} THEN MonthlyCharges ELSE 0.0D END",
        "CLV": rounded("TotalCharges", 2),
        "EstimatedCLVAtRisk":
            f"CASE WHEN {hit} THEN {rounded(f'MonthlyCharges * greatest(0, {lifetime} - tenure)', 2)} ELSE 0.0D END",
    }
    context = [c for c in S.PREDICTION_CONTEXT if c in df.columns]
    rows = df.selectExpr(
        *[f"{e} AS {n}" for n, e in columns.items()], *context,
        f"{tenure_group(outside)} AS TenureGroup", f"{charges_band(outside)} AS ChargesBand")
    correct = "CASE WHEN PredictedChurn = ActualChurn THEN 1 ELSE 0 END" if known else "CAST(NULL AS INT)"
    return priority_rank(rows).selectExpr(
        *columns, "PriorityRank", f"{correct} AS IsCorrectPrediction", *context, "TenureGroup", "ChargesBand")


def by_priority(predictions: DataFrame) -> DataFrame:
    """Highest probability first; the key makes the order total. Spark sorts it by range partitions."""
    return predictions.orderBy(F.col("ChurnProbability").desc(), "customerID")


def tier_list(predictions: DataFrame, tier: str) -> DataFrame:
    """Call list of one tier; over a table written by tier this reads one folder."""
    return by_priority(predictions.where(F.col("RiskCategory") == tier))


def top_customers(predictions: DataFrame, k: int) -> DataFrame:
    """The ``k`` customers at highest risk: each task keeps its own best ``k``."""
    return by_priority(predictions).limit(k)


def prediction_stats(scored: DataFrame, probability: str = "p", threshold: float = S.THRESHOLD) -> DataFrame:
    """How many are predicted to churn, and the range of the probabilities."""
    p = F.col(probability)
    hits = F.count_if(p >= F.lit(threshold))
    return scored.agg(
        hits.alias("predicted_churners"), percent(hits, F.count(F.lit(1))).alias("predicted_pct"),
        round_even(F.min(p), 6).alias("min_p"), round_even(exact_mean(p, 10), 6).alias("mean_p"),
        round_even(F.max(p), 6).alias("max_p"))


def tier_counts(predictions: DataFrame) -> DataFrame:
    """Customers per tier with their share, in the fixed tier order; empty tiers do not appear."""
    counts = predictions.groupBy("RiskCategory").agg(F.count(F.lit(1)).alias("customers"))
    total = counts.agg(F.sum("customers")).scalar()
    return counts.select(
        F.expr(tier_order("RiskCategory")).alias("tier"), "RiskCategory", "customers",
        percent(F.col("customers"), total).alias("pct")).orderBy("tier")


def revenue_by_tier(predictions: DataFrame) -> DataFrame:
    """Revenue at risk of predicted churners per tier: sum, mean and count."""
    revenue = F.col("RevenueAtRisk")
    return predictions.where(F.col("PredictedChurn") == 1).groupBy("RiskCategory").agg(
        round_even(exact_sum(revenue), 2).alias("revenue_sum"),
        round_even(exact_mean(revenue), 2).alias("revenue_mean"),
        F.count(revenue).alias("customers"))


def tier_summary(predictions: DataFrame) -> DataFrame:
    """Size, mean probability, charge and tenure, revenue at risk and actual churn rate per tier."""
    def mean(c):
        return round_even(exact_mean(F.col(c)), 2)

    return predictions.groupBy("RiskCategory").agg(
        F.count("customerID").alias("Customers"), mean("ChurnProbabilityPct").alias("AvgProbability"),
        mean("MonthlyCharges").alias("AvgMonthlyCharge"), mean("tenure").alias("AvgTenure"),
        round_even(exact_sum(F.col("RevenueAtRisk")), 2).alias("TotalRevAtRisk"),
        mean("ActualChurn").alias("ActualChurnRate"))


def kpi_measures(predictions: DataFrame) -> DataFrame:
    """Dashboard measures; the rate is null rather than an error on an empty table."""
    return predictions.agg(
        F.count("customerID").alias("total_customers"),
        round_even(exact_sum(F.col("RevenueAtRisk")), 2).alias("revenue_at_risk"),
        round_even(exact_mean(F.col("ChurnProbability")), 6).alias("avg_probability"),
        F.sum("PredictedChurn").alias("predicted_churners"),
        F.count_if(F.col("RiskCategory") == S.TIERS[0]).alias("high_risk_count"),
        round_even(F.try_divide(F.sum("PredictedChurn"), F.count("customerID")), 6).alias("predicted_churn_rate"))


def run_summary(predictions: DataFrame) -> DataFrame:
    """The figures of the closing summary of a scoring run."""
    n = F.count(F.lit(1))
    monthly = exact_sum(F.col("RevenueAtRisk"))
    tiers = {"high": S.TIERS[0], "medium": S.TIERS[1], "low": S.TIERS[2]}
    hits = {k: F.count_if(F.col("RiskCategory") == t) for k, t in tiers.items()}
    known = F.count("ActualChurn") == n
    return predictions.agg(
        n.alias("scored"), F.sum("PredictedChurn").alias("predicted"),
        percent(F.sum("PredictedChurn"), n, 1).alias("predicted_pct"),
        F.when(known, F.sum("ActualChurn")).alias("actual"),
        F.when(known, percent(F.sum("ActualChurn"), n, 1)).alias("actual_pct"),
        *[h.alias(k) for k, h in hits.items()], *[percent(h, n, 1).alias(f"{k}_pct") for k, h in hits.items()],
        round_even(monthly, 2).alias("monthly_revenue_at_risk"),
        round_even(monthly * 12, 2).alias("annual_revenue_at_risk"))


def revenue_impact(predictions: DataFrame, retained: float = 0.30) -> DataFrame:
    """Revenue at risk per month and year, its high-risk part, and the yearly value of retaining a share."""
    revenue = F.col("RevenueAtRisk")
    high = F.when(F.col("RiskCategory") == S.TIERS[0], revenue)
    facts = predictions.agg(
        F.sum("PredictedChurn").alias("predicted_churners"), exact_sum(revenue).alias("monthly"),
        F.coalesce(exact_sum(high), F.lit(0.0)).alias("high"))
    return facts.select(
        "predicted_churners", round_even(F.col("monthly"), 2).alias("monthly_at_risk"),
        round_even(F.col("monthly") * 12, 2).alias("annual_at_risk"),
        round_even(F.col("high"), 2).alias("high_risk_monthly"),
        round_even(F.col("monthly") * F.lit(retained) * 12, 2).alias("annual_saved"))


def high_risk_stats(predictions: DataFrame) -> DataFrame:
    """Size, mean probability and revenue of the high-risk list."""
    return predictions.where(F.col("RiskCategory") == S.TIERS[0]).agg(
        F.count(F.lit(1)).alias("customers"),
        round_even(exact_mean(F.col("ChurnProbabilityPct")), 1).alias("avg_probability_pct"),
        round_even(F.coalesce(exact_sum(F.col("RevenueAtRisk")), F.lit(0.0)), 2).alias("revenue_at_risk"))


def campaign_value(
    counts: DataFrame, customer_value: Column, success: float = 0.30, contact_cost: float = 25.0,
) -> DataFrame:
    """Worth of contacting everyone predicted to churn, from a confusion table with one row."""
    saved = F.col("tp") * F.col("clv") * F.lit(success)
    wasted = F.col("fp") * F.lit(contact_cost)
    return counts.withColumn("clv", customer_value).select(
        "tp", "fn", "fp", "tn", round_even(F.col("clv"), 2).alias("clv_per_churner"),
        round_even(saved, 2).alias("revenue_saved"), round_even(wasted, 2).alias("contact_cost"),
        round_even(saved - wasted, 2).alias("net_value"))
