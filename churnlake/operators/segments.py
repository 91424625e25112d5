"""Target rates by segment. All segments of a report come from one grouped pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake import spec as S
from churnlake.functions.numbers import exact_mean, exact_sum, percent, round_even


def churn_rate_table(df: DataFrame, column: str, target: str = "Churn", keep_null: bool = False) -> DataFrame:
    """Total, Churned and ChurnRate per value of ``column``, highest rate first; null keys are left out."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    return (
        rows.groupBy(column)
        .agg(F.count(target).alias("Total"), F.sum(target).alias("Churned"))
        .withColumn("ChurnRate", percent(F.col("Churned"), F.col("Total")))
        .orderBy(F.col("ChurnRate").desc(), column)
    )


def crosstab(df: DataFrame, column: str, target: str = "Churn") -> DataFrame:
    """Rows per value of ``column`` and target class, 0 where there are none."""
    return (
        df.where(F.col(column).isNotNull() & F.col(target).isNotNull())
        .groupBy(column)
        .agg(F.count_if(F.col(target) == 0).alias("NoChurn"), F.count_if(F.col(target) == 1).alias("Churned"))
    )


def segment_report(df: DataFrame, columns: Sequence[str] = S.SEGMENTS, target: str = "Churn") -> DataFrame:
    """Rate table and crosstab for many columns at once: (feature, value, Total, Churned, NoChurn, ChurnRate).

    The columns are turned into rows inside the scan stage and summed there, so what is shuffled is one row
    per task and segment value.
    """
    present = [c for c in columns if c in df.columns]
    return (
        df.select(target, *[F.col(c).cast("string").alias(c) for c in present])
        .unpivot([target], present, "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(
            F.count(target).alias("Total"),
            F.count_if(F.col(target) == 1).alias("Churned"),
            F.count_if(F.col(target) == 0).alias("NoChurn"),
        )
        .withColumn("ChurnRate", percent(F.col("Churned"), F.col("Total")))
    )


def flag_above_average(df: DataFrame, columns: Sequence[str] = S.FOCUS_SEGMENTS, target: str = "Churn") -> DataFrame:
    """Segment report with the measured overall rate and whether the segment lies above it."""
    overall = df.agg(percent(F.sum(target), F.count(target))).scalar()
    return segment_report(df, columns, target).select(
        "feature", "value", "ChurnRate", overall.alias("OverallRate"),
        (F.col("ChurnRate") > overall).alias("AboveAverage"))


# Measure name -> (segment column, operator, value) of the conditional churn rates.
RATE_MEASURES = {
    "mtm_churn": ("Contract", "=", "Month-to-month"),
    "twoyear_churn": ("Contract", "=", "Two year"),
    "echeck_churn": ("PaymentMethod", "=", "Electronic check"),
    "fiber_churn": ("InternetService", "=", "Fiber optic"),
    "dsl_churn": ("InternetService", "=", "DSL"),
    "senior_churn": ("SeniorCitizenLabel", "=", "Yes"),
    "no_partner_churn": ("Partner", "=", "No"),
    "no_dependents_churn": ("Dependents", "=", "No"),
    "paperless_churn": ("PaperlessBilling", "=", "Yes"),
    "early_churn": ("tenure", "<=", 12),
    "late_churn": ("tenure", ">", 48),
    "no_security_churn": ("OnlineSecurity", "=", "No"),
    "has_security_churn": ("OnlineSecurity", "=", "Yes"),
}


def _condition(rule):
    column, operator, value = rule
    c = F.col(column)
    return {"=": c == value, "<=": c <= value, ">": c > value}[operator]


def _rate(condition, target):
    return F.try_divide(F.sum(F.when(condition, F.col(target))), F.count(F.when(condition, F.col(target)))) * 100.0


def key_measures(df: DataFrame, target: str = "Churn", internet_only_security: bool = False) -> DataFrame:
    """The conditional rates and amounts behind the insight list: one row, one scan.

    ``internet_only_security`` leaves customers without internet out of the no-security rate.
    """
    churned, stayed = F.col(target) == 1, F.col(target) == 0
    charge, tenure = F.col("MonthlyCharges"), F.col("tenure")
    rates = {name: _condition(rule) for name, rule in RATE_MEASURES.items()}
    if internet_only_security:
        rates["no_security_churn"] = rates["no_security_churn"] & (F.col("InternetService") != "No")
    return df.agg(
        round_even(_rate(F.lit(True), target), 4).alias("churn_rate"),
        *[round_even(_rate(rule, target), 4).alias(name) for name, rule in rates.items()],
        round_even(exact_mean(F.when(churned, charge)), 4).alias("avg_charge_churned"),
        round_even(exact_mean(F.when(stayed, charge)), 4).alias("avg_charge_stayed"),
        round_even(exact_mean(F.when(churned, tenure)), 4).alias("avg_tenure_churned"),
        round_even(exact_mean(F.when(stayed, tenure)), 4).alias("avg_tenure_stayed"),
        F.coalesce(exact_sum(F.when(churned, charge)), F.lit(0.0)).alias("monthly_revenue_lost"),
    )


def business_kpis(df: DataFrame, target: str = "Churn") -> DataFrame:
    """Churn and retention rate, revenue lost, mean charge times mean tenure, and rule-based high-risk count."""
    churned = F.col(target) == 1
    high = (F.col("Contract") == "Month-to-month") & (F.col("tenure") <= 12)
    return df.agg(
        percent(F.sum(target), F.count(target)).alias("churn_rate"),
        percent(F.count_if(F.col(target) == 0), F.count(target)).alias("retention_rate"),
        F.coalesce(exact_sum(F.when(churned, F.col("MonthlyCharges"))), F.lit(0.0)).alias("revenue_lost"),
        round_even(exact_mean(F.col("MonthlyCharges")) * exact_mean(F.col("tenure")), 2).alias("clv"),
        F.count_if(high).alias("high_risk_count"),
    )


def impact_estimate(df: DataFrame, target: str = "Churn", saving: float = 0.10) -> DataFrame:
    """Expected yearly loss from measured size, mean charge and rate, and what a ``saving`` share is worth."""
    facts = df.agg(
        F.count(F.lit(1)).alias("customers"),
        round_even(exact_mean(F.col("MonthlyCharges")), 2).alias("avg_charge"),
        round_even(F.try_divide(F.sum(target), F.count(target)), 4).alias("churn_rate"),
    )
    lost = F.floor(F.col("customers") * F.col("churn_rate"))
    monthly = lost * F.col("avg_charge")
    return facts.select(
        "customers", "avg_charge", "churn_rate", lost.alias("churned_customers"),
        round_even(monthly, 2).alias("monthly_at_risk"),
        round_even(monthly * 12, 2).alias("annual_at_risk"),
        round_even(monthly * 12 * F.lit(saving), 2).alias("savings"),
    )
