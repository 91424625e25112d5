"""Registered queries: segments, features, encodings, revenue reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake import spec as S
from churnlake.catalog.quality import bi_sql
from churnlake.catalog.relations import Tables, query
from churnlake.catalog.sql import (
    ML_FEATURES, big, emean, esum, over, pct, r,
)
from churnlake.functions.numbers import exact_mean
from churnlake.operators import encoding, evaluation, features, insights, scoring, segments
from churnlake.spec import TELCO

# ---- segments ----


def _rate_sql(column: str, stage: str = "clean") -> str:
    table = "feat" if stage == "feat" else "clean"
    return over(stage, f"""SELECT {column}, {big("count(Churn)")} AS Total, {big("sum(Churn)")} AS Churned,
  {pct("sum(Churn)", "count(Churn)")} AS ChurnRate FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}""")


@query("seg_1_contract_churn", _rate_sql("Contract"))
def _(t: Tables):
    """Churn rate by contract: the flagship query."""
    return segments.churn_rate_table(t.clean, "Contract")


@query("seg_1_payment_churn", _rate_sql("PaymentMethod"))
def _(t: Tables):
    return segments.churn_rate_table(t.clean, "PaymentMethod")


@query("seg_2_crosstab", over("clean", f"""SELECT Contract, {big("count(*) FILTER (WHERE Churn = 0)")} AS NoChurn,
  {big("count(*) FILTER (WHERE Churn = 1)")} AS Churned FROM clean WHERE Contract IS NOT NULL GROUP BY Contract"""))
def _(t: Tables):
    return segments.crosstab(t.clean, "Contract")


def _report_sql(columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, {big("count(Churn)")} AS Total,
  {big("count(*) FILTER (WHERE Churn = 1)")} AS Churned, {big("count(*) FILTER (WHERE Churn = 0)")} AS NoChurn,
  {pct("sum(Churn)", "count(Churn)")} AS ChurnRate FROM clean WHERE {c} IS NOT NULL GROUP BY {c}""" for c in columns)


@query("seg_3_all_segments", over("clean", _report_sql(S.SEGMENTS)))
def _(t: Tables):
    return segments.segment_report(t.clean)


@query("seg_4_focus_segments", over("clean", _report_sql(S.FOCUS_SEGMENTS)))
def _(t: Tables):
    return segments.segment_report(t.clean, S.FOCUS_SEGMENTS)


@query("seg_5_above_average", over("clean", f"""SELECT feature, value, ChurnRate, overall.x AS OverallRate,
  ChurnRate > overall.x AS AboveAverage FROM ({_report_sql(S.FOCUS_SEGMENTS)}),
  (SELECT {pct("sum(Churn)", "count(Churn)")} AS x FROM clean) overall"""), staged=(*S.FOCUS_SEGMENTS, "Churn"))
def _(t: Tables):
    return segments.flag_above_average(t.clean)


def _cond(rule) -> str:
    column, op, value = rule
    return f"{column} {op} " + (f"'{value}'" if isinstance(value, str) else str(value))


def _rate(cond: str) -> str:
    return (f"(CAST(sum(Churn) FILTER (WHERE {cond}) AS DOUBLE) / nullif(count(Churn) FILTER (WHERE {cond}), 0)) * 100.0")


def _fmean(x: str, cond: str) -> str:
    return emean(f"CASE WHEN {cond} THEN {x} END")


MEASURES_SQL = f"""SELECT {r(_rate("true"), 4)} AS churn_rate,
  {", ".join(f"{r(_rate(_cond(rule)), 4)} AS {n}" for n, rule in segments.RATE_MEASURES.items())},
  {r(_fmean("MonthlyCharges", "Churn = 1"), 4)} AS avg_charge_churned,
  {r(_fmean("MonthlyCharges", "Churn = 0"), 4)} AS avg_charge_stayed,
  {r(_fmean("tenure", "Churn = 1"), 4)} AS avg_tenure_churned,
  {r(_fmean("tenure", "Churn = 0"), 4)} AS avg_tenure_stayed,
  coalesce({esum("CASE WHEN Churn = 1 THEN MonthlyCharges END")}, 0.0) AS monthly_revenue_lost"""


@query("seg_6_key_measures", over("clean", MEASURES_SQL + " FROM clean"))
def _(t: Tables):
    return segments.key_measures(t.clean)


def _insights_sql() -> str:
    extra = ", ".join(
        f"{r(_rate(f'{c} = {chr(39)}{v}{chr(39)}'), 4)} AS {n}" for n, (c, v) in insights.EXTRA_RATES.items())
    gaps = {
        "contract_gap": "mtm_churn - twoyear_churn", "fiber_gap": "fiber_churn - dsl_churn",
        "security_gap": "no_security_churn - has_security_churn", "gender_gap": "male_churn - female_churn",
        "charge_gap": "avg_charge_churned - avg_charge_stayed", "tenure_gap": "avg_tenure_churned - avg_tenure_stayed",
        "retained_rate": "100.0 - churn_rate", "monthly_revenue_lost_0": "monthly_revenue_lost",
        "annual_revenue_lost_0": "monthly_revenue_lost * 12", "total_r2": "total_r * total_r", "monthly_r2": "monthly_r * monthly_r",
        **{f"{n}_gap": f"{n}_churn - churn_rate" for n in (
            "echeck", "early", "late", "senior", "no_partner", "no_dependents", "paperless", "no_phone")},
    }
    wide = f"""m0 AS ({MEASURES_SQL}, {extra},
  {r("corr(TotalCharges, CAST(Churn AS DOUBLE))", 4)} AS total_r,
  {r("corr(MonthlyCharges, CAST(Churn AS DOUBLE))", 4)} AS monthly_r FROM clean),
m AS (SELECT *, {", ".join(f"{e} AS {n}" for n, e in gaps.items())} FROM m0)"""

    def text(template: str, names) -> str:
        values = [r(n, insights.DECIMALS.get(n, 1)) for n in names]
        missing = " OR ".join(f"{n} IS NULL" for n in names)
        return f"CASE WHEN {missing} THEN 'n/a' ELSE printf('{template}', {', '.join(values)}) END"

    rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS id, {text(f, fs)} AS finding, {text(g, gs)} AS impact, '{a}' AS action FROM m"
        for i, (f, fs, g, gs, a) in enumerate(insights.INSIGHTS, start=1))
    return over("clean", rows, wide)


@query("seg_7_insights", _insights_sql(), staged=True)
def _(t: Tables):
    return insights.insights(t.clean)


@query("seg_8_service_count_churn", _rate_sql("ServiceCount", "feat"))
def _(t: Tables):
    return segments.churn_rate_table(t.features, "ServiceCount")


@query("seg_9_new_customer_churn", _rate_sql("IsNewCustomer", "feat"))
def _(t: Tables):
    return segments.churn_rate_table(t.features, "IsNewCustomer")


@query("seg_10_tier_counts", over("predictions", f"""SELECT CAST(CASE RiskCategory WHEN 'High Risk' THEN 0 WHEN 'Medium Risk' THEN 1
  ELSE 2 END AS INTEGER) AS tier, RiskCategory, {big("count(*)")} AS customers,
  {pct("count(*)", "(SELECT count(*) FROM predictions)")} AS pct FROM predictions GROUP BY RiskCategory"""))
def _(t: Tables):
    return scoring.tier_counts(t.predictions)


@query("seg_11_revenue_by_tier", over("predictions", f"""SELECT RiskCategory, {r(esum("RevenueAtRisk"), 2)} AS revenue_sum,
  {r(emean("RevenueAtRisk"), 2)} AS revenue_mean, {big("count(*)")} AS customers
  FROM predictions WHERE PredictedChurn = 1 GROUP BY RiskCategory"""))
def _(t: Tables):
    return scoring.revenue_by_tier(t.predictions)


@query("seg_12_tier_summary", over("predictions", f"""SELECT RiskCategory, {big("count(customerID)")} AS Customers,
  {r(emean("ChurnProbabilityPct"), 2)} AS AvgProbability, {r(emean("MonthlyCharges"), 2)} AS AvgMonthlyCharge,
  {r(emean("tenure"), 2)} AS AvgTenure, {r(esum("RevenueAtRisk"), 2)} AS TotalRevAtRisk,
  {r(emean("ActualChurn"), 2)} AS ActualChurnRate FROM predictions GROUP BY RiskCategory"""))
def _(t: Tables):
    return scoring.tier_summary(t.predictions)


@query("seg_13_kpi_measures", over("predictions", f"""SELECT {big("count(customerID)")} AS total_customers,
  {r(esum("RevenueAtRisk"), 2)} AS revenue_at_risk, {r(emean("ChurnProbability"), 6)} AS avg_probability,
  {big("sum(PredictedChurn)")} AS predicted_churners, {big("count(*) FILTER (WHERE RiskCategory = 'High Risk')")} AS high_risk_count,
  {r("CAST(sum(PredictedChurn) AS DOUBLE) / nullif(count(customerID), 0)", 6)} AS predicted_churn_rate FROM predictions"""))
def _(t: Tables):
    return scoring.kpi_measures(t.predictions)


def _tiers_sql() -> str:
    tiers = {"high": "High Risk", "medium": "Medium Risk", "low": "Low Risk"}
    hits = {k: f"count(*) FILTER (WHERE RiskCategory = '{v}')" for k, v in tiers.items()}
    return ", ".join([f"{big(h)} AS {k}" for k, h in hits.items()] + [f"{pct(h, 'count(*)', 1)} AS {k}_pct" for k, h in hits.items()])


@query("seg_14_run_summary", over("predictions", f"""SELECT {big("count(*)")} AS scored, {big("sum(PredictedChurn)")} AS predicted,
  {pct("sum(PredictedChurn)", "count(*)", 1)} AS predicted_pct, {big("sum(ActualChurn)")} AS actual,
  {pct("sum(ActualChurn)", "count(*)", 1)} AS actual_pct, {_tiers_sql()},
  {r(esum("RevenueAtRisk"), 2)} AS monthly_revenue_at_risk, {r(esum("RevenueAtRisk") + " * 12", 2)} AS annual_revenue_at_risk
  FROM predictions"""))
def _(t: Tables):
    return scoring.run_summary(t.predictions)


@query("seg_15_revenue_impact", over("predictions", f"""SELECT {big("sum(PredictedChurn)")} AS predicted_churners,
  {r(esum("RevenueAtRisk"), 2)} AS monthly_at_risk, {r(esum("RevenueAtRisk") + " * 12", 2)} AS annual_at_risk,
  {r("coalesce(" + esum("CASE WHEN RiskCategory = 'High Risk' THEN RevenueAtRisk END") + ", 0)", 2)} AS high_risk_monthly,
  {r(esum("RevenueAtRisk") + " * CAST(0.3 AS DOUBLE) * 12", 2)} AS annual_saved FROM predictions"""))
def _(t: Tables):
    return scoring.revenue_impact(t.predictions)


@query("seg_16_high_risk_stats", over("predictions", f"""SELECT {big("count(*)")} AS customers,
  {r(emean("ChurnProbabilityPct"), 1)} AS avg_probability_pct, {r("coalesce(" + esum("RevenueAtRisk") + ", 0)", 2)} AS revenue_at_risk
  FROM predictions WHERE RiskCategory = 'High Risk'"""))
def _(t: Tables):
    return scoring.high_risk_stats(t.predictions)


@query("seg_17_business_kpis", over("clean", f"""SELECT {pct("sum(Churn)", "count(Churn)")} AS churn_rate,
  {pct("count(*) FILTER (WHERE Churn = 0)", "count(Churn)")} AS retention_rate,
  coalesce({esum("CASE WHEN Churn = 1 THEN MonthlyCharges END")}, 0.0) AS revenue_lost,
  {r(emean("MonthlyCharges") + " * " + emean("tenure"), 2)} AS clv,
  {big("count(*) FILTER (WHERE Contract = 'Month-to-month' AND tenure <= 12)")} AS high_risk_count FROM clean"""))
def _(t: Tables):
    return segments.business_kpis(t.clean)


@query("seg_18_impact_estimate", over("clean", f"""SELECT customers, avg_charge, churn_rate,
  {big("floor(customers * churn_rate)")} AS churned_customers,
  {r("floor(customers * churn_rate) * avg_charge", 2)} AS monthly_at_risk,
  {r("floor(customers * churn_rate) * avg_charge * 12", 2)} AS annual_at_risk,
  {r("floor(customers * churn_rate) * avg_charge * 12 * CAST(0.1 AS DOUBLE)", 2)} AS savings
FROM (SELECT {big("count(*)")} AS customers, {r(emean("MonthlyCharges"), 2)} AS avg_charge,
  {r("CAST(sum(Churn) AS DOUBLE) / nullif(count(Churn), 0)", 4)} AS churn_rate FROM clean)"""))
def _(t: Tables):
    return segments.impact_estimate(t.clean)


@query("seg_19_campaign_value", over("scored", f"""SELECT tp, fn, fp, tn, {r("clv", 2)} AS clv_per_churner,
  {r("tp * clv * CAST(0.3 AS DOUBLE)", 2)} AS revenue_saved, {r("fp * CAST(25 AS DOUBLE)", 2)} AS contact_cost,
  {r("tp * clv * CAST(0.3 AS DOUBLE) - fp * CAST(25 AS DOUBLE)", 2)} AS net_value
FROM (SELECT {big("count(*) FILTER (WHERE Churn = 1 AND p >= 0.4)")} AS tp, {big("count(*) FILTER (WHERE Churn = 1 AND p < 0.4)")} AS fn,
  {big("count(*) FILTER (WHERE Churn = 0 AND p >= 0.4)")} AS fp, {big("count(*) FILTER (WHERE Churn = 0 AND p < 0.4)")} AS tn,
  {emean("MonthlyCharges")} * CAST(32 AS DOUBLE) AS clv FROM scored)"""), staged=True)
def _(t: Tables):
    value = t.scored.agg(exact_mean(F.col("MonthlyCharges"))).scalar() * F.lit(32.0)
    return scoring.campaign_value(evaluation.confusion(t.scored), value)


# ---- features ----

def _feature(name: str, columns: list[str], fn=None, sql: str | None = None):
    shown = ", ".join(f'"{c}"' for c in columns)

    @query(name, sql or over("feat", f"SELECT customerID, {shown} FROM feat"))
    def _(t: Tables):
        return t.features.select("customerID", *columns) if fn is None else fn(t)


for _i, _c in enumerate(S.ENGINEERED, start=1):
    _snake = "".join("_" + ch.lower() if ch.isupper() and i and not _c[i - 1].isupper() else ch.lower() for i, ch in enumerate(_c))
    _feature(f"fea_{_i}_{_snake}", [_c])


def _bi_columns(name: str, columns: list[str]):
    shown = ", ".join(columns)

    @query(name, f"SELECT customerID, {shown} FROM ({bi_sql()})")
    def _(t: Tables):
        return features.bi_projection(t.clean).select("customerID", *columns)


_bi_columns("fea_11_tenure_group", ["TenureGroup"])
_bi_columns("fea_12_charges_band", ["ChargesBand"])
_bi_columns("fea_13_bi_clv", ["CLV"])
_bi_columns("fea_14_rule_based_risk", ["RuleBasedRisk"])
_bi_columns("fea_15_churn_status", ["ChurnStatus"])


@query("fea_16_bi_projection", bi_sql())
def _(t: Tables):
    return features.bi_projection(t.clean)


# ---- encodings ----

@query("enc_1_binary", over("ml", f"SELECT customerID, {', '.join(S.BINARY)} FROM encoded"))
def _(t: Tables):
    return encoding.encode_binary(t.features, TELCO.binary).select("customerID", *S.BINARY)


@query("enc_2_ordinal", over("ml", "SELECT customerID, Contract, InternetService FROM encoded"))
def _(t: Tables):
    return encoding.encode_ordinal(t.features, TELCO.ordinal).select("customerID", "Contract", "InternetService")


@query("enc_3_one_hot", over("ml", "SELECT customerID, " + ", ".join(f'"{c}"' for c in ML_FEATURES[-10:]) + " FROM encoded"))
def _(t: Tables):
    hot = encoding.one_hot(t.features, t.levels)
    return hot.select("customerID", *[f"`{c}`" for c in hot.columns if "_" in c and c.split("_")[0] in TELCO.nominal])


@query("enc_3_levels", over("clean", " UNION ".join(
    f"SELECT '{c}' AS feature, {c} AS value FROM clean WHERE {c} IS NOT NULL" for c in S.NOMINAL)))
def _(t: Tables):
    return encoding.level_pairs(t.clean, TELCO.nominal)


@query("enc_4_drop_columns", over("ml", "SELECT * EXCLUDE (customerID) FROM ml"))
def _(t: Tables):
    return encoding.drop_non_features(t.encoded)


@query("enc_5_align", over("ml", 'SELECT customerID, ' + ", ".join(f'"{c}"' for c in reversed(ML_FEATURES))
                           + ', CAST(0 AS INTEGER) AS "PaymentMethod_Unseen" FROM ml'))
def _(t: Tables):
    wanted = [*reversed(t.feature_names), "PaymentMethod_Unseen"]
    return encoding.align(t.ml, wanted, keep=[TELCO.key])


