"""Registered queries: sources, sinks, audit and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake import spec as S
from churnlake.catalog.relations import Tables, query
from churnlake.catalog.sql import big, over, pct
from churnlake.operators import audit, cleaning, distributions, features, scaling, scoring
from churnlake.session import scratch_path
from churnlake.sources import sinks, tables
from churnlake.spec import RAW_SCHEMA

RAW_COLUMNS = RAW_SCHEMA.names
CLEAN_COLUMNS = [*RAW_COLUMNS, "SeniorCitizenLabel", "ChurnLabel"]


# ---- sources and sinks: each writes what Spark derived from the given tables and reads it back ----

@query("src_1_raw_csv", over("raw", "SELECT * FROM raw"))
def _(t: Tables):
    path = scratch_path(t.spark, "raw_csv")
    sinks.write_csv(t.raw, path)
    return tables.read_raw_csv(t.spark, path)


@query("src_2_clean_table", over("clean", "SELECT * FROM clean"))
def _(t: Tables):
    path = scratch_path(t.spark, "clean")
    sinks.write_table(t.clean, path)
    return tables.read_table(t.spark, path)


@query("src_3_train_side", over("split", "SELECT * FROM split WHERE split = 'train'"), staged=True)
def _(t: Tables):
    path = scratch_path(t.spark, "split")
    sinks.write_features(t.split, path)
    return tables.read_split(t.spark, path, "train")


@query("snk_1_clean_csv", over("clean", "SELECT customerID, tenure, MonthlyCharges, TotalCharges, Churn FROM clean"))
def _(t: Tables):
    path = scratch_path(t.spark, "clean_csv")
    sinks.write_csv(t.clean, path)
    back = t.spark.read.schema(t.clean.schema).option("header", True).csv(path)
    return back.select("customerID", "tenure", "MonthlyCharges", "TotalCharges", "Churn")


@query("snk_2_features_by_split", over(
    "split", f"SELECT split, {big('count(*)')} AS n_rows, {big('sum(Churn)')} AS churned FROM split GROUP BY split"), staged=True)
def _(t: Tables):
    path = scratch_path(t.spark, "features")
    sinks.write_features(t.split, path)
    sinks.write_table(scaling.fit_scaler(t.split.where(F.col("split") == "train")), path + "-scaler")
    return tables.read_table(t.spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("Churn").alias("churned"))


BI_SQL = f"""SELECT customerID, CASE Churn WHEN 1 THEN 'Churned' WHEN 0 THEN 'Active' END AS ChurnStatus, Churn, gender,
  SeniorCitizenLabel, Partner, Dependents, tenure, {{tenure}} AS TenureGroup, Contract, PaymentMethod,
  PaperlessBilling, InternetService, PhoneService, MonthlyCharges, {{charge}} AS ChargesBand, TotalCharges, {{clv}} AS CLV,
  CASE WHEN Contract = 'Month-to-month' AND tenure <= 12 THEN 'High Risk'
       WHEN Contract = 'Month-to-month' AND tenure <= 24 THEN 'Medium Risk' ELSE 'Low Risk' END AS RuleBasedRisk,
  {", ".join(c for c in CLEAN_COLUMNS if c not in S.BI_LEAD)}
FROM clean"""


def bi_sql() -> str:
    from churnlake.catalog.sql import CHARGE_TEXT, TENURE_TEXT, r
    return over("clean", BI_SQL.format(tenure=TENURE_TEXT, charge=CHARGE_TEXT, clv=r("tenure * MonthlyCharges", 2)))


@query("snk_3_bi_csv", bi_sql())
def _(t: Tables):
    path = scratch_path(t.spark, "bi")
    bi = features.bi_projection(t.clean)
    sinks.write_csv(bi, path)
    return t.spark.read.schema(bi.schema).option("header", True).csv(path)


@query("snk_4_predictions_by_tier", over(
    "predictions", "SELECT customerID, RiskCategory, ChurnProbability FROM predictions WHERE RiskCategory = 'High Risk'"), staged=True)
def _(t: Tables):
    path = scratch_path(t.spark, "predictions")
    sinks.write_predictions(t.predictions, path)
    high = scoring.tier_list(tables.read_table(t.spark, path), S.TIERS[0])
    return high.select("customerID", "RiskCategory", "ChurnProbability")


# ---- audit ----

@query("aud_1_shape", over("raw", f"SELECT {big('count(*)')} AS n_rows, 21 AS n_columns FROM raw"))
def _(t: Tables):
    return audit.shape(t.raw)


_TYPES = "CASE typeof({c}) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(typeof({c})) END"


def _types_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {big(f'count({c})')} AS non_null, max({_TYPES.format(c=c)}) AS dtype FROM raw"
        for c in RAW_COLUMNS)


@query("aud_2_column_types", over("raw", _types_sql()))
def _(t: Tables):
    return audit.column_types(t.raw)


@query("aud_2_type_counts", over("raw", (
    f"SELECT dtype, {big('count(*)')} AS n_columns, {big('sum(non_null)')} AS non_null FROM ({_types_sql()}) GROUP BY dtype")))
def _(t: Tables):
    return audit.type_counts(t.raw)


def _nulls(measure: str) -> str:
    return over("typed", " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {measure.format(c=c)} FROM typed HAVING count(*) > count({c})"
        for c in [*RAW_COLUMNS, "SeniorCitizenLabel"]))


@query("aud_3_null_counts", _nulls(big("count(*) - count({c})") + " AS nulls"))
def _(t: Tables):
    return audit.null_counts(cleaning.fix_data_types(t.raw)).select("column", "nulls")


@query("aud_4_null_percentages", _nulls(pct("count(*) - count({c})", "count(*)") + " AS null_pct"))
def _(t: Tables):
    return audit.null_counts(cleaning.fix_data_types(t.raw)).select("column", "null_pct")


@query("aud_5_duplicate_rows", over(
    "raw", f"SELECT {big('(SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))')} AS duplicate_rows"))
def _(t: Tables):
    return audit.duplicate_rows(t.raw)


@query("aud_6_distinct_values", over("raw", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {big(f'count(DISTINCT {c})')} AS distinct_values FROM raw" for c in RAW_COLUMNS)))
def _(t: Tables):
    return audit.distinct_counts(t.raw)


@query("aud_7_target_distribution", over(
    "raw", f"SELECT Churn, {big('count(*)')} AS n_rows, {pct('count(*)', '(SELECT count(Churn) FROM raw)')} AS pct "
           "FROM raw WHERE Churn IS NOT NULL GROUP BY Churn"))
def _(t: Tables):
    return audit.target_distribution(t.raw)


@query("aud_8_duplicate_keys", over("raw", f"SELECT {big('count(*) - count(DISTINCT customerID)')} AS duplicate_keys FROM raw"))
def _(t: Tables):
    return audit.duplicate_keys(t.raw)


@query("aud_9_blank_total_rule", over(
    "typed", f"SELECT {big('count(*)')} AS n_rows, coalesce(bool_and(tenure = 0), true) AS all_tenure_zero "
             "FROM typed WHERE TotalCharges IS NULL"))
def _(t: Tables):
    return audit.blank_total_rule(cleaning.fix_data_types(t.raw))


@query("aud_9_blank_total_sample", over(
    "typed", "SELECT customerID, tenure, MonthlyCharges, TotalCharges FROM typed WHERE TotalCharges IS NULL "
             "ORDER BY customerID LIMIT 5"))
def _(t: Tables):
    return audit.blank_total_sample(cleaning.fix_data_types(t.raw))


_ANY_NULL = " OR ".join(f"{c} IS NULL" for c in CLEAN_COLUMNS)


@query("aud_10_validate_clean", over("clean", f"""
SELECT 'no_nulls' AS "check", count(*) FILTER (WHERE {_ANY_NULL}) = 0 AS passed FROM clean
UNION ALL SELECT 'unique_key', count(DISTINCT customerID) = count(*) FROM clean
UNION ALL SELECT 'total_charges_is_double', max(typeof(TotalCharges)) = 'DOUBLE' FROM clean
UNION ALL SELECT 'target_is_0_or_1', count(*) FILTER (WHERE Churn IS NULL OR Churn NOT IN (0, 1)) = 0 FROM clean
UNION ALL SELECT 'enough_rows', count(*) >= 7000 FROM clean
UNION ALL SELECT 'enough_columns', count(*) >= 0 FROM clean"""))
def _(t: Tables):
    return audit.validate_clean(t.clean)


_CORE = ["customerID", "PredictedChurn", "ChurnProbability", "RiskCategory", "RiskScore", "PriorityRank"]


@query("aud_11_validate_predictions", over("predictions", f"""
SELECT 'no_nulls_in_core_cols' AS "check", count(*) FILTER (WHERE {" OR ".join(f"{c} IS NULL" for c in _CORE)}) = 0 AS passed
FROM predictions
UNION ALL SELECT 'probabilities_in_0_1', bool_and(ChurnProbability BETWEEN 0 AND 1) FROM predictions
UNION ALL SELECT 'risk_score_in_1_100', bool_and(RiskScore BETWEEN 1 AND 100) FROM predictions
UNION ALL SELECT 'valid_risk_categories', bool_and(RiskCategory IN ('High Risk', 'Medium Risk', 'Low Risk')) FROM predictions
UNION ALL SELECT 'revenue_zero_for_non_churners', bool_and(PredictedChurn <> 0 OR RevenueAtRisk = 0) FROM predictions
UNION ALL SELECT 'rank_in_1_n', min(PriorityRank) >= 1 AND max(PriorityRank) <= count(*) FROM predictions"""), staged=True)
def _(t: Tables):
    return audit.validate_predictions(t.predictions)


@query("aud_12_value_distribution", over(
    "feat", f"SELECT ServiceCount, {big('count(*)')} AS n_rows FROM feat GROUP BY ServiceCount"))
def _(t: Tables):
    return audit.value_distribution(t.features, "ServiceCount")


@query("aud_12_encoded_distribution", over(
    "ml", f"SELECT Contract, {big('count(*)')} AS n_rows FROM ml GROUP BY Contract"))
def _(t: Tables):
    return audit.value_distribution(t.ml, "Contract")


def _overview_sql() -> str:
    from churnlake.catalog.statistics import DESCRIBE_METRICS, describe_sql
    clean_types = " UNION ALL ".join(
        f"SELECT '{c}' AS c, max({_TYPES.format(c=c)}) AS dtype FROM clean" for c in CLEAN_COLUMNS)
    stats = " UNION ALL ".join(
        f"SELECT 'stats' AS section, feature AS item, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM d"
        for m in ["count", *DESCRIBE_METRICS])
    return over("clean", f"""
SELECT 'shape' AS section, 'table' AS item, 'n_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM clean
UNION ALL SELECT 'shape', 'table', 'n_columns', CAST(max(23) AS DOUBLE) FROM clean
UNION ALL SELECT 'types', dtype, 'n_columns', CAST(count(*) AS DOUBLE) FROM ({clean_types}) GROUP BY dtype
UNION ALL SELECT 'duplicates', 'table', 'duplicate_rows',
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM clean)) AS DOUBLE) FROM clean
UNION ALL {stats}""", f"d AS ({describe_sql('clean')})")


@query("aud_13_overview", _overview_sql(), staged=True)
def _(t: Tables):
    return audit.overview(t.clean, distributions.describe(t.clean, S.NUMERIC))


# ---- cleaning ----

@query("cln_1_blank_to_null", over(
    "raw", "SELECT customerID, CASE WHEN trim(TotalCharges) = '' THEN NULL ELSE TotalCharges END AS TotalCharges FROM raw"))
def _(t: Tables):
    return cleaning.blank_to_null(t.raw, ["TotalCharges"]).select("customerID", "TotalCharges")


@query("cln_2_text_to_double", over("typed", "SELECT customerID, TotalCharges FROM typed"))
def _(t: Tables):
    return cleaning.text_to_double(t.raw, ["TotalCharges"]).select("customerID", "TotalCharges")


@query("cln_3_senior_label", over("typed", "SELECT customerID, SeniorCitizen, SeniorCitizenLabel FROM typed"))
def _(t: Tables):
    labelled = cleaning.map_flag(t.raw, "SeniorCitizen", "SeniorCitizenLabel", {0: "No", 1: "Yes"})
    return labelled.select("customerID", "SeniorCitizen", "SeniorCitizenLabel")


@query("cln_4_fill_charges", over(
    "typed", "SELECT customerID, coalesce(TotalCharges, 0.0) AS TotalCharges FROM typed"))
def _(t: Tables):
    return cleaning.fill_missing_charges(cleaning.fix_data_types(t.raw)).select("customerID", "TotalCharges")


@query("cln_5_drop_duplicates", over("raw", "SELECT DISTINCT * FROM raw"))
def _(t: Tables):
    return cleaning.drop_duplicate_rows(t.raw)


@query("cln_6_strip_text", over(
    "raw", "SELECT customerID, trim(PaymentMethod) AS PaymentMethod, trim(TotalCharges) AS TotalCharges FROM raw"))
def _(t: Tables):
    return cleaning.strip_text(t.raw).select("customerID", "PaymentMethod", "TotalCharges")


_SEVEN = [*S.ADD_ONS, "MultipleLines"]


@query("cln_7_collapse_no", over("raw", "SELECT customerID, " + ", ".join(
    f"CASE WHEN {c} IN ('No internet service', 'No phone service') THEN 'No' ELSE {c} END AS {c}" for c in _SEVEN) + " FROM raw"))
def _(t: Tables):
    return cleaning.collapse_verbose_no(t.raw).select("customerID", *_SEVEN)


@query("cln_8_target_label", over("raw", "SELECT customerID, Churn AS ChurnLabel FROM raw"))
def _(t: Tables):
    return cleaning.encode_target(t.raw).select("customerID", "ChurnLabel")


@query("cln_9_encode_target", over(
    "raw", "SELECT customerID, CAST(CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS Churn FROM raw"))
def _(t: Tables):
    return cleaning.encode_target(t.raw).select("customerID", "Churn")


@query("cln_10_clean", over("clean", "SELECT * FROM clean"))
def _(t: Tables):
    return t.clean

