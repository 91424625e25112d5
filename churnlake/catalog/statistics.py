"""Registered queries: distribution statistics and correlations."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from churnlake import spec as S
from churnlake.catalog.relations import Tables, query
from churnlake.catalog.sql import ML_FEATURES, big, emean, melt, over, pct, r
from churnlake.operators import correlation, distributions
from churnlake.operators.quantiles import exact_quantiles

# Columns the numeric reports read.
NUMBERS = (*S.NUMERIC, "Churn")
DESCRIBE_METRICS = ["mean", "std", "min", "q1", "median", "q3", "max", "skew", "kurtosis"]


def _quartiles(value: str = "value") -> str:
    return ", ".join(
        f"quantile_cont({value}, {p}) AS {n}" for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")))


def _moments_sql(table: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}feature, count(*) AS n, {emean("value")} AS mean, stddev_samp(value) AS std,
  min(value) AS min, max(value) AS max, {_quartiles()},
  CASE WHEN count(*) > 2 THEN skewness(value) END AS skew, CASE WHEN count(*) > 3 THEN kurtosis(value) END AS kurtosis
FROM ({melt(table, S.NUMERIC, by)}) GROUP BY {lead}feature"""


def describe_sql(table: str) -> str:
    return (f'SELECT feature, {big("n")} AS "count", ' + ", ".join(f"{r(m, 4)} AS {m}" for m in DESCRIBE_METRICS)
            + f" FROM ({_moments_sql(table)})")


@query("sta_1_describe", over("clean", f"SELECT * EXCLUDE (skew, kurtosis) FROM ({describe_sql('clean')})"), staged=NUMBERS)
def _(t: Tables):
    return distributions.describe(t.clean, S.NUMERIC).drop("skew", "kurtosis")


@query("sta_1_describe_features", over("feat", "SELECT feature, " + ", ".join(
    [f'{big("count(*)")} AS "count"', f"{r(emean('value'), 2)} AS mean", f"{r('stddev_samp(value)', 2)} AS std"]
    + [f"{r(x, 2)} AS {n}" for x, n in (
        ("min(value)", "min"), ("quantile_cont(value, 0.25)", "q1"), ("quantile_cont(value, 0.5)", "median"),
        ("quantile_cont(value, 0.75)", "q3"), ("max(value)", "max"))])
    + f" FROM ({melt('feat', S.ENGINEERED)}) GROUP BY feature"), staged=True)
def _(t: Tables):
    return distributions.describe(t.features, S.ENGINEERED, digits=2).drop("skew", "kurtosis")


@query("sta_2_skewness", over("clean", f"SELECT feature, {r('skew', 4)} AS skew FROM ({_moments_sql('clean')})"))
def _(t: Tables):
    return distributions.moments(t.clean, S.NUMERIC).select("feature", (F.rint(F.col("skew") * 1e4) / 1e4).alias("skew"))


@query("sta_3_kurtosis", over("clean", f"SELECT feature, {r('kurtosis', 4)} AS kurtosis FROM ({_moments_sql('clean')})"))
def _(t: Tables):
    return distributions.moments(t.clean, S.NUMERIC).select(
        "feature", (F.rint(F.col("kurtosis") * 1e4) / 1e4).alias("kurtosis"))


@query("sta_4_stats_table", over("clean", "SELECT feature, " + ", ".join(
    [f"{r(m, 2)} AS {m}" for m in ("mean", "median", "std", "min", "max")] + [f"{r(m, 3)} AS {m}" for m in ("skew", "kurtosis")])
    + f" FROM ({_moments_sql('clean')})"), staged=NUMBERS)
def _(t: Tables):
    return distributions.stats_table(t.clean, S.NUMERIC)


_FENCES = f"""f AS (
  SELECT feature, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
  FROM (SELECT feature, {_quartiles()} FROM ({melt("clean", S.NUMERIC)}) GROUP BY feature)),
hits AS (
  SELECT f.feature, f.q1, f.q3, f.iqr, f.lower, f.upper, count(*) FILTER (WHERE value < lower OR value > upper) AS outliers
  FROM ({melt("clean", S.NUMERIC)}) v JOIN f ON v.feature = f.feature GROUP BY ALL)"""


@query("sta_5_outliers", over(
    "clean", f"SELECT feature, {r('lower', 4)} AS lower, {r('upper', 4)} AS upper, {big('outliers')} AS outliers FROM hits",
    _FENCES), staged=NUMBERS)
def _(t: Tables):
    found = distributions.outliers(t.clean, S.NUMERIC)
    return found.select("feature", *[(F.rint(F.col(c) * 1e4) / 1e4).alias(c) for c in ("lower", "upper")], "outliers")


@query("sta_6_outlier_report", over("clean", "SELECT feature, " + ", ".join(
    f"{r(c, 2)} AS {c}" for c in ("q1", "q3", "iqr", "lower", "upper"))
    + f", {big('outliers')} AS outliers, {pct('outliers', '(SELECT count(*) FROM clean)')} AS outlier_pct FROM hits", _FENCES), staged=NUMBERS)
def _(t: Tables):
    return distributions.outlier_report(t.clean, S.NUMERIC)


def _corr(a: str, b: str) -> str:
    x, y = f'CAST("{a}" AS DOUBLE)', f'CAST("{b}" AS DOUBLE)'
    return f"CASE WHEN stddev_pop({x}) > 0 AND stddev_pop({y}) > 0 THEN corr({x}, {y}) END"


def _pairs_sql(columns, table: str, digits: int = 6) -> str:
    """All pair correlations as one row, unfolded to (a, b, r)."""
    cells = ", ".join(f'{_corr(a, b)} AS "{i}_{j}"' for (i, a), (j, b) in product(enumerate(columns), repeat=2))
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {r(f'\"{i}_{j}\"', digits)} AS r FROM m"
        for (i, a), (j, b) in product(enumerate(columns), repeat=2))
    return over("feat" if table == "feat" else "clean", rows, f"m AS MATERIALIZED (SELECT {cells} FROM {table})")


FOUR = [*S.NUMERIC, "Churn"]
FOURTEEN = [*S.NUMERIC, *S.ENGINEERED, "Churn"]


@query("sta_7_correlation", _pairs_sql(FOUR, "clean"))
def _(t: Tables):
    return correlation.correlation_pairs(t.clean, FOUR)


@query("sta_8_target_correlation", over("clean", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(_corr(c, 'Churn'), 6)} AS r FROM clean" for c in S.NUMERIC)))
def _(t: Tables):
    return correlation.target_correlation(t.clean, S.NUMERIC)


@query("sta_9_feature_correlation", _pairs_sql(FOURTEEN, "feat"))
def _(t: Tables):
    return correlation.correlation_pairs(t.features, FOURTEEN)


@query("sta_10_importance_preview", over("split", "SELECT feature, abs_correlation FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'abs({_corr(c, 'Churn')})', 4)} AS abs_correlation FROM split WHERE split = 'train'"
    for c in ML_FEATURES) + ") ORDER BY abs_correlation DESC NULLS LAST, feature LIMIT 20"), staged=True)
def _(t: Tables):
    train = t.split.where(F.col("split") == "train")
    return correlation.importance_preview(train, t.feature_names)


def _hist_sql(stage: str, table: str, columns, bins: int, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    same = f"v.{by} IS NOT DISTINCT FROM g.{by} AND " if by else ""
    edge = "CASE WHEN {i} >= " + str(bins) + " THEN high ELSE ({i}) * ((high - low) / " + f"{bins}e0" + ") + low END"
    raw = f"least(floor((value - low) / (high - low) * {bins}e0), {bins - 1})"
    ctes = f"""v AS ({melt(table, columns, by)}),
g AS (
  SELECT {lead}feature, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS low,
    CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS high
  FROM v GROUP BY {lead}feature),
i0 AS (SELECT v.*, g.low, g.high, {raw} AS raw FROM v JOIN g ON {same} v.feature = g.feature),
i1 AS (
  SELECT *, CAST(raw - CASE WHEN value < {edge.format(i="raw")} THEN 1 ELSE 0 END
    + CASE WHEN raw <> {bins - 1} AND value >= {edge.format(i="raw + 1")} THEN 1 ELSE 0 END AS INTEGER) AS bin FROM i0),
c AS (SELECT {lead}feature, bin, count(*) AS n FROM i1 GROUP BY {lead}feature, bin),
s AS (SELECT g.*, CAST(k AS INTEGER) AS bin FROM g, range({bins}) t(k))"""
    on = f"s.{by} IS NOT DISTINCT FROM c.{by} AND " if by else ""
    pick = f"s.{by}, " if by else ""
    return over(stage, f"""SELECT {pick}s.feature, s.bin, {edge.format(i="s.bin")} AS bin_low,
  {edge.format(i="s.bin + 1")} AS bin_high, {big("coalesce(c.n, 0)")} AS n
FROM s LEFT JOIN c ON {on} s.feature = c.feature AND s.bin = c.bin""", ctes)


@query("sta_11_histogram", _hist_sql("clean", "clean", S.NUMERIC, 40), staged=NUMBERS)
def _(t: Tables):
    return distributions.histogram(t.clean, S.NUMERIC, 40)


@query("sta_12_histogram_by_class", _hist_sql("clean", "clean", S.NUMERIC, 30, "Churn"), staged=NUMBERS)
def _(t: Tables):
    return distributions.histogram(t.clean, S.NUMERIC, 30, ["Churn"])


def density_ctes(table: str, columns, by: str, points: int, range_pad: float, h_pad: float) -> str:
    """CTE ``kde``: (by, feature, point, x, density)."""
    return f"""kv AS ({melt(table, columns, by)}),
kd AS (SELECT {by}, feature, value, count(*) AS copies FROM kv GROUP BY {by}, feature, value),
ks AS (
  SELECT {by}, feature, count(*) AS n, pow(count(*), CAST(-0.2 AS DOUBLE)) * stddev_samp(value) AS h,
    min(value) AS lo, max(value) AS hi FROM kv GROUP BY {by}, feature HAVING stddev_samp(value) > 0),
kg AS (
  SELECT {by}, feature, n, h, lo - ((hi - lo) * {range_pad} + {h_pad} * h) AS a,
    (hi + ((hi - lo) * {range_pad} + {h_pad} * h) - (lo - ((hi - lo) * {range_pad} + {h_pad} * h))) / {points - 1}e0 AS step
  FROM ks),
kde AS (
  SELECT kg.{by}, kg.feature, CAST(k AS INTEGER) AS point, {r("max(kg.a + k * kg.step)", 6)} AS x,
    {r("sum(kd.copies * exp(-0.5 * pow((kg.a + k * kg.step - kd.value) / kg.h, 2))) / (max(kg.n) * max(kg.h) * sqrt(2.0 * pi()))", 9)}
      AS density
  FROM kg JOIN kd ON kg.{by} = kd.{by} AND kg.feature = kd.feature, range({points}) t(k)
  GROUP BY kg.{by}, kg.feature, k)"""


@query("sta_13_density", over(
    "clean", "SELECT Churn, feature, point, x, density FROM kde", density_ctes("clean", S.NUMERIC, "Churn", 1000, 0.5, 0.0)), staged=NUMBERS)
def _(t: Tables):
    return distributions.density(t.clean, S.NUMERIC, ["Churn"])


_BOX = f"""bv AS ({melt("clean", S.NUMERIC, "Churn")}),
bq AS (SELECT Churn, feature, {_quartiles()} FROM bv GROUP BY Churn, feature),
bx AS (
  SELECT bv.Churn, bv.feature, value, q1, median, q3,
    value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM bv JOIN bq ON bv.Churn = bq.Churn AND bv.feature = bq.feature)"""


@query("sta_14_box_stats", over("clean", f"""SELECT Churn, feature, {r("q1", 4)} AS q1, {r("median", 4)} AS median,
  {r("q3", 4)} AS q3, {r("least(min(value) FILTER (WHERE inside), q1)", 4)} AS whisker_low,
  {r("greatest(max(value) FILTER (WHERE inside), q3)", 4)} AS whisker_high,
  {big("count(*) FILTER (WHERE NOT inside)")} AS fliers FROM bx GROUP BY Churn, feature, q1, median, q3""", _BOX), staged=NUMBERS)
def _(t: Tables):
    return distributions.box_stats(t.clean, S.NUMERIC, ["Churn"])


@query("sta_14_exact_quantiles", over("clean", " UNION ALL ".join(
    f"SELECT Churn, feature, CAST({p} AS DOUBLE) AS prob, {r(f'quantile_cont(value, {p})', 6)} AS quantile "
    f"FROM bv GROUP BY Churn, feature" for p in (0.01, 0.1, 0.5, 0.9, 0.99)), _BOX), staged=NUMBERS)
def _(t: Tables):
    found = exact_quantiles(t.clean, S.NUMERIC, [0.01, 0.1, 0.5, 0.9, 0.99], ["Churn"])
    return found.withColumn("quantile", F.rint(F.col("quantile") * 1e6) / 1e6)


@query("sta_15_violin", over("clean", """SELECT Churn, feature, 'outline' AS part, point, x, density FROM kde
UNION ALL """ + " UNION ALL ".join(
    f"SELECT Churn, feature, '{q}', 0, {r(q, 6)}, CAST(NULL AS DOUBLE) FROM bq" for q in ("q1", "median", "q3")),
    density_ctes("clean", S.NUMERIC, "Churn", 100, 0.0, 2.0), _BOX), staged=NUMBERS)
def _(t: Tables):
    return distributions.violin(t.clean, S.NUMERIC, ["Churn"])


@query("sta_16_feature_profile", over("feat", f"""
SELECT 'crosstab' AS kind, kv.feature, kv.Churn AS target, value AS x, CAST(count(*) AS DOUBLE) AS y
FROM kv JOIN few ON kv.feature = few.feature GROUP BY kv.feature, kv.Churn, value
UNION ALL
SELECT 'density', kde.feature, kde.Churn, x, density FROM kde WHERE feature NOT IN (SELECT feature FROM few)""",
    density_ctes("feat", S.ENGINEERED, "Churn", 1000, 0.5, 0.0),
    "few AS (SELECT feature FROM kv GROUP BY feature HAVING count(DISTINCT value) <= 6)"), staged=True)
def _(t: Tables):
    return distributions.feature_profile(t.features, S.ENGINEERED)


_P = ["ChurnProbability"]


@query("sta_17_probability_histogram", _hist_sql("predictions", "predictions", _P, 50), staged=True)
def _(t: Tables):
    return distributions.histogram(t.predictions, _P, 50)


@query("sta_17_probability_by_actual", _hist_sql("predictions", "predictions", _P, 30, "ActualChurn"), staged=True)
def _(t: Tables):
    return distributions.histogram(t.predictions, _P, 30, ["ActualChurn"])


@query("sta_17_probability_by_tier", _hist_sql("predictions", "predictions", _P, 20, "RiskCategory"), staged=True)
def _(t: Tables):
    return distributions.histogram(t.predictions, _P, 20, ["RiskCategory"])


def _cell(v: str) -> str:
    edge = "CASE WHEN {i} >= 50 THEN hi ELSE ({i}) * ((hi - lo) / 50e0) + lo END".replace("hi", f"{v}1").replace("lo", f"{v}0")
    raw = f"least(floor(({v} - {v}0) / ({v}1 - {v}0) * 50e0), 49)"
    return (f"CAST({raw} - CASE WHEN {v} < {edge.format(i=raw)} THEN 1 ELSE 0 END "
            f"+ CASE WHEN {raw} <> 49 AND {v} >= {edge.format(i=raw + ' + 1')} THEN 1 ELSE 0 END AS INTEGER)")


@query("sta_18_charge_by_probability", over("predictions", f"""
SELECT RiskCategory, {_cell("x")} AS x_bin, {_cell("y")} AS y_bin, {big("count(*)")} AS n FROM xy GROUP BY ALL""",
    """ends AS (SELECT min(MonthlyCharges) AS x0, max(MonthlyCharges) AS x1, min(ChurnProbability) AS y0,
  max(ChurnProbability) AS y1 FROM predictions),
xy AS (SELECT RiskCategory, MonthlyCharges AS x, ChurnProbability AS y, ends.* FROM predictions, ends)"""), staged=True)
def _(t: Tables):
    return distributions.binned_points(t.predictions, "MonthlyCharges", "ChurnProbability", 50, ["RiskCategory"])


