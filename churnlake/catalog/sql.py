"""Building blocks of the comparison SQL."""

from __future__ import annotations

from churnlake import spec as S
from churnlake.catalog.relations import SCORERS


def r(x: str, digits: int) -> str:
    """Half-even rounding of a double expression."""
    return f"(round_even(CAST({x} AS DOUBLE) * 1e{digits}, 0) / 1e{digits} + 0)"


def esum(x: str, scale: int = 4) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def emean(x: str, scale: int = 4) -> str:
    return f"({esum(x, scale)} / nullif(count({x}), 0))"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return r(f"(CAST({part} AS DOUBLE) / CAST(nullif({whole}, 0) AS DOUBLE)) * 100.0", digits)


def ratio(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / CAST(nullif({den}, 0) AS DOUBLE), 0.0)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def band(x: str, edges, labels, outside: str, text: bool = True) -> str:
    cases = " ".join(
        f"WHEN {x} > {lo} AND {x} <= {hi} THEN " + (f"'{lab}'" if text else str(lab))
        for lo, hi, lab in zip(edges, edges[1:], labels))
    return f"CASE {cases} ELSE {outside} END"


RAW_CTE = """
o AS (
  SELECT o_custkey, count(*) AS n_orders,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend,
         max(year(o_orderdate)*12 + month(o_orderdate)) AS last_m
  FROM orders GROUP BY o_custkey),
snap AS (SELECT max(year(o_orderdate)*12 + month(o_orderdate)) AS snap_m FROM orders),
b AS (
  SELECT c.c_custkey AS k, c.c_nationkey AS n, c.c_acctbal AS bal, c.c_mktsegment AS seg,
         coalesce(o.n_orders, 0) AS n_orders, o.spend, snap.snap_m - o.last_m AS idle_m
  FROM customer c LEFT JOIN o ON c.c_custkey = o.o_custkey CROSS JOIN snap),
r AS (
  SELECT CAST(k AS STRING) AS customerID,
    CASE WHEN k % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS SeniorCitizen,
    CASE WHEN n % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN n % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
    CAST(CASE WHEN n_orders <= 3 THEN 0 ELSE n_orders * 4 END AS INT) AS tenure,
    CASE WHEN k % 10 = 3 THEN 'No' ELSE 'Yes' END AS PhoneService,
    CASE WHEN k % 10 = 3 THEN 'No phone service' WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS MultipleLines,
    CASE n % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END AS InternetService,
    CASE WHEN n % 3 = 2 THEN 'No internet service' WHEN k % 4 = 1 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
    CASE WHEN n % 3 = 2 THEN 'No internet service' WHEN k % 5 < 2 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
    CASE WHEN n % 3 = 2 THEN 'No internet service' WHEN k % 6 < 2 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
    CASE WHEN n % 3 = 2 THEN 'No internet service' WHEN k % 7 < 2 THEN 'Yes' ELSE 'No' END AS TechSupport,
    CASE WHEN n % 3 = 2 THEN 'No internet service' WHEN k % 8 < 3 THEN 'Yes' ELSE 'No' END AS StreamingTV,
    CASE WHEN n % 3 = 2 THEN 'No internet service' WHEN k % 9 < 4 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
    CASE seg WHEN 'AUTOMOBILE' THEN 'One year' WHEN 'FURNITURE' THEN 'Two year' ELSE 'Month-to-month' END AS Contract,
    CASE WHEN k % 5 < 3 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    concat(CASE k % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
                      WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END,
           CASE WHEN k % 11 = 0 THEN ' ' ELSE '' END) AS PaymentMethod,
    floor(abs(bal) / 80 * 100 + 0.5) / 100 AS MonthlyCharges,
    CASE WHEN n_orders <= 3 THEN ' ' ELSE CAST(CAST(spend / 1000 AS DECIMAL(18,2)) AS STRING) END AS TotalCharges,
    CASE WHEN idle_m IS NULL OR idle_m >= 11 THEN 'Yes' ELSE 'No' END AS Churn
  FROM b),
raw AS (SELECT * FROM r UNION ALL SELECT * FROM r WHERE CAST(customerID AS BIGINT) % 50 = 0)"""

TYPED_CTE = """
typed AS (
  SELECT * REPLACE (TRY_CAST(nullif(trim(TotalCharges), '') AS DOUBLE) AS TotalCharges),
         CASE SeniorCitizen WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' END AS SeniorCitizenLabel
  FROM raw)"""

_TEXT = [c for c in (*S.CATEGORICAL, "SeniorCitizenLabel") if c not in (*S.ADD_ONS, "MultipleLines")]
CLEAN_CTE = f"""
filled AS (SELECT * REPLACE (coalesce(TotalCharges, 0.0) AS TotalCharges) FROM typed),
deduped AS (SELECT DISTINCT * FROM filled),
clean AS (
  SELECT * REPLACE (
    trim(customerID) AS customerID,
    {", ".join(f"trim({c}) AS {c}" for c in _TEXT)},
    {", ".join(f"CASE WHEN trim({c}) IN ('No internet service', 'No phone service') THEN 'No' ELSE trim({c}) END AS {c}"
               for c in (*S.ADD_ONS, "MultipleLines"))},
    CAST(CASE trim(Churn) WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS Churn),
    trim(Churn) AS ChurnLabel
  FROM deduped)"""

_ADDONS = " + ".join(f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END" for c in S.ADD_ONS)
FEATURE_CTE = f"""
feat0 AS (
  SELECT *, CAST({_ADDONS} AS INTEGER) AS ServiceCount,
    CASE WHEN tenure > 0 THEN {r("TotalCharges / tenure", 2)} ELSE MonthlyCharges END AS AvgMonthlySpend
  FROM clean),
feat AS (
  SELECT *, {r("MonthlyCharges / (AvgMonthlySpend + 1e-6)", 4)} AS ChargeToTenureRatio,
    {r("TotalCharges", 2)} AS CLV,
    CAST({band("tenure", S.TENURE_EDGES, range(4), "0", False)} AS INTEGER) AS TenureGroup_num,
    CAST({band("MonthlyCharges", S.CHARGE_EDGES, range(4), "0", False)} AS INTEGER) AS ChargesBand_num,
    CAST(CASE Contract WHEN 'Month-to-month' THEN 2 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 0 ELSE 1 END AS INTEGER)
      AS ContractRisk,
    CAST(CASE WHEN tenure <= 12 THEN 1 ELSE 0 END AS INTEGER) AS IsNewCustomer,
    CAST(CASE WHEN tenure > 48 THEN 1 ELSE 0 END AS INTEGER) AS IsLongTermCustomer,
    CAST(CASE WHEN ServiceCount = 0 THEN 1 ELSE 0 END AS INTEGER) AS HasNoAddOns
  FROM feat0)"""

METHODS = ("Credit card (automatic)", "Electronic check", "Mailed check")
ONE_HOT = [f"PaymentMethod_{m}" for m in METHODS] + [f"{c}_Yes" for c in S.NOMINAL if c != "PaymentMethod"]


def yes(c: str) -> str:
    return f"CAST(CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END AS INTEGER)"


_ORDINAL = (
    "CAST(CASE Contract WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 ELSE 0 END AS INTEGER) AS Contract, "
    "CAST(CASE InternetService WHEN 'DSL' THEN 1 WHEN 'Fiber optic' THEN 2 ELSE 0 END AS INTEGER) AS InternetService")
_HOT = ", ".join(
    [f"CAST(CASE WHEN PaymentMethod = '{m}' THEN 1 ELSE 0 END AS INTEGER) AS \"PaymentMethod_{m}\"" for m in METHODS]
    + [f'{yes(c)} AS "{c}_Yes"' for c in S.NOMINAL if c != "PaymentMethod"])
ENCODED_CTE = f"""
encoded AS (
  SELECT * EXCLUDE ({", ".join(S.NOMINAL)})
    REPLACE ({", ".join(f"{yes(c)} AS {c}" for c in S.BINARY)}, {_ORDINAL}),
    {_HOT}
  FROM feat),
ml AS (SELECT * EXCLUDE (ChurnLabel, SeniorCitizen, gender) FROM encoded)"""

ML_FEATURES = [
    "Partner", "Dependents", "tenure", "PhoneService", "InternetService", "Contract", "PaperlessBilling",
    "MonthlyCharges", "TotalCharges", "SeniorCitizenLabel", *S.ENGINEERED, *ONE_HOT]


def _logit(name: str) -> str:
    intercept, weights = SCORERS[name]
    z = f"CAST({intercept} AS DOUBLE)"
    for column, weight in weights.items():
        z = f"({z} + CAST({weight} AS DOUBLE) * e.\"{column}\")"
    return r(f"CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-({z})))", 6)


SCORED_CTE = f"""
scored AS (
  SELECT c.*, {_logit("alpha")} AS p FROM clean c JOIN encoded e USING (customerID)),
scored_models AS (
  {" UNION ALL ".join(f"SELECT '{n}' AS model, e.customerID, e.Churn, {_logit(n)} AS p FROM encoded e" for n in SCORERS)})"""

TIER = "CASE WHEN p >= 0.7 THEN 'High Risk' WHEN p >= 0.4 THEN 'Medium Risk' ELSE 'Low Risk' END"
TENURE_TEXT = band("tenure", S.TENURE_EDGES, S.TENURE_LABELS, "'nan'")
CHARGE_TEXT = band("MonthlyCharges", S.CHARGE_EDGES, S.CHARGE_LABELS, "'nan'")
PREDICTIONS_CTE = f"""
pred0 AS (
  SELECT customerID, Churn AS ActualChurn,
    CASE Churn WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS ActualChurnLabel,
    CAST(CASE WHEN p >= 0.4 THEN 1 ELSE 0 END AS INTEGER) AS PredictedChurn,
    CASE WHEN p >= 0.4 THEN 'Yes' ELSE 'No' END AS PredictedChurnLabel,
    {r("p", 4)} AS ChurnProbability, {r("p * 100", 2)} AS ChurnProbabilityPct,
    {TIER} AS RiskCategory,
    CAST(greatest(1, least(100, round_even(p * 100, 0))) AS INTEGER) AS RiskScore,
    MonthlyCharges, TotalCharges, tenure,
    CASE WHEN p >= 0.4 THEN MonthlyCharges ELSE CAST(0 AS DOUBLE) END AS RevenueAtRisk,
    {r("TotalCharges", 2)} AS CLV,
    CASE WHEN p >= 0.4 THEN {r("MonthlyCharges * greatest(0, 36 - tenure)", 2)} ELSE CAST(0 AS DOUBLE) END
      AS EstimatedCLVAtRisk,
    {", ".join(S.PREDICTION_CONTEXT)},
    {TENURE_TEXT} AS TenureGroup, {CHARGE_TEXT} AS ChargesBand
  FROM scored),
predictions AS (
  SELECT *, {big("rank() OVER (ORDER BY ChurnProbability DESC)")} AS PriorityRank,
    CAST(CASE WHEN PredictedChurn = ActualChurn THEN 1 ELSE 0 END AS INTEGER) AS IsCorrectPrediction
  FROM pred0)"""

_QUOTA = """
cls AS (SELECT Churn AS c, count(*) AS n FROM ml GROUP BY Churn),
quota0 AS (
  SELECT c, n, sum(n) OVER () AS total, CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n) OVER ()) AS BIGINT) AS wanted FROM cls),
quota1 AS (
  SELECT c, n, wanted, CAST(floor(CAST(wanted AS DOUBLE) * n / total) AS BIGINT) AS fl, (wanted * n) % total AS rest
  FROM quota0),
quota AS (
  SELECT c, n, fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= wanted - sum(fl) OVER () THEN 1 ELSE 0 END
    AS n_test FROM quota1),
ordered AS (
  SELECT ml.*, q.n, q.n_test,
    row_number() OVER (PARTITION BY Churn ORDER BY md5(concat('42:', customerID))) AS rk
  FROM ml JOIN quota q ON ml.Churn = q.c)"""


def _fold() -> str:
    ends = []
    for i in range(1, 5):
        ends.append(
            f"CASE WHEN rk > n_test + {i} * ((n - n_test) // 5) + least({i}, (n - n_test) % 5) THEN 1 ELSE 0 END")
    return "CAST(CASE WHEN rk > n_test THEN " + " + ".join(ends) + " END AS INTEGER)"


SPLIT_CTE = f"""{_QUOTA},
split AS (
  SELECT * EXCLUDE (n, n_test, rk), CASE WHEN rk <= n_test THEN 'test' ELSE 'train' END AS split, {_fold()} AS fold
  FROM ordered)"""

_ORDER = [
    ("raw", RAW_CTE), ("typed", TYPED_CTE), ("clean", CLEAN_CTE), ("feat", FEATURE_CTE), ("ml", ENCODED_CTE),
    ("scored", SCORED_CTE), ("predictions", PREDICTIONS_CTE)]


def over(stage: str, body: str, *extra: str) -> str:
    """``body`` with every CTE up to ``stage`` (raw, typed, clean, feat, ml, split, scored, predictions) in front."""
    parts = []
    last = "ml" if stage == "split" else stage
    for name, text in _ORDER:
        parts.append(text)
        if name == last:
            break
    if stage == "split":
        parts.append(SPLIT_CTE)
    return "WITH " + ",".join([*parts, *extra]) + "\n" + body


def melt(table: str, columns, keep: str = "", extra_where: str = "") -> str:
    """(keep, feature, value) rows of the non-null values as a UNION ALL."""
    lead = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS value FROM {table} WHERE \"{c}\" IS NOT NULL{extra_where}"
        for c in columns)
