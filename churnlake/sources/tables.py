"""Readers, and the customer view derived from order history."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake import spec as S


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw customer file with a declared schema, so blank totals stay text."""
    try:
        return spark.read.schema(S.RAW_SCHEMA).option("header", True).csv(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no customer file at {path}: export the raw table there first") from error


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table written by one of the sinks."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no table at {path}: run the stage that writes it first") from error


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One side of the train/test table; the partition column prunes the files of the other."""
    return read_table(spark, path).where(F.col("split") == split)


# Declared, so that no job has to read file footers first.
CUSTOMER_COLUMNS = "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string"
ORDER_COLUMNS = "o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"


def _yes_if(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Yes' ELSE 'No' END"


def _add_on(condition: str) -> str:
    return f"CASE WHEN n % 3 = 2 THEN 'No internet service' WHEN {condition} THEN 'Yes' ELSE 'No' END"


# How each raw column follows from the customer key (k), nation (n), balance (bal), market
# segment (seg), order count (made), order value in cents (spend) and months since the last order (idle).
DERIVED_COLUMNS = {
    "customerID": "CAST(k AS STRING)",
    "gender": "CASE WHEN k % 2 = 0 THEN 'Female' ELSE 'Male' END",
    "SeniorCitizen": "CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END",
    "Partner": _yes_if("n % 2 = 0"),
    "Dependents": _yes_if("n % 3 = 0"),
    "tenure": "CAST(CASE WHEN made <= 3 THEN 0 ELSE made * 4 END AS INT)",
    "PhoneService": "CASE WHEN k % 10 = 3 THEN 'No' ELSE 'Yes' END",
    "MultipleLines": "CASE WHEN k % 10 = 3 THEN 'No phone service' WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END",
    "InternetService": "CASE n % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END",
    "OnlineSecurity": _add_on("k % 4 = 1"),
    "OnlineBackup": _add_on("k % 5 < 2"),
    "DeviceProtection": _add_on("k % 6 < 2"),
    "TechSupport": _add_on("k % 7 < 2"),
    "StreamingTV": _add_on("k % 8 < 3"),
    "StreamingMovies": _add_on("k % 9 < 4"),
    "Contract": "CASE seg WHEN 'AUTOMOBILE' THEN 'One year' WHEN 'FURNITURE' THEN 'Two year' ELSE 'Month-to-month' END",
    "PaperlessBilling": _yes_if("k % 5 < 3"),
    "PaymentMethod": "concat(CASE k % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'"
                     " WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END,"
                     " CASE WHEN k % 11 = 0 THEN ' ' ELSE '' END)",
    "MonthlyCharges": "floor(abs(bal) / 80 * 100 + 0.5D) / 100",
    "TotalCharges": "CASE WHEN made <= 3 THEN ' ' ELSE CAST(CAST(CAST(spend AS DECIMAL(20,0)) / 100000 AS DECIMAL(18,2)) AS STRING) END",
    "Churn": _yes_if("idle IS NULL OR idle >= 11"),
}


def customers_from_orders(spark: SparkSession, directory: str, until: str | None = None) -> DataFrame:
    """The raw customer table, derived from ``customer`` and ``orders`` (those before the date ``until``, if given).

    Order history is reduced to one row per customer before the join, so a customer with very many
    orders is already one row when it is shuffled. Every fiftieth customer appears twice, which gives
    the de-duplication operators something to remove; no customer is left out. Order values are summed as
    whole cents, which is exact and keeps the aggregation buffer a plain long.
    """
    customer = spark.read.schema(CUSTOMER_COLUMNS).parquet(f"{directory}/customer.parquet")
    made = spark.read.schema(ORDER_COLUMNS).parquet(f"{directory}/orders.parquet")
    if until is not None:
        made = made.where(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
    orders = made.selectExpr(
        "o_custkey AS k", "CAST(rint(o_totalprice * 100) AS BIGINT) AS cents",
        "year(o_orderdate) * 12 + month(o_orderdate) AS month")
    history = orders.groupBy("k").agg(
        F.expr("count(1) AS made"), F.expr("sum(cents) AS spend"), F.expr("max(month) AS last_month"))
    snapshot = orders.agg(F.max("month")).scalar()
    return (
        customer.selectExpr("c_custkey AS k", "c_nationkey AS n", "c_acctbal AS bal", "c_mktsegment AS seg")
        .join(history, "k", "left")
        .select("k", "n", "bal", "seg", "spend", F.expr("coalesce(made, 0) AS made"),
                (snapshot - F.col("last_month")).alias("idle"))
        .selectExpr(
            *[f"{expression} AS {name}" for name, expression in DERIVED_COLUMNS.items()],
            "explode(array_repeat(1, CASE WHEN k % 50 = 0 THEN 2 ELSE 1 END)) AS copy")
        .drop("copy")
    )
