"""Data-quality reports and named checks, as long-format tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake import spec as S
from churnlake.functions.numbers import percent


def _melt(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """A one-row table of aggregates as (name, value) rows."""
    return row.unpivot([], list(columns), name, value)


def shape(df: DataFrame) -> DataFrame:
    """Row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> DataFrame:
    """Type and number of non-null values per column, in one scan."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return _melt(counts, df.columns, "column", "non_null").withColumn("dtype", types[F.col("column")])


def type_counts(df: DataFrame) -> DataFrame:
    """How many columns, and how many non-null cells, there are of each type."""
    return column_types(df).groupBy("dtype").agg(
        F.count(F.lit(1)).alias("n_columns"), F.sum("non_null").alias("non_null"))


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with nulls: how many and what percentage. One scan for all columns."""
    one = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    return (
        one.unpivot(["n_rows"], list(df.columns), "column", "nulls")
        .where(F.col("nulls") > 0)
        .select("column", "nulls", percent(F.col("nulls"), F.col("n_rows")).alias("null_pct"))
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row; nulls compare equal."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Distinct non-null values per column.

    The exact form reduces (column, value) pairs on the map side before the shuffle; ``exact=False``
    uses sketches and shuffles one row per task.
    """
    names = list(columns or df.columns)
    count = F.count_distinct if exact else F.approx_count_distinct
    one = df.agg(*[count(F.col(f"`{c}`")).alias(c) for c in names])
    return _melt(one, names, "column", "distinct_values")


def target_distribution(df: DataFrame, target: str = "Churn") -> DataFrame:
    """Rows and percentage per target value. The total comes from the grouped table, so the data are read once."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("pct", percent(F.col("n_rows"), total))


def duplicate_keys(df: DataFrame, key: str = "customerID") -> DataFrame:
    """Rows whose key was seen before; a null key counts as one value."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_keys"))


def blank_total_rule(typed: DataFrame) -> DataFrame:
    """Does every row without TotalCharges belong to a customer in month 0?"""
    return typed.where(F.col("TotalCharges").isNull()).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.bool_and(F.coalesce(F.col("tenure") == 0, F.lit(False))), F.lit(True)).alias("all_tenure_zero"),
    )


def blank_total_sample(typed: DataFrame, rows: int = 5) -> DataFrame:
    """The first few of those rows by key."""
    return (
        typed.where(F.col("TotalCharges").isNull())
        .select("customerID", "tenure", "MonthlyCharges", "TotalCharges")
        .orderBy("customerID").limit(rows)
    )


def _checks(one: DataFrame, names: Sequence[str]) -> DataFrame:
    return _melt(one.select(*names), names, "check", "passed")


def validate_clean(df: DataFrame, min_rows: int = 7000, min_columns: int = 22) -> DataFrame:
    """Six named checks on the clean table.

    Everything but the key check is one aggregate without a shuffle of rows; the key check merges equal
    keys on the map side.
    """
    no_nulls = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in df.columns])
    facts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(F.coalesce(F.col("customerID"), F.lit(""))).alias("keys"),
        F.count_if(~no_nulls).alias("rows_with_null"),
        F.count_if(~F.coalesce(F.col("Churn").isin(0, 1), F.lit(False))).alias("bad_target"),
    )
    is_double = isinstance(df.schema["TotalCharges"].dataType, T.DoubleType)
    checks = {
        "no_nulls": F.col("rows_with_null") == 0,
        "unique_key": F.col("keys") == F.col("n"),
        "total_charges_is_double": F.lit(is_double),
        "target_is_0_or_1": F.col("bad_target") == 0,
        "enough_rows": F.col("n") >= min_rows,
        "enough_columns": F.lit(len(df.columns) >= min_columns),
    }
    return _checks(facts.select(*[c.alias(n) for n, c in checks.items()]), list(checks))


def validate_predictions(predictions: DataFrame) -> DataFrame:
    """Named checks on the scored table, plus the range of the rank; one aggregate."""
    core = ["customerID", "PredictedChurn", "ChurnProbability", "RiskCategory", "RiskScore", "PriorityRank"]
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in core])

    def violations(condition: Column) -> Column:
        return F.count_if(~F.coalesce(condition, F.lit(False))) == 0

    facts = predictions.agg(
        violations(complete).alias("no_nulls_in_core_cols"),
        violations(F.col("ChurnProbability").between(0.0, 1.0)).alias("probabilities_in_0_1"),
        violations(F.col("RiskScore").between(1, 100)).alias("risk_score_in_1_100"),
        violations(F.col("RiskCategory").isin(*S.TIERS)).alias("valid_risk_categories"),
        violations((F.col("PredictedChurn") != 0) | (F.col("RevenueAtRisk") == 0)).alias(
            "revenue_zero_for_non_churners"),
        F.coalesce(
            (F.min("PriorityRank") >= 1) & (F.max("PriorityRank") <= F.count(F.lit(1))), F.lit(True)
        ).alias("rank_in_1_n"),
    )
    return _checks(facts, facts.columns)


def all_passed(checks: DataFrame) -> bool:
    """One row to the driver: did every check pass?"""
    return bool(checks.agg(F.bool_and("passed")).first()[0])


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, sorted by value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(column)


def overview(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Shape, types, nulls, duplicates and moments as (section, item, metric, value) rows.

    ``stats`` is the output of ``distributions.describe``.
    """
    def rows(part: DataFrame, section: str, item: Column, metrics: Sequence[str]) -> DataFrame:
        casted = part.select(item.alias("item"), *[F.col(m).cast("double").alias(m) for m in metrics])
        return casted.unpivot(["item"], list(metrics), "metric", "value").select(
            F.lit(section).alias("section"), "item", "metric", "value")

    parts = [
        rows(shape(df), "shape", F.lit("table"), ["n_rows", "n_columns"]),
        rows(type_counts(df), "types", F.col("dtype"), ["n_columns"]),
        rows(null_counts(df), "nulls", F.col("column"), ["nulls", "null_pct"]),
        rows(duplicate_rows(df), "duplicates", F.lit("table"), ["duplicate_rows"]),
        rows(stats, "stats", F.col("feature"), [c for c in stats.columns if c != "feature"]),
    ]
    return reduce(DataFrame.unionByName, parts)
