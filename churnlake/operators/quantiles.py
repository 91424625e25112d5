"""Exact linear-interpolation quantiles without sorting or collecting a whole column.

Spark's ``percentile`` keeps every distinct value of a group in one task. Here a bounded sketch only says
where to look: it gives a narrow bracket around each wanted rank, one counting pass says how many values
lie below and inside the bracket, and only the values inside it are ordered. The sketch cannot make the
result wrong: where a bracket misses its rank, the side of it that does hold the rank is ordered instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, value) rows of the non-null values."""
    return (
        df.select(*by, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
        .unpivot(list(by), list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
    by: Sequence[str] = (), accuracy: int = 10_000,
) -> DataFrame:
    """(by..., feature, prob, quantile); ``by`` are columns with few values, such as the target.

    The bracket tables have one row per group, feature and probability, which is what makes it safe to
    broadcast them.
    """
    if not probabilities:
        raise ValueError("no probabilities given")
    values = long_values(df, columns, by)
    keys = [*by, "feature"]
    probs = [float(p) for p in probabilities]
    margin = 2.0 / accuracy
    lows = [max(p - margin, 0.0) for p in probs]
    highs = [min(p + margin, 1.0) for p in probs]

    sketch = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("value", lows + highs, accuracy).alias("cut"),
    )
    cuts = sketch.select(
        *keys, "n",
        F.posexplode(F.array(*[F.lit(p) for p in probs])).alias("pos", "prob"), "cut",
    ).select(
        *keys, "n", "prob",
        F.get("cut", F.col("pos")).alias("low"),
        F.get("cut", F.col("pos") + len(probs)).alias("high"),
    )

    counted = (
        _match(values, cuts, keys)
        .groupBy(*keys, "prob", "n", "low", "high")
        .agg(
            F.count_if(F.col("value") < F.col("low")).alias("below"),
            F.count_if(F.col("value") <= F.col("high")).alias("upto"),
        )
    )
    position = (F.col("n") - 1) * F.col("prob")
    first = F.col("first")
    second = F.col("second")
    low_holds = F.col("below") <= first
    high_holds = second < F.col("upto")
    brackets = counted.select(
        *keys, "prob", "low", "high", "below", "upto",
        F.floor(position).alias("first"),
        F.least(F.floor(position) + 1, F.col("n") - 1).alias("second"),
        (position - F.floor(position)).alias("fraction"),
    ).select(
        *keys, "prob", "first", "second", "fraction",
        F.when(low_holds, F.col("low")).otherwise(F.lit(float("-inf"))).alias("from_value"),
        F.when(high_holds, F.col("high")).otherwise(F.lit(float("inf"))).alias("to_value"),
        F.when(low_holds, F.col("below")).otherwise(F.lit(0)).alias("base"),
    )

    candidates = (
        _match(values, brackets, keys)
        .where(F.col("value").between(F.col("from_value"), F.col("to_value")))
        .groupBy(*keys, "prob", "first", "second", "fraction", "base", "value")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    running = Window.partitionBy(*keys, "prob").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = candidates.withColumn("reached", F.col("base") + F.sum("copies").over(running))
    at = placed.groupBy(*keys, "prob", "fraction").agg(
        F.min(F.when(F.col("reached") > first, F.col("value"))).alias("a"),
        F.min(F.when(F.col("reached") > second, F.col("value"))).alias("b"),
    )
    return at.select(*keys, "prob", (F.col("a") + (F.col("b") - F.col("a")) * F.col("fraction")).alias("quantile"))


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
    by: Sequence[str] = (), accuracy: int = 10_000,
) -> DataFrame:
    """Same shape from one sketch pass; values are data points, not interpolated."""
    probs = [float(p) for p in probabilities]
    keys = [*by, "feature"]
    return (
        long_values(df, columns, by).groupBy(*keys)
        .agg(F.percentile_approx("value", probs, accuracy).alias("q"))
        .select(*keys, F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), "q")).alias("z"))
        .select(*keys, F.col("z.prob").alias("prob"), F.col("z.q").alias("quantile"))
    )


def quartiles(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """(by..., feature, q1, median, q3)."""
    method = exact_quantiles if exact else approximate_quantiles
    found = method(df, columns, [0.25, 0.5, 0.75], by)

    def pick(p):
        return F.max(F.when(F.col("prob") == p, F.col("quantile")))

    return found.groupBy(*by, "feature").agg(
        pick(0.25).alias("q1"), pick(0.5).alias("median"), pick(0.75).alias("q3"))


def _match(values: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the rows of a small per-group table; null group values match each other."""
    small = F.broadcast(table.withColumnsRenamed({k: f"_{k}" for k in keys}))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return values.join(small, condition).drop(*[f"_{k}" for k in keys])
