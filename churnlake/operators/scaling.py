"""Z-scores with parameters fitted on the training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake import spec as S
from churnlake.functions.numbers import exact_mean


def fit_scaler(train: DataFrame, columns: Sequence[str] = S.SCALED) -> DataFrame:
    """Parameter table (feature, mean, scale); population deviation, 1 for a constant column."""
    present = [c for c in columns if c in train.columns]
    if not present:
        return train.sparkSession.createDataFrame([], "feature string, mean double, scale double")
    aggregates = []
    for i, c in enumerate(present):
        value = F.col(f"`{c}`").cast("double")
        aggregates += [exact_mean(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"),
            F.when(F.col(f"s{i}") > 0, F.col(f"s{i}")).otherwise(F.lit(1.0)).alias("scale"))
        for i, c in enumerate(present)
    ])
    return train.agg(*aggregates).select(F.inline(rows))


def apply_scaler(df: DataFrame, parameters: DataFrame) -> DataFrame:
    """Standardise the fitted columns. The parameters, one row per column, become literals of the plan."""
    fitted = {r.feature: (r["mean"], r["scale"]) for r in parameters.collect() if r.feature in df.columns}
    if not fitted:
        return df
    return df.withColumns({
        c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(scale)
        for c, (mean, scale) in fitted.items()
    })
