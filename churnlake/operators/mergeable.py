"""Audit state that merges: sketches and sums by day and segment, written once a day and combined on reading.

A state row holds, for its day and segment, the number of rows, for each audited column the number of nulls, and either a
HyperLogLog sketch of its values or a KLL sketch with exact sum, minimum and maximum. Any days and segments merge without
the rows behind them. Distinct counts have a standard error of ``1.04 / sqrt(2 ** LG_K)`` (1.6 %), three of which are the stated
bound; quantiles have a rank within ``RANK_ERROR`` of the asked one. Counts, sums and extremes are exact.

Defined results: NaN counts as null; a null day or segment is a group of its own; a column that is null throughout has 0
distinct values and null quantiles; repeated rows count as often as they occur; an empty table gives no state rows. Sketches are
built on the map side, so a hot segment arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K, KLL_K = 12, 400
RANK_ERROR = 0.02
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)


def _value(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def daily_state(df: DataFrame, at: str, segments: Sequence[str], distinct: Sequence[str] = (), numeric: Sequence[str] = ()) -> DataFrame:
    """One row per day of ``at`` and segment."""
    measures = [F.count(F.lit(1)).alias("n")]
    for c in distinct:
        text = F.col(f"`{c}`").cast("string")
        measures += [F.count_if(text.isNull()).alias(f"{c}_absent"), F.hll_sketch_agg(text, LG_K).alias(f"{c}_hll")]
    for c in numeric:
        measures += [
            F.count_if(_value(c).isNull()).alias(f"{c}_nulls"), F.sum(_value(c).cast("decimal(18,4)")).alias(f"{c}_sum"),
            F.min(_value(c)).alias(f"{c}_min"), F.max(_value(c)).alias(f"{c}_max"),
            F.kll_sketch_agg_double(_value(c), KLL_K).alias(f"{c}_kll")]
    return df.groupBy(F.to_date(F.col(f"`{at}`")).alias("day"), *[F.col(f"`{s}`") for s in segments]).agg(*measures)


def store(state: DataFrame, path: str) -> None:
    """Write state by day. The days that are written replace what was there for them, so a repeated day does not count twice."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """State of ``by`` (any of day and segments, or nothing) from the state of its parts."""
    ways = {"_absent": F.sum, "_nulls": F.sum, "_sum": F.sum, "_min": F.min, "_max": F.max,
            "_hll": F.hll_union_agg, "_kll": lambda c: F.kll_merge_agg_double(c, KLL_K)}
    measures = [F.sum("n").alias("n")]
    sketches = {c[:-4] for c in state.columns if c.endswith(("_hll", "_kll"))}
    for c in state.columns:
        name, _, kind = c.rpartition("_")
        if name in sketches and f"_{kind}" in ways:
            measures.append(ways[f"_{kind}"](F.col(f"`{c}`")).alias(c))
    return state.groupBy(*[F.col(f"`{b}`") for b in by]).agg(*measures)


def distinct_estimate(name: str) -> Column:
    return F.hll_sketch_estimate(F.col(f"`{name}_hll`"))


def quantile_estimate(name: str, p: float) -> Column:
    """Null where no value was seen; the extremes are exact."""
    sketch = F.col(f"`{name}_kll`")
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))))


def rank_within(values: DataFrame, name: str, estimate: str, p: float, by: Sequence[str], error: float = RANK_ERROR) -> DataFrame:
    """For each group, whether the true ranks of ``estimate`` among the values reach ``p`` within ``error``. One pass."""
    x = _value(name)
    known, below, upto = F.count(x), F.count_if(x < F.col(estimate)), F.count_if(x <= F.col(estimate))
    return values.groupBy(*by).agg(F.coalesce(
        (below <= (p + error) * known) & (upto >= (p - error) * known), F.lit(False)).alias(f"{estimate}_within"))
