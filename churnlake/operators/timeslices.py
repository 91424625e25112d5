"""Time slices of hot keys, so that ordered work on one key spreads over many tasks.

Keys with at most ``target`` rows are one slice. The others are cut at quantiles of their own times, from a bounded sketch;
the number of cuts follows the rows of the hottest key. Equal times are never cut apart, and a wrong sketch only makes slices
uneven. What goes from a slice to the next (a last value, an open session) is a table of one or two rows per slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.sources.staging import handed_out, written

TARGET, MOST_SLICES = 200_000, 1_000


def same(keys: Sequence[str], prefix: str = "_h") -> Column:
    """Null-safe equality of the keys with their copies under other names."""
    return reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)])


def renamed(keys: Sequence[str], prefix: str = "_h") -> list[Column]:
    return [F.col(f"`{k}`").alias(f"{prefix}{i}") for i, k in enumerate(keys)]


def hot_keys(df: DataFrame, keys: Sequence[str], time: str, target: int = TARGET) -> DataFrame:
    """_h0, ... (keys) and their cut times, of the keys with more than ``target`` rows; written."""
    counted = written(df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target)
                      .select(*renamed(keys), "_n"), "hot-keys")
    most = counted.agg(F.max("_n")).first()[0]
    if most is None:
        return counted.select(*[f"_h{i}" for i in range(len(keys))], F.array().cast("array<bigint>").alias("_cuts"))
    parts = min(MOST_SLICES, -(-most // target) + 1)
    shares = [k / parts for k in range(1, parts)]
    hot = df.join(handed_out(counted), same(keys)).groupBy(*[f"_h{i}" for i in range(len(keys))]).agg(
        F.array_distinct(F.percentile_approx(time, shares, 10 * parts)).alias("_cuts"))
    return written(hot, "hot-cuts")


def sliced(df: DataFrame, hot: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """``df`` with ``_slice`` (0 for keys that are not hot) and ``_hot``."""
    marked = df.join(handed_out(hot), same(keys), "left")
    below = F.size(F.filter("_cuts", lambda c: c < F.col(time)))
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], F.when(F.col("_cuts").isNull(), 0).otherwise(below).alias("_slice"),
                         F.col("_cuts").isNotNull().alias("_hot"))
