"""Interval join: pairs of rows whose intervals overlap, by bins instead of a comparison of all with all."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.times import micros

#: A level's bins are this many times as wide as those of the level below.
STEP = 4


def interval_join(
    left: DataFrame, right: DataFrame, left_interval: tuple[str, str], right_interval: tuple[str, str],
    on: Sequence[tuple[str, str]] = (), accuracy: int = 1000,
) -> DataFrame:
    """Struct columns ``l`` and ``r`` of every pair of the same key whose intervals, ends included, share a point.

    Every interval has the level whose bins are the first that are at least as wide as it is; it lies in at most two bins of that
    level and of every wider one. The narrowest bins are as wide as the median interval, from a sketch, so that a wrong sketch
    costs work but loses nothing. A pair is sought on the wider of its two levels only, so short intervals never meet each other
    in the wide bins that long ones need, and it is emitted in the first bin that both lie in: each pair once.

    Intervals that end before they begin or have a null bound, and null keys, match nothing. Equal rows count one by one.
    """
    keys = [f"_k{i}" for i in range(len(on))]

    def bounded(df: DataFrame, names: tuple[str, str], columns: Sequence[str], as_: str) -> DataFrame:
        out = df.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(keys, columns)], micros(df, names[0]).alias("_a"),
                        micros(df, names[1]).alias("_b"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(as_))
        return out.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys], F.col("_a") <= F.col("_b")))

    one, two = bounded(left, left_interval, [a for a, _ in on], "l"), bounded(right, right_interval, [b for _, b in on], "r")
    lengths = one.select((F.col("_b") - F.col("_a")).alias("n")).unionByName(two.select((F.col("_b") - F.col("_a")).alias("n")))
    middle, longest = lengths.agg(F.percentile_approx("n", 0.5, accuracy), F.max("n")).first()
    width = max(1, (middle or 0) + 1)
    widths = [width]
    while widths[-1] < (longest or 0) + 1:
        widths.append(widths[-1] * STEP)
    if widths[-1] >= 1 << 62:
        raise ValueError("intervals are too long for 64-bit bins")

    level = F.lit(len(widths) - 1)
    for k in range(len(widths) - 2, -1, -1):
        level = F.when(F.col("_b") - F.col("_a") < widths[k], k).otherwise(level)
    bin_width = F.element_at(F.array(*[F.lit(w).cast("long") for w in widths]), F.col("_level") + 1)

    def binned(df: DataFrame, from_level: Column) -> DataFrame:
        last = F.lit(len(widths) - 1)
        spread = df.select("*", F.explode(F.when(from_level <= last, F.sequence(from_level, last))).alias("_level"))
        low, high = _floor(F.col("_a"), bin_width), _floor(F.col("_b"), bin_width)
        return spread.select("*", low.alias("_first"), F.explode(F.sequence(low, high)).alias("_bin"))

    one, two = one.withColumn("_own", level), two.withColumn("_own", level)

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.select(*[F.col(k).alias(f"{k}r") for k in keys], F.col("_level").alias("_levelr"), F.col("_bin").alias("_binr"),
                     F.col("_first").alias("_firstr"), F.col("_a").alias("_ar"), F.col("_b").alias("_br"), "r")
        equal = [F.col(c) == F.col(f"{c}r") for c in (*keys, "_level", "_bin")]
        once = F.col("_bin") == F.greatest("_first", "_firstr")
        return a.join(b, reduce(Column.__and__, equal) & once & (F.col("_a") <= F.col("_br")) & (F.col("_ar") <= F.col("_b"))).select("l", "r")

    # the left interval is the longer one or of the same level; then the right one is of a higher level
    same_or_left = met(binned(one, F.col("_own")).where("_level = _own"), binned(two, F.col("_own")))
    right_longer = met(binned(one, F.col("_own") + 1), binned(two, F.col("_own")).where("_level = _own"))
    return same_or_left.unionByName(right_longer)


def _floor(value: Column, width: Column) -> Column:
    """Whole-number division rounded down, for negative values too."""
    return F.call_function("div", value - F.pmod(value, width), width)
