"""As-of join: each row with the latest row of another table at or before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions.times import micros
from churnlake.operators import timeslices
from churnlake.sources.staging import handed_out


def asof_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_time: str, right_time: str,
    take: Sequence[str], ties: Sequence[str] = (), strict: bool = False, within: int | None = None,
    target: int = timeslices.TARGET,
) -> DataFrame:
    """All rows of ``left`` with the columns ``take`` of the latest row of ``right`` of the same key, null if there is none.

    At or before the left row's time, before it with ``strict``; not older than ``within`` microseconds if given. Of rows of one
    time that with the greatest ``ties`` counts. Null keys match nothing, rows without a time neither.

    Both tables are put in one, sorted by key and time, and the last value is carried along: no pair is formed, so that a key
    with many rows on both sides costs what it holds. Hot keys are cut into time slices; the last right row of each slice,
    one row per slice, is carried into the slices after it.
    """
    clash = set(take) & set(left.columns)
    if clash:
        raise ValueError(f"columns of both tables: {', '.join(sorted(clash))}")
    keys = [f"_k{i}" for i in range(len(on))]
    taken = F.struct(*[F.col(f"`{c}`") for c in take])
    tie = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in ties])
    rows = left.select(*[F.col(f"`{a}`").alias(k) for k, (a, _) in zip(keys, on)], micros(left, left_time).alias("_t"),
                       F.lit(1).alias("_side"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"))
    offered = right.select(*[F.col(f"`{b}`").alias(k) for k, (_, b) in zip(keys, on)], micros(right, right_time).alias("_t"),
                           F.lit(2 if strict else 0).alias("_side"), tie.alias("_tie"), taken.alias("_right"))
    known = F.col("_t").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    offered = offered.where(known)
    both = rows.where(known).unionByName(offered, allowMissingColumns=True)
    hot = timeslices.hot_keys(both, keys, "_t", target)

    placed = timeslices.sliced(both, hot, keys, "_t")
    so_far = Window.partitionBy(*keys, "_slice").orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    latest = F.struct("_t", "_right")
    found = placed.withColumn("_last", F.last(F.when(F.col("_right").isNotNull(), latest), ignorenulls=True).over(so_far))
    found = found.where("_side = 1").join(handed_out(_carried(offered, hot, keys)), timeslices.same([*keys, "_slice"], "_c"), "left")
    found = found.withColumn("_last", F.coalesce("_last", "_carry"))
    if within is not None:
        found = found.withColumn("_last", F.when(F.col("_t") - F.col("_last._t") <= within, F.col("_last")))
    unknown = rows.where(~known).select("_left", F.lit(None).cast(found.schema["_last"].dataType).alias("_last"))
    done = found.select("_left", "_last").unionByName(unknown)
    return done.select("_left.*", *[F.col(f"_last._right.`{c}`").alias(c) for c in take])


def _carried(offered: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """_c0, ... (keys, slice) and the last right row before the slice, for every slice of the hot keys; written."""
    copies = [f"_h{i}" for i in range(len(keys))]
    spine = hot.select(*copies, F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_s"))
    ends = timeslices.sliced(offered.join(handed_out(hot.select(*copies)), timeslices.same(keys), "left_semi"), hot, keys, "_t")
    ends = ends.groupBy(*keys, "_slice").agg(F.max_by(F.struct("_t", "_right"), F.struct("_t", "_tie")).alias("_end"))
    before = Window.partitionBy(*copies).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    matched = spine.join(ends, timeslices.same(keys) & (F.col("_slice") == F.col("_s")), "left")
    names = [F.col(c).alias(f"_c{i}") for i, c in enumerate([*copies, "_s"])]
    return timeslices.written(matched.withColumn("_carry", F.last("_end", ignorenulls=True).over(before)).select(*names, "_carry"), "asof-carry")
