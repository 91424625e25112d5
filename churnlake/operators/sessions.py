"""Gaps and islands: runs of rows of a key that follow each other closely."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions.times import micros
from churnlake.operators import timeslices

_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def islands(df: DataFrame, keys: Sequence[str], time: str, gap: int, measures: Mapping[str, tuple[str, str]] = {},
            target: int = timeslices.TARGET) -> DataFrame:
    """keys, start, end, n_rows, idle and the measures of every island: a row more than ``gap`` (microseconds, or the unit
    of a whole number) after the one before it begins a new one.

    ``idle`` is the time since the key's island before, null for its first. ``measures`` maps a name to (sum, count, min or max;
    column); sums go through DECIMAL. A null key is a key of its own; rows without a time belong to no island.

    The rows are shuffled once, by key and time slice; only a hot key has more than one slice. Islands that lie inside a slice
    are done there. The first and the last of each slice of a hot key, two rows per slice, are merged in a second step.
    """
    keys = list(keys)
    first = {"sum": lambda c: F.sum(c.cast("decimal(28,4)")), "count": F.count, "min": F.min, "max": F.max}
    rows = df.where(F.col(f"`{time}`").isNotNull())
    rows = rows.withColumn("_t", micros(rows, time))
    placed = timeslices.sliced(rows, timeslices.hot_keys(rows, keys, "_t", target), keys, "_t")

    slice_ = Window.partitionBy(*keys, "_slice")
    after = F.col("_t") - F.lag("_t").over(slice_.orderBy("_t"))
    placed = placed.withColumn("_new", F.when(after <= gap, 0).otherwise(1))
    placed = placed.withColumn("_no", F.sum("_new").over(slice_.orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)))
    pieces = placed.groupBy(*keys, "_slice", "_no").agg(
        F.min(time).alias("start"), F.max(time).alias("end"), F.min("_t").alias("_low"), F.max("_t").alias("_high"),
        F.count(F.lit(1)).alias("n_rows"), F.first("_hot").alias("_hot"),
        *[first[kind](F.col(f"`{c}`")).alias(name) for name, (kind, c) in measures.items()])
    pieces = pieces.withColumns({
        "idle": F.col("_low") - F.lag("_high").over(slice_.orderBy("_no")),
        "_border": F.col("_hot") & ((F.col("_no") == 1) | (F.col("_no") == F.max("_no").over(slice_)))})
    pieces = timeslices.written(pieces, "islands")

    key = Window.partitionBy(*keys).orderBy("_low", "_slice", "_no")  # two rows for each slice of a hot key
    since = F.col("_low") - F.lag("_high").over(key)
    borders = pieces.where("_border").withColumns({
        "idle": F.coalesce("idle", since), "_new": F.when(since <= gap, 0).otherwise(1)})
    borders = borders.withColumn("_no", F.sum("_new").over(key.rowsBetween(Window.unboundedPreceding, 0)))
    merged = borders.groupBy(*keys, "_no").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_rows").alias("n_rows"), F.min_by("idle", "_low").alias("idle"),
        *[_MERGE[kind](name).alias(name) for name, (kind, _) in measures.items()])
    columns = [*keys, "start", "end", "n_rows", "idle", *measures]
    done = pieces.where("NOT _border").select(*columns).unionByName(merged.select(*columns))
    return done.withColumns({name: F.col(name).cast("double") for name, (kind, _) in measures.items() if kind == "sum"})
