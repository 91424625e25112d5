"""Ranks and running counts over scores without a single-task sort of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def priority_rank(df: DataFrame, probability: str = "ChurnProbability", rank: str = "PriorityRank", digits: int = 4) -> DataFrame:
    """Min-rank by a probability rounded to ``digits`` places, highest first.

    Rounding leaves at most 10 ** digits + 1 distinct values. They are counted, ranked as a small table and
    broadcast back, so the table itself is neither sorted nor shuffled.
    """
    if digits > 5:
        raise ValueError("the broadcast rank table is only small up to 5 digits")
    step = F.rint(F.col(probability) * float(10 ** digits)).cast("int")
    counts = df.where(step.isNotNull()).groupBy(step.alias("_step")).agg(F.count(F.lit(1)).alias("_n"))
    above = Window.orderBy(F.col("_step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    table = counts.select("_step", (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias(rank))
    return df.withColumn("_key", step).join(
        F.broadcast(table), F.col("_key") == F.col("_step"), "left").drop("_key", "_step")


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, merged on the map side."""
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )


def _rank_bucket(df: DataFrame, value: str, cuts: str, depth: int, bucket: str) -> DataFrame:
    """Number of ``cuts`` (an ascending array of 2 ** depth - 1 values) below ``value``, by bisection.

    One projection per level keeps each expression small; Spark compiles them into one stage.
    """
    result = df.withColumn(bucket, F.lit(0))
    for level in reversed(range(depth)):
        step = 2 ** level
        below = F.get(cuts, F.col(bucket) + (step - 1)) < F.col(value)
        result = result.withColumn(bucket, F.col(bucket) + F.when(below, step).otherwise(0))
    return result


def cumulative_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = (), depth: int = 8) -> DataFrame:
    """(by..., score, pos, neg, pos_above, neg_above): counts at and strictly above each distinct score.

    A sketch cuts each group into 2 ** depth score intervals of about equally many rows, however the scores
    are concentrated; equal scores are merged before they are ordered. The running sum restarts in every
    interval, and the counts above an interval, at most 2 ** depth rows per group, are broadcast and added.
    The cuts only balance the work: any cuts give the same result.
    """
    buckets = 2 ** depth
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    cut = F.percentile_approx(F.col(score), [i / buckets for i in range(1, buckets)], 20 * buckets)
    counts = score_counts(df, score, label, by)
    if by:
        cuts = known.groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(cut.alias("_cuts"))
        same = F.lit(True)
        for k in by:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        placed = counts.join(F.broadcast(cuts), same).drop(*[f"_{k}" for k in by])
    else:
        placed = counts.withColumn("_cuts", known.agg(cut).scalar())
    placed = _rank_bucket(placed, "score", "_cuts", depth, "bucket").drop("_cuts")

    totals = placed.groupBy(*by, "bucket").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    higher = Window.partitionBy(*by).orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_{k}") for k in by], F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("p").over(higher), F.lit(0)).alias("_pos"),
        F.coalesce(F.sum("q").over(higher), F.lit(0)).alias("_neg"),
    )
    inside = Window.partitionBy(*by, "bucket").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({
        "above_p": F.coalesce(F.sum("pos").over(inside), F.lit(0)),
        "above_n": F.coalesce(F.sum("neg").over(inside), F.lit(0)),
    })
    same = F.col("bucket") == F.col("_bucket")
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return local.join(F.broadcast(offsets), same).select(
        *by, "score", "pos", "neg",
        (F.col("above_p") + F.col("_pos")).alias("pos_above"),
        (F.col("above_n") + F.col("_neg")).alias("neg_above"),
    )
