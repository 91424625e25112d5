"""Retention by month of entry, and survival curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions.numbers import percent, round_even
from churnlake.sources.staging import written


def month_number(time: Column) -> Column:
    return F.year(time) * 12 + F.month(time) - 1


def retention(df: DataFrame, key: str, time: str) -> DataFrame:
    """cohort (first month, yyyy-MM), age (months since), customers, active and retention (percent), for every age of every cohort.

    Every month between the first and the last of the table is a cohort, and every cohort has every age up to the last month, with
    zeros where nobody is active; the percentage of an empty cohort is null. A customer counts once a month. Rows without key or
    time do not count.

    A customer's months are merged before the shuffle, into a set that is at most as long as the table has months, so a customer
    with very many rows is one row per task; the triangle is one row per pair of months.
    """
    months = df.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(F.col(key).alias("k"), month_number(F.col(time)).alias("m"))
    each = months.groupBy("k").agg(F.collect_set("m").alias("months")).select(F.array_min("months").alias("c"), F.explode("months").alias("m"))
    counted = written(each.groupBy("c", (F.col("m") - F.col("c")).alias("a")).agg(F.count(F.lit(1)).alias("active")), "cohorts")
    spine = counted.agg(F.min("c").alias("low"), F.max(F.col("c") + F.col("a")).alias("high")).where("low IS NOT NULL")
    spine = spine.select(F.explode(F.sequence("low", "high")).alias("cohort"), "high")
    spine = spine.select("cohort", F.explode(F.sequence(F.lit(0), F.col("high") - F.col("cohort"))).alias("age"))
    full = spine.join(counted, (F.col("cohort") == F.col("c")) & (F.col("age") == F.col("a")), "left")
    sizes = counted.where("a = 0").select(F.col("c").alias("s"), F.col("active").alias("size"))
    full = full.join(sizes, F.col("cohort") == F.col("s"), "left")
    year, month = F.call_function("div", F.col("cohort"), F.lit(12)), F.col("cohort") % 12 + 1
    size, active = F.coalesce("size", F.lit(0)).cast("long"), F.coalesce("active", F.lit(0)).cast("long")
    return full.select(
        F.format_string("%04d-%02d", year, month).alias("cohort"), F.col("age").cast("long").alias("age"), size.alias("customers"),
        active.alias("active"), percent(active, size).alias("retention"))


def survival(df: DataFrame, duration: str, event: str, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """by, duration, at_risk, events, censored, survival and std_error (Greenwood) of the Kaplan-Meier curve, per distinct duration.

    ``event`` is 1 where the customer left at that duration and 0 where watching ended then; who leaves at a duration is at risk
    with those whose watching ends at it. Rows with a null duration or event do not count; null ``by`` values are a group.

    One map-side aggregate by duration; the running sums go over one row per group and distinct duration, such as months, not over
    the rows of the table. The error is null where nobody is left.
    """
    groups = [F.col(f"`{c}`") for c in by]
    steps = df.where(F.col(duration).isNotNull() & F.col(event).isNotNull()).groupBy(*groups, F.col(duration).alias("duration")).agg(
        F.sum(F.col(event).cast("long")).alias("events"), F.count(F.lit(1)).alias("n"))
    later = Window.partitionBy(*groups).orderBy(F.col("duration").desc()).rowsBetween(Window.unboundedPreceding, 0)
    so_far = Window.partitionBy(*groups).orderBy("duration").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("at_risk", F.sum("n").over(later))
    left, risk = F.col("events").cast("double"), F.col("at_risk").cast("double")
    stay = F.when(F.col("events") < F.col("at_risk"), F.log(1 - left / risk))
    alive = F.min((F.col("events") < F.col("at_risk")).cast("int")).over(so_far) == 1
    steps = steps.withColumns({
        "survival": F.when(alive, F.exp(F.sum(stay).over(so_far))).otherwise(0.0),
        "_error": F.when(alive, F.sqrt(F.sum(F.try_divide(left, risk * (risk - left))).over(so_far)))})
    return steps.select(
        *groups, "duration", "at_risk", "events", (F.col("n") - F.col("events")).alias("censored"),
        round_even(F.col("survival"), digits).alias("survival"), round_even(F.col("survival") * F.col("_error"), digits).alias("std_error"))
