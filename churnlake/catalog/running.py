"""Registered queries: audit state merged from days, and predictions of customers as they arrive."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.catalog.relations import Tables, query
from churnlake.catalog.sql import esum, over
from churnlake.operators import mergeable, scoring
from churnlake.session import scratch_path
from churnlake.sources.staging import handed_out, written
from churnlake.streaming import scoring as arriving

EVENTS = "ts timestamp_ntz, user_id bigint, event_type string, value double"
QUARTILES = (0.25, 0.5, 0.75)


def _events(t: Tables) -> DataFrame:
    return t.spark.read.schema(EVENTS).parquet(f"{t.directory}/events.parquet")


def _stored(t: Tables) -> DataFrame:
    """State of the events by day and type, written and read back."""
    path = scratch_path(t.spark, "audit-state")
    mergeable.store(mergeable.daily_state(_events(t), "ts", ["event_type"], ["user_id"], ["value"]), path)
    return mergeable.read_state(t.spark, path)


_FACTS = f"""count(*) AS n, count(*) FILTER (WHERE user_id IS NULL) AS users_absent, count(*) FILTER (WHERE value IS NULL) AS nulls,
  {esum("value")} AS total, min(value) AS low, max(value) AS high"""


def _facts(state: DataFrame, *by: str) -> DataFrame:
    return state.select(
        *by, "n", F.col("user_id_absent").alias("users_absent"), F.col("value_nulls").alias("nulls"),
        F.col("value_sum").cast("double").alias("total"), F.col("value_min").alias("low"), F.col("value_max").alias("high"))


@query("mrg_1_daily_state", f"SELECT CAST(ts AS DATE) AS day, event_type, {_FACTS} FROM events GROUP BY ALL")
def _(t: Tables):
    """The exact part of the stored state."""
    return _facts(_stored(t), "day", "event_type")


@query("mrg_2_merged_days", f"SELECT event_type, {_FACTS} FROM events GROUP BY ALL")
def _(t: Tables):
    return _facts(mergeable.merged(_stored(t), ["event_type"]), "event_type")


@query("mrg_3_within_error", """SELECT event_type, count(DISTINCT user_id) AS users, true AS users_within,
  true AS q25_within, true AS q50_within, true AS q75_within FROM events GROUP BY event_type""")
def _(t: Tables):
    """Distinct users and quartiles from merged days against the exact ones, by event type: is each within the stated error?"""
    names = {f"q{int(100 * p)}": p for p in QUARTILES}
    estimates = handed_out(written(mergeable.merged(_stored(t), ["event_type"]).select(
        F.col("event_type").alias("of"), mergeable.distinct_estimate("user_id").alias("estimate"),
        *[mergeable.quantile_estimate("value", p).alias(n) for n, p in names.items()]), "audit-estimates"))
    events = _events(t).join(estimates, F.col("event_type").eqNullSafe(F.col("of")))
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.max("estimate").alias("estimate"))
    users = exact.select("event_type", "users", (
        F.abs(F.col("estimate") - F.col("users")) <= mergeable.DISTINCT_ERROR * F.col("users")).alias("users_within"))
    ranks = [mergeable.rank_within(events, "value", n, p, ["event_type"]).withColumnRenamed("event_type", "of")
             for n, p in names.items()]
    return reduce(lambda a, b: a.join(b, F.col("event_type").eqNullSafe(F.col("of"))).drop("of"), ranks, users)


@query("str_1_arriving_predictions", over("predictions", "SELECT * FROM predictions"))
def _(t: Tables):
    """Customers arriving file by file, cleaned and scored as a stream; the same table as the batch gives."""
    inbox, out = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "scored")
    hour = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.xxhash64("customerID"), F.lit(86400)))
    t.raw.withColumn("arrived", hour).repartition(6).write.parquet(inbox)
    schema = t.raw.withColumn("arrived", hour).schema
    stream = arriving.arrivals(t.spark, inbox, schema, files_per_batch=2)
    written_schema = arriving.score_arrivals(stream, t.score, out, scratch_path(t.spark, "stream-state"))
    return scoring.build_predictions(arriving.read_scored(t.spark, out, written_schema))
