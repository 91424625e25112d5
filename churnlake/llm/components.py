"""Connected components of a table of links, by the smallest key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import staged


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """key, comp for every key that occurs in a link.

    Every round a key takes the smallest label among its neighbours (combined before the shuffle, so that a key with very
    many neighbours is no problem), and then the label of its label, which halves the way. Rounds are written and read
    back; they end when no label changes.
    """
    ways = staged(
        links.select(F.col(first).alias("x"), F.col(second).alias("y"))
        .unionByName(links.select(F.col(second).alias("x"), F.col(first).alias("y"))).distinct(), "links")
    labels = staged(ways.groupBy(F.col("x").alias("key")).agg(F.min("y").alias("near"))
                    .select("key", F.least("key", "near").alias("comp")), "labels")
    while True:
        near = (
            ways.join(labels, ways["y"] == labels["key"]).groupBy("x").agg(F.min("comp").alias("near")))
        lower = labels.join(near, labels["key"] == near["x"]).select("key", "comp", F.least("comp", "near").alias("next"))
        lower = staged(lower, "labels")
        jump = lower.select(F.col("key").alias("at"), F.col("next").alias("far"))
        after = staged(
            lower.join(jump, lower["next"] == jump["at"], "left")
            .select("key", F.col("comp").alias("before"), F.coalesce("far", "next").alias("comp")), "labels")
        changed = after.where("comp <> before").limit(1).count()
        labels = after.select("key", "comp")
        if not changed:
            return labels
