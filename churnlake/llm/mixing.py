"""Mixing sources to target weights by capped water-filling.

The sources share the mix by weight. A source that would get more than ``max_epochs`` times its own size stops there,
and what it cannot use is shared among the others by weight until none is above. In order of cap over weight the
stopped sources are the first ones, so one ordered pass over the table of sources finds the level.

Inside a source every document is taken ``whole = floor(target / source_size)`` times. The remaining words come from
documents in the order of a seeded hash, up to the cut. The table is not sorted for that: sizes are summed by source
and hash bucket (65,536 buckets, combined before the shuffle), which locates the one bucket with the cut, and only
documents of that bucket are ordered. With ``boundary="part"`` the document at the cut is taken in part, so that a
source's words meet its target to the word; with "whole" it is taken whole or not at all, whichever is nearer.

Size of what meets in one task: the table of sources (one row each), the buckets of one source, the documents of one
bucket. The lookup by source is counted before it is broadcast.

Defined results: a null text has size 0; null sources are one source, the last; a null id hashes like the empty text;
equal rows are ordered arbitrarily, which does not change the set of results; sources without a word have target 0;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnlake.llm.common import WORD, as_row, lookup_join, staged

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 17
BUCKET_DIGITS = 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from rows of (source, size). Weights repeat over the sources by code point.

    The windows without a key run over one row per source, the result of an aggregate.
    """
    wide, everything = "decimal(38,0)", W.partitionBy()
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1)
    sources = (
        sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name)).withColumn("weight", weight.cast("long"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("cap", F.col("source_size") * max_epochs))
    common = 1
    for w in weights:
        common *= w
    by_cap = W.orderBy((F.col("cap").cast(wide) * F.expr(f"{common} DIV weight")).cast(wide), "rank")
    ordered = (
        sources
        .withColumn("stopped", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(by_cap.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("above", (F.col("total") - F.col("stopped")).cast(wide) * F.col("weight")
                    > F.col("cap").cast(wide) * F.col("open_weight")))
    level = (
        ordered
        .withColumn("gone", F.min(F.when(~F.col("above"), F.col("stopped"))).over(everything))
        .withColumn("sharing", F.max(F.when(~F.col("above"), F.col("open_weight"))).over(everything)))
    shared = (F.col("weight") * (F.col("total") - F.col("gone"))).cast("double") / F.col("sharing").cast("double")
    return level.select(
        "source", "source_size", F.when(F.col("above"), F.col("cap").cast("double")).otherwise(shared).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, boundary: str = "part",
        carry: bool = False) -> DataFrame:
    """id, source, size, source_size, target, taken, copies; with ``carry`` also ``row``, all input columns.

    ``copies`` is the number of whole repetitions of the document, ``taken`` the words that the mix takes of it.
    """
    if boundary not in ("part", "whole"):
        raise ValueError("boundary is 'part' or 'whole'")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    sized = staged(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(key).alias("pick"), *([as_row(docs).alias("row")] if carry else [])), "mix-sizes")
    bucket = F.substring("pick", 1, BUCKET_DIGITS)
    targets = staged(source_targets(sized.select("source", "size"), weights, max_epochs), "mix-targets")

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    quota = targets.withColumn("whole", whole).withColumn(
        "rest", F.greatest(F.lit(0).cast("long"), F.floor("target").cast("long") - F.col("whole") * F.col("source_size")))
    buckets = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").cast("long").alias("words"))
    running = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    placed = buckets.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)).cast("long"))
    cut = (
        lookup_join(placed, quota.select(F.col("source").alias("q"), "rest"), F.col("source").eqNullSafe(F.col("q")))
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
        .select(F.col("source").alias("c"), F.col("bucket").alias("cut"), "before"))
    rule = staged(
        quota.join(cut, F.col("source").eqNullSafe(F.col("c")), "left")
        .select(F.col("source").alias("s"), "source_size", "target", "whole", "rest", "cut",
                F.coalesce("before", F.lit(0)).cast("long").alias("before")), "mix-rule")

    joined = lookup_join(sized, rule, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    at_cut = F.coalesce(bucket == F.col("cut"), F.lit(False))
    first = joined.where(~at_cut).withColumn(
        "extra", F.when(bucket < F.col("cut"), F.col("size")).otherwise(0).cast("long"))
    inside = W.partitionBy("source").orderBy("pick", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    room = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    second = joined.where(at_cut).withColumn("room", room.cast("long")).withColumn("extra", _extra(boundary)).drop("room")
    return first.unionByName(second).select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target",
        (F.col("whole") * F.col("size") + F.col("extra")).alias("taken"),
        (F.col("whole") + ((F.col("extra") == F.col("size")) & (F.col("size") > 0)).cast("long")).alias("copies"),
        *(["row"] if carry else []))


def _extra(boundary: str) -> Column:
    size, room = F.col("size"), F.col("room")
    if boundary == "part":
        return F.greatest(F.lit(0).cast("long"), F.least(size, room))
    return F.when((room > 0) & (2 * room >= size), size).otherwise(0).cast("long")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the input's columns, each document as often as it is taken, always whole."""
    taken = mix(docs, boundary="whole", carry=True, **settings).where("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
