"""Exact, deterministic stratified splits and folds, without ranking the whole table.

Rows are ordered by a hash of their key. A split is then a set of cut points in that order, so the table
itself is never sorted or shuffled: bucket counts say which bucket holds a cut, only those buckets are
ordered, and every row compares its hash with the few cut points of its class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions.text import quoted


def key_hash(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def test_quota(class_counts: DataFrame, test_size: float) -> DataFrame:
    """Test rows per class: ceil(test_size * n) shared out by largest remainder.

    ``class_counts`` has one row per class (columns ``cls``, ``n``), so one task is enough for it.
    """
    everything = Window.partitionBy()
    total = F.sum("n").over(everything)
    wanted = F.ceil(F.lit(float(test_size)) * total)
    quota = class_counts.select("cls", "n", total.alias("total"), wanted.alias("wanted")).withColumns({
        "floor": F.expr("cast(wanted as decimal(20,0)) * n div total"),
        "rest": F.expr("cast(wanted as decimal(20,0)) * n % total"),
    })
    missing = F.col("wanted") - F.sum("floor").over(everything)
    place = F.row_number().over(everything.orderBy(F.col("rest").desc(), "cls"))
    return quota.select(
        "cls", "n", (F.col("floor") + F.when(place <= missing, 1).otherwise(0)).cast("bigint").alias("n_test"))


def _cut_hashes(hashed: DataFrame, sizes: DataFrame, wanted: DataFrame, digits: int) -> DataFrame:
    """(cls, cut, hash): the hash at rank ``rank`` of its class, for every row (cls, cut, rank) of ``wanted``.

    ``sizes`` has the row count ``n`` per class and hash bucket.
    """
    order = Window.partitionBy("cls").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    reached = sizes.withColumn("upto", F.sum("n").over(order)).withColumn("before", F.col("upto") - F.col("n"))
    w = wanted.withColumnRenamed("cls", "w_cls")
    where = reached.join(
        F.broadcast(w), F.expr("cls <=> w_cls AND before < rank AND rank <= upto")
    ).selectExpr("w_cls", "cut", "bucket AS w_bucket", "rank - before AS need")
    inside = (
        hashed.join(F.broadcast(where), F.expr(f"cls <=> w_cls AND substring(h, 1, {digits}) = w_bucket"))
        .groupBy("cls", "cut", "need", "h").agg(F.count(F.lit(1)).alias("copies"))
    )
    running = Window.partitionBy("cls", "cut").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    return (
        inside.withColumn("reached", F.sum("copies").over(running))
        .where("reached >= need")
        .groupBy("cls", "cut").agg(F.min("h").alias("hash"))
    )


def split_and_fold(
    df: DataFrame, key: str = "customerID", target: str = "Churn", test_size: float = 0.20,
    folds: int = 5, seed: int = 42, digits: int = 4,
) -> DataFrame:
    """Add ``split`` (train/test) and ``fold`` (0..folds-1 for train rows, null for test rows).

    Class counts per split are exact and fold sizes per class differ by at most one when the key is unique;
    copies of a key stay together. The broadcast tables hold one row per class and cut. ``digits`` sets the
    number of hash buckets (16 ** digits), that is, how small the only ordered part of the table is.
    """
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    hashed = df.select(F.col(target).alias("cls"), key_hash(key, seed).alias("h"))
    sizes = hashed.groupBy("cls", F.expr(f"substring(h, 1, {digits})").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    quota = test_quota(sizes.groupBy("cls").agg(F.sum("n").alias("n")), test_size)
    rank = (f"CASE WHEN cut = 0 THEN n_test ELSE n_test + cut * ((n - n_test) div {folds})"
            f" + least(cut, (n - n_test) % {folds}) END")
    wanted = quota.selectExpr("cls", "n", "n_test", f"explode(sequence(0, {folds - 1})) AS cut").selectExpr(
        "cls", "cut", f"CAST({rank} AS BIGINT) AS rank").where("rank > 0")
    cuts = _cut_hashes(hashed, sizes, wanted, digits)
    per_class = cuts.groupBy(F.col("cls").alias("_cls")).agg(
        *[F.expr(f"max(CASE WHEN cut = {i} THEN hash END)").alias(f"_cut{i}") for i in range(folds)])
    joined = df.withColumn("_h", key_hash(key, seed)).join(
        F.broadcast(per_class), F.col(target).eqNullSafe(F.col("_cls")), "left")
    beyond = [f"coalesce(_h > _cut{i}, true)" for i in range(folds)]
    fold = " + ".join(["0"] + [f"CASE WHEN {b} THEN 1 ELSE 0 END" for b in beyond[1:]])
    return joined.selectExpr(
        *[quoted(c) for c in df.columns],
        f"CASE WHEN {beyond[0]} THEN 'train' ELSE 'test' END AS split",
        f"CASE WHEN {beyond[0]} THEN {fold} END AS fold")


def split_report(df: DataFrame, target: str = "Churn") -> DataFrame:
    """Rows and target rate per split."""
    rate = F.try_divide(F.sum(target), F.count(target)) * 100.0
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(target) == 1).alias("churned"),
        (F.rint(rate * 10) / 10).alias("churn_pct"))


def class_weights(df: DataFrame, target: str = "Churn", weight: str = "weight", classes: int = 2) -> DataFrame:
    """Balanced weight n / (classes * n_class) per row; the broadcast table has one row per class."""
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("_cls")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy()
    table = counts.select("_cls", F.try_divide(
        F.sum("_n").over(whole).cast("double"), F.lit(float(classes)) * F.col("_n")).alias(weight))
    return df.join(F.broadcast(table), F.col(target) == F.col("_cls"), "left").drop("_cls")
