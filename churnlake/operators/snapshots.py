"""Differences of two versions of a table as multisets, and what changed per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.sources.staging import written

#: Copies made from one row at a time, so that a row with very many copies is spread over tasks.
BLOCK = 10_000


def _hashes(df: DataFrame) -> list[Column]:
    """128 bits for the content of a row. Spark's hash skips nulls, so which columns are null is part of it."""
    parts = []
    for f in df.schema:
        value = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("array", "struct", "map", "variant"):
            value = F.to_json(F.struct(value))
        parts += [value.isNull(), value]
    return [F.xxhash64(*parts).alias("_h1"), F.xxhash64(F.lit(7), *parts).alias("_h2")]


def _ordered(after: DataFrame, before: DataFrame) -> DataFrame:
    if sorted(after.columns) != sorted(before.columns):
        raise ValueError(f"columns differ: {sorted(before.columns)} and {sorted(after.columns)}")
    return after.select(*[F.col(f"`{c}`").cast(before.schema[c].dataType).alias(c) for c in before.columns])


def row_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """_h1, _h2, n_before, n_after of every distinct row; only hashes are shuffled, counted before."""
    after = _ordered(after, before)
    sides = [d.select(*_hashes(d), F.lit(a).alias("a"), F.lit(b).alias("b")) for d, a, b in ((before, 1, 0), (after, 0, 1))]
    return sides[0].unionByName(sides[1]).groupBy("_h1", "_h2").agg(
        F.sum(F.col("a").cast("long")).alias("n_before"), F.sum(F.col("b").cast("long")).alias("n_after"))


def _with_rows(df: DataFrame, counts: DataFrame) -> DataFrame:
    """The row of every hash in ``counts``, once, with the counts; rows that are not wanted are dropped before they are combined."""
    small = counts.select(F.col("_h1").alias("_c1"), F.col("_h2").alias("_c2"), *[c for c in counts.columns if c not in ("_h1", "_h2")])
    hashed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *_hashes(df))
    wanted = hashed.join(small.select("_c1", "_c2"), (F.col("_h1") == F.col("_c1")) & (F.col("_h2") == F.col("_c2")), "left_semi")
    single = wanted.groupBy("_h1", "_h2").agg(F.first("_row").alias("_row"))
    return single.join(small, (F.col("_h1") == F.col("_c1")) & (F.col("_h2") == F.col("_c2"))).drop("_c1", "_c2", "_h1", "_h2")


def expanded(rows: DataFrame, copies: str = "copies") -> DataFrame:
    """Every row as often as its count says; blocks of copies are dealt out over the tasks."""
    blocks = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col(copies) - 1, F.lit(BLOCK)))))
    blocks = blocks.withColumn("_share", F.least(F.lit(BLOCK), F.col(copies) - F.col("_block") * BLOCK).cast("int"))
    columns = [F.col(f"`{c}`") for c in rows.columns if c != copies]
    keyed = blocks.repartition(F.xxhash64(F.to_json(F.struct(*columns)), "_block"))
    return keyed.withColumn("_copy", F.explode(F.expr("array_repeat(0, _share)"))).select(*columns)


def except_all(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows of ``before`` that ``after`` has not, or not as often, with the number of ``copies`` too many. Nulls are equal."""
    counts = written(row_counts(before, after).where("n_before > n_after").withColumn(
        "copies", F.col("n_before") - F.col("n_after")).drop("n_before", "n_after"), "snapshot-counts")
    return _with_rows(before, counts).select("_row.*", "copies")


def intersect_all(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows that both tables have, with the number of ``copies`` in both."""
    counts = written(row_counts(before, after).withColumn("copies", F.least("n_before", "n_after")).where("copies > 0").drop(
        "n_before", "n_after"), "snapshot-counts")
    return _with_rows(before, counts).select("_row.*", "copies")


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, change (added, removed, changed), n_before, n_after and the changed columns, of every key with other rows than before.

    ``n_before`` and ``n_after`` count the key's rows that the other side has not. Where that is one row or copies of one row on
    both sides, ``columns`` names the columns that differ, in the table's order, joined by commas; it is empty where only the
    number of copies differs, and null where the rows of a key cannot be paired. Rows that both sides have never leave their task.
    """
    after = _ordered(after, before)
    counts = written(row_counts(before, after).where("n_before <> n_after"), "snapshot-counts")
    gone = _with_rows(before, counts.where("n_before > n_after").selectExpr("_h1", "_h2", "n_before - n_after AS n"))
    new = _with_rows(after, counts.where("n_after > n_before").selectExpr("_h1", "_h2", "n_after - n_before AS n"))

    def by_key(rows: DataFrame, side: str) -> DataFrame:
        named = [F.col(f"_row.`{k}`").alias(f"_{side}{i}") for i, k in enumerate(keys)]
        return rows.groupBy(*named).agg(F.sum("n").alias(f"n_{side}"), F.count(F.lit(1)).alias(f"kinds_{side}"),
                                        F.first("_row").alias(f"row_{side}"))

    same = reduce(Column.__and__, [F.col(f"_before{i}").eqNullSafe(F.col(f"_after{i}")) for i in range(len(keys))])
    both = by_key(gone, "before").join(by_key(new, "after"), same, "full")
    differ = F.array_compact(F.array(*[
        F.when(~F.col(f"row_before.`{c}`").eqNullSafe(F.col(f"row_after.`{c}`")), F.lit(c)) for c in before.columns]))
    change = F.when(F.col("row_before").isNull(), "added").when(F.col("row_after").isNull(), "removed").otherwise("changed")
    paired = (F.col("kinds_before") == 1) & (F.col("kinds_after") == 1)
    return both.select(
        *[F.when(F.col("row_after").isNull(), F.col(f"_before{i}")).otherwise(F.col(f"_after{i}")).alias(k) for i, k in enumerate(keys)],
        change.alias("change"), F.coalesce("n_before", F.lit(0)).cast("long").alias("n_before"),
        F.coalesce("n_after", F.lit(0)).cast("long").alias("n_after"), F.when(paired, F.array_join(differ, ",")).alias("columns"))
