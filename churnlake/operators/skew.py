"""Equi-join with hot keys: found by a heavy-hitter sketch, salted on one side and replicated on the other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED, TOP, MOST_SALTS, LEAST = 50_000, 1_000, 2_000, 1_000


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int | None = None, tracked: int = TRACKED) -> DataFrame:
    """_hash, _salts of the keys that have more than ``rows`` rows, by a sketch of ``tracked`` counters; ``TOP`` rows at most.

    Without ``rows``, a key is hot when it holds more than half of what a shuffle partition would get. The sketch overlooks no key with more than a few parts in ``tracked`` of all rows, and its counts are off by no more; it
    decides only how rows are dealt, not what is joined.
    """
    hashed = df.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("h"))
    found = hashed.agg(F.expr(f"approx_top_k(h, {TOP}, {tracked})").alias("top"), F.count("h").alias("n")).first()
    if rows is None:
        rows = max(LEAST, found["n"] // (2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    found = found["top"] or []
    hot = [(r["item"], min(MOST_SALTS, -(-r["count"] // rows))) for r in found if r["count"] > rows]
    return df.sparkSession.createDataFrame(hot, "_hash long, _salts long")


def skew_join(
    big: DataFrame, other: DataFrame, on: Sequence[tuple[str, str]], take: Sequence[str], how: str = "inner",
    rows: int | None = None, tracked: int = TRACKED,
) -> DataFrame:
    """Rows of ``big`` with the columns ``take`` of the matching rows of ``other``; ``how`` is inner, left, semi or anti.

    Keys with more than ``rows`` rows in ``big`` are hot (see ``hot_keys``). Their rows are dealt to salts of about ``rows`` rows each by a hash of
    all columns, and the rows of ``other`` with such a key go to all salts of it. Equal rows would share a salt: they are
    counted before the shuffle and their number is divided among the salts. All other keys are joined as usual. Rows with a null
    key match nothing and are not shuffled. Columns of ``big`` must be comparable (no maps).
    """
    if how not in ("inner", "left", "semi", "anti"):
        raise ValueError(f"unknown join {how!r}")
    clash = set(take) & set(big.columns) if how in ("inner", "left") else set()
    if clash:
        raise ValueError(f"columns of both tables: {', '.join(sorted(clash))}")
    left_keys, right_keys = [a for a, _ in on], [b for _, b in on]
    known = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in left_keys])
    columns = [F.col(f"`{c}`") for c in big.columns]
    hot = F.broadcast(hot_keys(big.where(known), left_keys, rows, tracked))  # TOP rows at most

    code = F.xxhash64(*[F.col(f"`{k}`") for k in left_keys])
    mine = big.where(known).select(F.struct(*columns).alias("_row"), *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(left_keys)],
                                   code.alias("_code"))
    mine = mine.join(hot, F.col("_code") == F.col("_hash"), "left")
    keep = take if how in ("inner", "left") else []
    theirs = other.where(reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in right_keys])).select(
        *[F.col(f"`{k}`").cast(big.schema[a].dataType).alias(f"_r{i}") for i, (a, k) in enumerate(on)],
        F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("_other"))
    theirs = theirs.withColumn("_rcode", F.xxhash64(*[f"_r{i}" for i in range(len(on))])).join(
        hot.select(F.col("_hash").alias("_rhash"), F.col("_salts").alias("_rsalts")), F.col("_rcode") == F.col("_rhash"), "left")

    equal = reduce(Column.__and__, [F.col(f"_k{i}") == F.col(f"_r{i}") for i in range(len(on))])
    kind = {"semi": "left_semi", "anti": "left_anti"}.get(how, how)
    plain = mine.where("_salts IS NULL").join(theirs.where("_rsalts IS NULL"), equal, kind)

    names = [f"_k{i}" for i in range(len(on))]
    counted = mine.where("_salts IS NOT NULL").groupBy("_row", *names, "_salts").agg(F.count(F.lit(1)).alias("_copies"))
    dealt = counted.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.least("_copies", "_salts") - 1)))
    dealt = dealt.withColumns({
        "_share": F.expr("_copies div least(_copies, _salts) + if(_part < _copies % least(_copies, _salts), 1, 0)"),
        "_salt": F.pmod(F.xxhash64("_row") + F.col("_part"), F.col("_salts"))})
    spread = theirs.where("_rsalts IS NOT NULL").withColumn("_rsalt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rsalts") - 1)))
    salted = dealt.join(spread, equal & (F.col("_salt") == F.col("_rsalt")), kind)
    salted = salted.withColumn("_copy", F.explode(F.expr("array_repeat(0, int(_share))")))

    wanted = ["_row"] + (["_other"] if how in ("inner", "left") else [])
    done = plain.select(*wanted).unionByName(salted.select(*wanted))
    out = done.select("_row.*", *[F.col(f"_other.`{c}`").alias(c) for c in keep])
    if how in ("left", "anti"):
        lost = big.where(~known).select(*columns, *[F.lit(None).cast(other.schema[c].dataType).alias(c) for c in keep])
        out = out.unionByName(lost)
    return out
