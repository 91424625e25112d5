"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table: slot ``(offset + j * skip) % size``
for j = 0, 1, 2, ... Shards take turns by name, each claiming the first slot of its order that is still free, until
the table is full. A key then needs one hash and one look into the broadcast table. Adding or removing a shard moves
little more than that shard's share.

The table is filled in one SQL expression over binary values: a step of the fold is one look at one slot, so it costs
about ``size * ln(size)`` steps whatever the data. The data are never shuffled: the table has ``size`` rows, a
parameter, and is broadcast.

Defined results: a null key is placed like the empty text; equal keys share a shard; shard names that are null are
left out and repeated ones count once; no shard at all is an error; an empty input gives an empty result. Columns of
the input are kept, and the names of the two new columns are parameters.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import as_row, let

SHARDS = 64
TABLE_SIZE = 6553


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, math.isqrt(n) + 1))


def hashed(text: Column) -> Column:
    """48 bits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def _read(data: Column, index: Column, width: int) -> Column:
    return F.conv(F.hex(F.substring(data, (index * width + 1).cast("int"), F.lit(width))), 16, 10).cast("long")


def _write(data: Column, index: Column, value: Column, width: int) -> Column:
    code = F.unhex(F.lpad(F.hex(value.cast("long")), 2 * width, "0"))
    return F.overlay(data, code, (index * width + 1).cast("int"), F.lit(width))


def lookup_table(shards: DataFrame, size: int = TABLE_SIZE) -> DataFrame:
    """``slot``, ``shard`` for every slot of the filled table. ``shards`` has the names in its first column."""
    if not is_prime(size) or size >= 1 << 24:
        raise ValueError("the table size must be a prime below 2**24")
    name = F.col(f"`{shards.columns[0]}`").cast("string")
    known = shards.select(name.alias("name")).where("name IS NOT NULL").distinct()
    seeds = known.select(
        "name",
        (hashed(F.concat(F.lit("offset:"), "name")) % size).alias("offset"),
        (hashed(F.concat(F.lit("skip:"), "name")) % (size - 1) + 1).alias("skip"))
    everyone = seeds.agg(F.sort_array(F.collect_list(F.struct("name", "offset", "skip"))).alias("s"))
    steps = int(size * (4 * math.log(size) + 8))

    def step(state: Column, _: Column, s: Column) -> Column:
        turn, filled = state["turn"], state["filled"]
        shard = turn % F.size(s)
        probe = _read(state["probes"], shard, 4)
        slot = (F.get(s, shard.cast("int"))["offset"] + probe * F.get(s, shard.cast("int"))["skip"]) % size
        free = _read(state["slots"], slot, 3) == 0
        looked = F.struct(
            F.when(free, turn + 1).otherwise(turn).alias("turn"),
            F.when(free, filled + 1).otherwise(filled).alias("filled"),
            _write(state["probes"], shard, probe + 1, 4).alias("probes"),
            F.when(free, _write(state["slots"], slot, shard + 1, 3)).otherwise(state["slots"]).alias("slots"))
        return F.when(filled == size, state).otherwise(looked)

    def fill(s: Column) -> Column:
        zeros = lambda n, width: F.unhex(F.repeat(F.lit("00" * width), n))
        start = F.struct(
            F.lit(0).cast("long").alias("turn"), F.lit(0).cast("long").alias("filled"),
            zeros(F.size(s), 4).alias("probes"), zeros(F.lit(size), 3).alias("slots"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda a, i: step(a, i, s))

    done = everyone.where(F.size("s") > 0).select(
        let(F.col("s"), lambda s: F.struct(s.alias("s"), fill(s).alias("t"))).alias("r"))
    checked = done.select(
        "r.s", F.when(F.col("r.t.filled") == size, F.col("r.t.slots"))
        .otherwise(F.raise_error(F.lit("the table did not fill; choose another prime"))).alias("slots"))
    return checked.select(
        F.explode(let(F.struct("s", "slots"), lambda r: F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long")),
            lambda i: F.struct(i.alias("slot"), F.get(r["s"], (_read(r["slots"], i, 3) - 1).cast("int"))["name"]
                               .alias("shard"))))).alias("e")).select("e.slot", "e.shard")


def place(df: DataFrame, key: str, shards: DataFrame, size: int = TABLE_SIZE, slot: str = "slot",
          shard: str = "shard") -> DataFrame:
    """``df`` with the slot of its key and the shard that holds that slot.

    All columns of ``df`` stay as they are; where one of them has the name of a new column, the new one gets ``_`` behind it.
    """
    if shards.limit(1).count() == 0:
        raise ValueError("there must be a shard")
    names = []
    for name in (slot, shard):
        while name in (*df.columns, *names):
            name += "_"
        names.append(name)
    text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    keyed = df.select(as_row(df).alias("row"), (hashed(text) % size).alias("place"))
    joined = keyed.join(F.broadcast(lookup_table(shards, size)), F.col("place") == F.col("slot"), "left")  # size rows, a parameter
    return joined.select("row.*", F.col("slot").alias(names[0]), F.col("shard").alias(names[1]))


def named_shards(spark: SparkSession, count: int = SHARDS) -> DataFrame:
    return spark.range(count).select(F.format_string("shard-%05d", "id").alias("shard"))


def write_shards(placed: DataFrame, path: str, shard: str = "shard", files: int = 1) -> None:
    """One folder for each shard; a large shard is spread over ``files`` files."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns if c != shard]), F.lit(files))
    placed.repartition(F.col(shard), salt).write.partitionBy(shard).parquet(path)
