"""Tables written between passes, and small ones handed to every executor once their size is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.session import scratch_path

#: A lookup table is broadcast up to this size, measured first.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 8 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later passes do not repeat what made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def handed_out(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, marked for broadcasting if its rows and bytes allow it; if not, joins shuffle both sides."""
    found = table.limit(rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns])))).alias("b")).first()
    return F.broadcast(table) if found.n <= rows and (found.b or 0) <= size else table
