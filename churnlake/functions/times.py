"""Points in time as whole numbers that sort like them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE, HOUR, DAY = 60 * SECOND, 3600 * SECOND, 86_400 * SECOND


def micros(df: DataFrame, column: str) -> Column:
    """A timestamp or date as microseconds, a whole number as it is.

    Timestamps without a zone are taken apart by their fields, so that the session's zone has no say in the order.
    """
    kind, value = df.select(column).schema[0].dataType.simpleString(), F.col(column)
    if kind == "timestamp":
        return F.unix_micros(value)
    days = F.datediff(value, F.lit("1970-01-01").cast("date")).cast("long") * DAY
    if kind == "date":
        return days
    if kind == "timestamp_ntz":
        seconds = F.expr(f"CAST(extract(SECOND FROM {column}) * {SECOND} AS BIGINT)")
        return days + F.hour(value).cast("long") * HOUR + F.minute(value).cast("long") * MINUTE + seconds
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return value.cast("long")
    raise ValueError(f"{column} is a {kind}, not a point in time")
