"""Helpers the operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.session import scratch_path

#: A word is a maximal run of characters other than these.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: Lookup tables of at most this many rows, counted first, are broadcast; larger ones are joined by shuffling.
BROADCAST_ROWS = 50_000
SHINGLE = 5
SIMILARITY = 0.8


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the folder the cluster shares and read back, so that its lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever they run, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="churnlake-py-"), "churnlake_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)  # Spark serves it to the executors
    _shipped.add(context.applicationId)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text in order; none for a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def lookup_join(df: DataFrame, lookup: DataFrame, condition: Column, how: str = "left") -> DataFrame:
    """Join with a written table that normally is small: its rows are counted, and only a small one is broadcast."""
    if lookup.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        lookup = F.broadcast(lookup)
    return df.join(lookup, condition, how)


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct: whatever they are called, they cannot clash with computed ones."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])
