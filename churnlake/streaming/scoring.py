"""Scoring of customers as their rows arrive in a folder.

Rows are cleaned and scored by the batch operators, which are all column expressions. What differs is the removal of
copies: a row is kept the first time it is seen, and its key (a hash of the typed row) is held in state until the
watermark has passed it. The state therefore grows with the rows of one ``delay``, not with all rows ever seen.

Defined results: a row that arrives when the watermark (latest time seen in earlier batches less ``delay``) has passed its
time is late and dropped, as is a row without a time; copies within ``delay`` of each other count once, nulls being equal. The
Parquet sink lists the files of each batch, so a batch that is replayed after a failure adds nothing twice; a run that
starts from an old checkpoint goes on behind the files it has read. Ranks depend on all customers and are made on reading.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlake.operators import cleaning

DELAY = "25 hours"


def arrivals(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int | None = None) -> DataFrame:
    """Rows of the Parquet files of a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def clean_arrivals(raw: DataFrame, at: str = "arrived", delay: str = DELAY) -> DataFrame:
    """The batch cleaning rules in their order, copies removed within the watermark; ``at`` is dropped."""
    typed = cleaning.fill_missing_charges(cleaning.fix_data_types(raw.where(F.col(f"`{at}`").isNotNull())))
    columns = [c for c in typed.columns if c != at]
    key = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}), 256)
    once = typed.withColumn("__row", key).withWatermark(at, delay).dropDuplicatesWithinWatermark(["__row"])
    return cleaning.standardise(once.select(*[F.col(f"`{c}`") for c in columns]))


def score_arrivals(raw: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
                   at: str = "arrived", delay: str = DELAY) -> StructType:
    """Score all that has arrived since the last run, and stop. ``score`` works row by row. Returns the schema of ``out``."""
    scored = score(clean_arrivals(raw, at, delay))
    query = scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    query.awaitTermination()
    return scored.schema


def read_scored(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """What the runs so far have written; no rows before the first."""
    try:
        return spark.read.schema(schema).parquet(out)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
