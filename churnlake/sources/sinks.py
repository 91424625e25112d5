"""Writers. Parquet is the hand-off format; CSV is for tools that need it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks at either end of a value are kept."""
    (
        df.write.mode("overwrite").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_features(df: DataFrame, path: str) -> None:
    """Features with their split; one folder per split, so a reader of one side skips the other."""
    write_table(df, path, ("split",))


def write_predictions(df: DataFrame, path: str) -> None:
    """All predictions once, one folder per risk tier: a call list is a read of one folder."""
    write_table(df, path, ("RiskCategory",))
