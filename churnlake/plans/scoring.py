"""Scoring all customers with saved artefacts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from churnlake.functions.text import quoted
from churnlake.operators import audit, encoding, features, scaling, scoring
from churnlake.sources import sinks, tables
from churnlake.spec import THRESHOLD
from churnlake.training import models


@dataclass(frozen=True)
class Artefacts:
    """What training leaves behind and scoring needs."""

    model: PipelineModel
    name: str
    columns: list[str]
    scaler: DataFrame


def save_artefacts(spark: SparkSession, path: str, model: PipelineModel, name: str, columns: Sequence[str], scaler: DataFrame) -> None:
    models.save(model, f"{path}/model")
    sinks.write_table(scaler, f"{path}/scaler")
    rows = [(i, c, name) for i, c in enumerate(columns)]
    sinks.write_table(spark.createDataFrame(rows, "position int, feature string, model string"), f"{path}/columns")


def load_artefacts(spark: SparkSession, path: str) -> Artefacts:
    """Fails with a hint when a part is missing; the column list has one row per feature."""
    listed = sorted(tables.read_table(spark, f"{path}/columns").collect(), key=lambda r: r.position)
    scaler = tables.read_table(spark, f"{path}/scaler")
    return Artefacts(models.load(f"{path}/model"), listed[0].model, [r.feature for r in listed], scaler)


def score_customers(clean: DataFrame, artefacts: Artefacts) -> DataFrame:
    """The clean table with ``p``. The readable columns travel in a struct beside the encoded ones, so no join
    brings them together again; one-hot levels come from the saved columns, not from this batch."""
    names = ", ".join(quoted(c) for c in clean.columns)
    carried = clean.selectExpr("*", f"struct({names}) AS original")
    encoded = encoding.encode_saved(features.add_business_features(carried), artefacts.columns)
    aligned = encoding.align(encoded, artefacts.columns, keep=["original"])
    scaled = scaling.apply_scaler(aligned, artefacts.scaler)
    return models.score(artefacts.model, scaled).select("original.*", models.PROBABILITY)


def run_scoring(spark: SparkSession, clean_path: str, artefact_path: str, out_path: str, threshold: float = THRESHOLD) -> DataFrame:
    """Score every customer, write the predictions by tier, and return the named checks on what was written."""
    scored = score_customers(tables.read_table(spark, clean_path), load_artefacts(spark, artefact_path))
    actual = "Churn" if "Churn" in scored.columns else None
    sinks.write_predictions(scoring.build_predictions(scored, actual=actual, threshold=threshold), out_path)
    return audit.validate_predictions(tables.read_table(spark, out_path))
