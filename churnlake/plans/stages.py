"""The batch stages. They meet through tables, so each starts from a short lineage and can be run again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake import spec as S
from churnlake.operators import (
    audit, cleaning, correlation, distributions, encoding, evaluation, features, insights, scaling, segments, splitting,
)
from churnlake.plans.scoring import save_artefacts
from churnlake.sources import sinks, tables
from churnlake.spec import TELCO, ChurnSpec
from churnlake.training import crossval, models


def run_cleaning(spark: SparkSession, raw: DataFrame, out_path: str, min_rows: int = 7000) -> DataFrame:
    """Clean, write, and return the named checks. A failed check is reported, not raised: the table is written."""
    sinks.write_table(cleaning.clean(raw), out_path)
    return audit.validate_clean(tables.read_table(spark, out_path), min_rows)


def exploration(clean: DataFrame, spec: ChurnSpec = TELCO) -> dict[str, DataFrame]:
    """Every exploration report by name; each is computed when it is read."""
    numeric, target = spec.numeric, spec.target
    return {
        "overview": audit.overview(clean, distributions.describe(clean, numeric)),
        "target": audit.target_distribution(clean, target),
        "numeric_stats": distributions.stats_table(clean, numeric),
        "histograms": distributions.histogram(clean, numeric, 40),
        "histograms_by_class": distributions.histogram(clean, numeric, 30, [target]),
        "densities_by_class": distributions.density(clean, numeric, [target]),
        "box_by_class": distributions.box_stats(clean, numeric, [target]),
        "violin_by_class": distributions.violin(clean, numeric, [target]),
        "segments": segments.segment_report(clean, spec.segments, target),
        "above_average": segments.flag_above_average(clean, S.FOCUS_SEGMENTS, target),
        "correlation": correlation.correlation_pairs(clean, [*numeric, target]),
        "outliers": distributions.outlier_report(clean, numeric),
        "insights": insights.insights(clean, target),
        "bi": features.bi_projection(clean),
    }


def run_exploration(clean: DataFrame, out_path: str) -> list[str]:
    """Write all reports as Parquet and the BI table as CSV; returns the report names."""
    reports = exploration(clean)
    sinks.write_csv(reports.pop("bi"), f"{out_path}/bi")
    for name, report in reports.items():
        sinks.write_table(report, f"{out_path}/{name}")
    return sorted([*reports, "bi"])


def feature_table(clean: DataFrame, levels: encoding.Levels | None = None, spec: ChurnSpec = TELCO) -> DataFrame:
    """Key, target and all model inputs."""
    encoded = encoding.encode(features.add_business_features(clean), levels, spec)
    return encoding.drop_non_features(encoded, spec, keep=(spec.key,))


def run_features(clean: DataFrame, out_path: str, test_size: float = 0.20, folds: int = 5, seed: int = 42) -> list[str]:
    """Write the feature table with split and fold; returns the model inputs in order."""
    table = feature_table(clean)
    sinks.write_features(splitting.split_and_fold(table, test_size=test_size, folds=folds, seed=seed), out_path)
    return [c for c in table.columns if c not in (TELCO.key, TELCO.target)]


def run_training(
    spark: SparkSession, features_path: str, columns: Sequence[str], out_path: str, report_path: str,
    names: Sequence[str] = models.MODEL_NAMES, overrides: Mapping[str, Mapping] | None = None,
    threshold: float = S.THRESHOLD,
) -> DataFrame:
    """Cross-validate, fit and test the models, save all of them and the best one's artefacts.

    Returns the comparison report it wrote to ``report_path``.
    """
    settings = overrides or {}
    train = tables.read_split(spark, features_path, "train").persist()
    test = tables.read_split(spark, features_path, "test")
    scaler = scaling.fit_scaler(train)
    weighted = models.balanced(scaling.apply_scaler(train, scaler))
    fitted = models.fit_all(names, weighted, columns, overrides=settings)
    for name, model in fitted.items():
        models.save(model, f"{out_path}/all/{name.lower().replace(' ', '_')}")

    sinks.write_table(crossval.fold_scores(train, names, columns, overrides=settings), f"{report_path}/fold_scores")
    scaled_test = scaling.apply_scaler(test, scaler)
    parts = [models.score(m, scaled_test).select(F.lit(n).alias("model"), TELCO.key, TELCO.target, models.PROBABILITY)
             for n, m in fitted.items()]
    sinks.write_table(reduce(DataFrame.unionByName, parts), f"{report_path}/test_scores")
    train.unpersist()

    tested = evaluation.evaluate(tables.read_table(spark, f"{report_path}/test_scores"), threshold=threshold, by=["model"])
    validated = crossval.cross_validate(tables.read_table(spark, f"{report_path}/fold_scores"))
    sinks.write_table(evaluation.comparison_report(tested, validated, threshold), f"{report_path}/comparison")
    report = tables.read_table(spark, f"{report_path}/comparison")
    best = report.where(F.col("best_model") == "★").first().model
    save_artefacts(spark, out_path, fitted[best], best, columns, scaler)
    return report
