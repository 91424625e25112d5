"""Shape of the physical plans: no cross joins, no whole-table sort in one task, pruned scans, stage round trip."""

import re

import pytest
from pyspark.sql import functions as F

from churnlake.catalog import QUERIES
from churnlake.catalog.relations import Tables
from churnlake.operators import distributions, segments
from churnlake.plans import scoring as scoring_plan
from churnlake.plans import stages
from churnlake.session import scratch_path
from churnlake.sources import sinks, tables

FAMILIES = [
    "aud_3_null_counts", "aud_5_duplicate_rows", "aud_7_target_distribution", "cln_10_clean", "seg_3_all_segments",
    "seg_5_above_average", "seg_6_key_measures", "seg_13_kpi_measures", "sta_4_stats_table", "sta_6_outlier_report",
    "sta_12_histogram_by_class", "sta_13_density", "sta_18_charge_by_probability", "fea_16_bi_projection",
    "enc_3_one_hot", "spl_1_split", "ml_1_class_weights", "evl_2_roc_auc", "evl_4_roc_curve", "evl_5_threshold_sweep",
    "prd_9_priority_rank", "prd_12_sorted_predictions",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", FAMILIES)
def test_no_cross_joins(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["cln_10_clean", "fea_16_bi_projection", "enc_3_one_hot", "prd_4_tier", "seg_3_all_segments"])
def test_row_level_work_has_no_single_partition(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    # The only global aggregate is the snapshot month of the order history.
    assert len(re.findall("SinglePartition", text)) <= len(re.findall(r"partial_max\(month", text))


def test_windows_without_keys_only_see_small_tables(spark, folder):
    """A window in one task is fed by counts per class, rank step or bucket, never by rows of the table."""
    for name in ("spl_1_split", "prd_9_priority_rank", "evl_2_roc_auc"):
        text = plan(QUERIES[name](spark, folder))
        for block in re.findall(r"Window .*?\n(?:.*\n){1,4}?.*Exchange SinglePartition.*\n(.*)\n", text):
            assert "Aggregate" in block or "Project" in block


def test_scans_read_only_what_is_used(spark, folder):
    t = Tables(spark, folder, True)
    text = plan(segments.churn_rate_table(t.clean, "Contract"))
    assert "ReadSchema: struct<Contract:string,Churn:int>" in text and "IsNotNull(Contract)" in text
    text = plan(distributions.moments(t.clean, ["tenure"]))
    assert "ReadSchema: struct<tenure:int>" in text


def test_a_tier_list_reads_one_folder(spark, folder):
    path = scratch_path(spark, "tiers")
    sinks.write_predictions(Tables(spark, folder).predictions, path)
    high = tables.read_table(spark, path).where(F.col("RiskCategory") == "High Risk")
    assert "PartitionFilters: [isnotnull(RiskCategory" in plan(high)


def test_dedup_merges_before_the_shuffle(spark, folder):
    text = plan(QUERIES["cln_5_drop_duplicates"](spark, folder))
    assert text.count("HashAggregate(keys=[customerID") == 2


def test_stages_end_to_end(spark, folder):
    """Raw CSV to written predictions, with small models."""
    root = scratch_path(spark, "stages")
    sinks.write_csv(Tables(spark, folder).raw, f"{root}/raw")
    raw = tables.read_raw_csv(spark, f"{root}/raw")
    checks = {r.check: r.passed for r in stages.run_cleaning(spark, raw, f"{root}/clean", min_rows=100).collect()}
    assert all(checks.values())
    clean = tables.read_table(spark, f"{root}/clean")
    assert clean.count() == 150
    assert "insights" in stages.run_exploration(clean, f"{root}/reports")
    columns = stages.run_features(clean, f"{root}/features")
    assert len(columns) == 30
    small = {"Random Forest": {"numTrees": 5, "maxDepth": 3}, "Decision Tree": {"maxDepth": 3}}
    report = stages.run_training(
        spark, f"{root}/features", columns, f"{root}/models", f"{root}/evaluation",
        names=["Decision Tree", "Random Forest"], overrides=small).collect()
    assert len(report) == 2 and [r.best_model for r in report].count("★") == 1
    assert all(0 <= r.cv_roc_auc <= 1 and 0 <= r.test_recall <= 1 for r in report)
    done = scoring_plan.run_scoring(spark, f"{root}/clean", f"{root}/models", f"{root}/predictions")
    assert all(r.passed for r in done.collect())
    predictions = tables.read_table(spark, f"{root}/predictions")
    assert predictions.count() == 150 and len(predictions.columns) == 33
    with pytest.raises(FileNotFoundError):
        scoring_plan.load_artefacts(spark, f"{root}/absent")
