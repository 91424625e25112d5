"""Splits, folds, weights and scaling: exact counts, determinism, hot keys and odd classes."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from churnlake.operators import scaling, splitting


def frame(spark, sizes, prefix="c"):
    rows = [(f"{prefix}{c}-{i}", c) for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "customerID string, Churn int")


@pytest.mark.parametrize("sizes, test", [
    ({0: 5174, 1: 1869}, {0: 1035, 1: 374}),
    ({0: 10}, {0: 2}),
    ({0: 3, 1: 1}, {0: 1, 1: 0}),
    ({0: 50, 1: 25, 2: 25}, {0: 10, 1: 5, 2: 5}),
])
def test_class_counts_are_exact(spark, sizes, test):
    df = splitting.split_and_fold(frame(spark, sizes), digits=2)
    rows = df.collect()
    assert Counter(r.Churn for r in rows) == sizes
    counts = Counter(r.Churn for r in rows if r.split == "test")
    assert {c: counts[c] for c in sizes} == test
    for c, n in sizes.items():
        folds = Counter(r.fold for r in rows if r.Churn == c and r.split == "train")
        sizes_of_folds = [folds[k] for k in range(5)]
        assert sum(sizes_of_folds) == n - test[c] and max(sizes_of_folds) - min(sizes_of_folds) <= 1
    assert all(r.fold is None for r in rows if r.split == "test")


@pytest.mark.parametrize("digits", [1, 3, 4])
def test_split_is_the_full_hash_order(spark, digits):
    """The bucketed cut equals sorting everything by the hash, whatever the bucket size."""
    df = splitting.split_and_fold(frame(spark, {0: 300, 1: 90}), digits=digits, seed=7).collect()
    for c, n_test in ((0, 60), (1, 18)):
        ordered = sorted((r for r in df if r.Churn == c), key=lambda r: hashlib.md5(f"7:{r.customerID}".encode()).hexdigest())
        assert [r.split for r in ordered] == ["test"] * n_test + ["train"] * (len(ordered) - n_test)
        assert [r.fold for r in ordered[n_test:]] == sorted(r.fold for r in ordered[n_test:])


def test_same_rows_whatever_the_partitions(spark):
    df = frame(spark, {0: 200, 1: 80})
    first = {r.customerID: (r.split, r.fold) for r in splitting.split_and_fold(df.repartition(7)).collect()}
    second = {r.customerID: (r.split, r.fold) for r in splitting.split_and_fold(df.coalesce(1)).collect()}
    other = {r.customerID: (r.split, r.fold) for r in splitting.split_and_fold(df, seed=43).collect()}
    assert first == second and first != other


def test_hot_key_and_null_class_keep_every_row(spark):
    rows = [("hot", 0)] * 400 + [(f"k{i}", i % 2) for i in range(600)] + [(f"n{i}", None) for i in range(50)]
    df = splitting.split_and_fold(spark.createDataFrame(rows, "customerID string, Churn int"), digits=2).collect()
    assert len(df) == 1050
    assert len({r.split for r in df if r.customerID == "hot"}) == 1
    assert sum(r.split == "test" for r in df if r.Churn is None) == 10


def test_missing_target_is_an_error(spark):
    with pytest.raises(ValueError):
        splitting.split_and_fold(frame(spark, {0: 4}).drop("Churn"))


def test_balanced_weights(spark):
    rows = splitting.class_weights(frame(spark, {0: 30, 1: 10})).collect()
    assert {r.Churn: r.weight for r in rows} == {0: pytest.approx(40 / 60), 1: pytest.approx(2.0)}
    assert sum(r.weight for r in rows) == pytest.approx(40)


def test_scaler_uses_population_deviation_of_train_only(spark):
    rows = [("train", float(v), 4.0) for v in (1, 2, 3, 10, 4)] + [("test", 100.0, 5.0)]
    df = spark.createDataFrame(rows, "split string, tenure double, CLV double")
    fitted = scaling.fit_scaler(df.where("split = 'train'"))
    table = {r.feature: (r["mean"], r["scale"]) for r in fitted.collect()}
    assert table["tenure"] == (4.0, pytest.approx(3.162278, abs=1e-6)) and table["CLV"] == (4.0, 1.0)
    scaled = scaling.apply_scaler(df, fitted).collect()
    train = [r.tenure for r in scaled if r.split == "train"]
    assert np.mean(train) == pytest.approx(0, abs=1e-12) and np.std(train) == pytest.approx(1)
    assert [r.CLV for r in scaled if r.split == "test"] == [1.0]
