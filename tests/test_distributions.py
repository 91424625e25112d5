"""Statistics against NumPy and pandas on small columns, skewed and degenerate ones included."""

import math

import numpy as np
import pandas as pd
import pytest

from churnlake.operators import correlation, distributions
from churnlake.operators.quantiles import approximate_quantiles, exact_quantiles

RNG = np.random.default_rng(7)
SETS = {
    "tenure_like": RNG.integers(0, 73, 800).astype(float),
    "money": np.round(RNG.gamma(2.0, 900.0, 800), 2),
    "hot": np.where(RNG.random(800) < 0.4, 5.0, np.round(RNG.normal(0, 1e6, 800), 3)),
    "tiny": np.array([3.5]),
    "flat": np.full(9, 2.0),
}


@pytest.fixture(scope="module")
def frames(spark):
    return {n: spark.createDataFrame(pd.DataFrame({"v": x})) for n, x in SETS.items()}


@pytest.mark.parametrize("name", SETS)
@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_exact_quantiles(frames, name, accuracy):
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.prob: r.quantile for r in exact_quantiles(frames[name], ["v"], probs, accuracy=accuracy).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(SETS[name], p), rel=1e-12, abs=1e-12)


def test_a_wrong_sketch_does_not_change_quantiles(frames, monkeypatch):
    """Brackets that miss the rank on either side only cost work."""
    from churnlake.operators import quantiles as q
    real = q.F.percentile_approx
    for shift in (-1e9, 1e9):
        monkeypatch.setattr(
            q.F, "percentile_approx", lambda c, p, a: q.F.transform(real(c, p, a), lambda x: x + shift))
        got = {r.prob: r.quantile for r in exact_quantiles(frames["money"], ["v"], [0.25, 0.9]).collect()}
        assert got == pytest.approx({p: np.quantile(SETS["money"], p) for p in (0.25, 0.9)})


def test_quantiles_per_group_and_with_nulls(spark):
    rows = [(g, float(v) if v % 7 else None) for g in (0, 1, None) for v in range(100)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(df, ["v"], [0.3], ["g"]).collect()}
    expected = np.quantile([v for v in range(100) if v % 7], 0.3)
    assert got == {(0, 0.3): expected, (1, 0.3): expected, (None, 0.3): expected}


def test_approximate_quantiles_are_close(frames):
    got = {r.prob: r.quantile for r in approximate_quantiles(frames["money"], ["v"], [0.25, 0.5]).collect()}
    assert got[0.5] == pytest.approx(np.median(SETS["money"]), rel=0.02) and len(got) == 2


def test_moments_are_bias_adjusted(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10, 4)], "v double")
    r = distributions.moments(df, ["v"]).first()
    assert (r["count"], r["mean"]) == (5, 4.0)
    assert r["std"] == pytest.approx(3.535534, abs=1e-6)
    assert r["skew"] == pytest.approx(1.697056, abs=1e-6) and r["kurtosis"] == pytest.approx(3.152, abs=1e-9)


@pytest.mark.parametrize("name", ["tenure_like", "money", "hot"])
def test_moments_match_pandas(frames, name):
    s, r = pd.Series(SETS[name]), distributions.moments(frames[name], ["v"]).first()
    for got, want in ((r["mean"], s.mean()), (r["std"], s.std()), (r["skew"], s.skew()), (r["kurtosis"], s.kurtosis())):
        assert got == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("name", SETS)
@pytest.mark.parametrize("bins", [30, 40])
def test_histogram_matches_numpy(frames, name, bins):
    counts, edges = np.histogram(SETS[name], bins=bins)
    rows = sorted(distributions.histogram(frames[name], ["v"], bins).collect(), key=lambda r: r.bin)
    assert [r.n for r in rows] == list(counts)
    assert [r.bin_low for r in rows] == pytest.approx(list(edges[:-1])) and rows[-1].bin_high == pytest.approx(edges[-1])


@pytest.mark.parametrize("name", ["tenure_like", "money", "hot"])
def test_density_is_the_kernel_sum(frames, name):
    x = SETS[name]
    h = len(x) ** -0.2 * x.std(ddof=1)
    pad = (x.max() - x.min()) / 2
    grid = np.linspace(x.min() - pad, x.max() + pad, 200)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
    rows = sorted(distributions.density(frames[name], ["v"], points=200, digits=12).collect(), key=lambda r: r.point)
    assert [r.density for r in rows] == pytest.approx(list(want), abs=2e-12)
    assert [r.x for r in rows] == pytest.approx(list(grid), abs=1e-5)


def test_density_needs_spread(frames):
    assert distributions.density(frames["flat"], ["v"]).count() == 0
    assert distributions.density(frames["tiny"], ["v"]).count() == 0


def test_box_and_outliers(spark):
    x = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 100.0]
    df = spark.createDataFrame([(v,) for v in x] + [(None,)], "v double")
    box = distributions.box_stats(df, ["v"]).first()
    assert (box.whisker_low, box.whisker_high, box.fliers) == (1.0, 7.0, 1)
    report = distributions.outlier_report(df, ["v"]).first()
    q1, q3 = np.quantile(x, [0.25, 0.75])
    assert (report.q1, report.q3, report.outliers) == (q1, q3, 1)
    assert report.outlier_pct == pytest.approx(11.11)


def test_correlation_with_a_constant_column(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 5], "b": [2.0, 1, 4, 3], "k": [1.0] * 4})
    got = {(r.a, r.b): r.r for r in correlation.correlation_pairs(spark.createDataFrame(pdf), ["a", "b", "k"]).collect()}
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(pdf.a.corr(pdf.b), abs=1e-6)
    assert got[("a", "a")] == 1.0 and got[("k", "k")] is None and got[("a", "k")] is None


def test_correlation_uses_complete_pairs(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 5, np.nan, 7], "b": [2.0, 1, np.nan, 3, 9, 4], "c": [1e9, 1e9 + 1, 1e9 + 5, 1e9, 1e9, 1e9],
                        "d": [4.0, 4, 4, 4, 8, 4]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, d double")
    got = {(r.a, r.b): r.r for r in correlation.correlation_pairs(df, list("abcd")).collect()}
    want = pdf.corr()
    for x in "abcd":
        for y in "abcd":
            if (x, y) in (("a", "d"), ("d", "a")):
                assert got[(x, y)] is None
            else:
                assert got[(x, y)] == pytest.approx(want.loc[x, y], abs=1e-6)
    assert correlation.correlation_pairs(df.where("false"), ["a", "b"]).where("r is not null").count() == 0


def test_moments_of_flat_and_single_columns(frames):
    flat, tiny = (distributions.moments(frames[n], ["v"]).first() for n in ("flat", "tiny"))
    assert flat["std"] == 0.0 and flat["skew"] is None and tiny["std"] is None and tiny["mean"] == 3.5


def test_feature_profile_with_only_flags(spark):
    df = spark.createDataFrame([(i % 2, i % 3) for i in range(12)], "Churn int, f int")
    rows = distributions.feature_profile(df, ["f"]).collect()
    assert {r.kind for r in rows} == {"crosstab"} and sum(r.y for r in rows) == 12
