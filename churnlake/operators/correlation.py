"""Pearson correlations, all pairs of a table in one aggregate.

Spark's ``corr`` fails on a constant column under ANSI rules; here such a column has a null correlation.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.numbers import round_even
from churnlake.functions.text import literal, quoted, rounded


def pearson(a: str, b: str) -> str:
    """Correlation over the rows where both values are present; null when either does not vary there."""
    def variance(x: str) -> str:
        return f"var_pop(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {x} END)"

    return f"try_divide(covar_pop({a}, {b}), sqrt({variance(a)} * {variance(b)}))"


def correlation_pairs(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """(a, b, r) for every ordered pair, the diagonal included; a pair uses the rows where both are present.

    A first pass brings one row to the driver: size, and per column its count, mean and range. The second sums
    products of the centred values, which needs one number per pair instead of a moment buffer per pair.
    """
    size = range(len(columns))
    numbers = df.selectExpr(*[f"CAST({quoted(c)} AS DOUBLE) AS c{i}" for i, c in enumerate(columns)])
    facts = numbers.selectExpr("count(1) AS n", *[
        f"{name}(c{i}) AS {name}{i}" for i in size for name in ("count", "avg", "min", "max")]).first()
    n = facts["n"]
    full = [facts[f"count{i}"] == n for i in size]
    centre = [(facts[f"min{i}"] if facts[f"min{i}"] == facts[f"max{i}"] else facts[f"avg{i}"]) or 0.0 for i in size]
    z = numbers.selectExpr(*[f"c{i} - {literal(float(centre[i]))} AS z{i}" for i in size])

    sums = []
    for i in size:
        sums += [f"sum(z{i}) AS s{i}", f"sum(z{i} * z{i}) AS p{i}_{i}"] if full[i] else [f"var_pop(z{i}) AS v{i}"]
    for i, j in combinations(size, 2):
        sums.append(f"sum(z{i} * z{j}) AS p{i}_{j}" if full[i] and full[j] else f"{pearson(f'z{i}', f'z{j}')} AS r{i}_{j}")
    one = z.selectExpr(*sums)

    def spread(i: int, j: int) -> str:
        """Centred sum of products of two complete columns."""
        return f"(p{i}_{j} - try_divide(s{i} * s{j}, {literal(float(n))}))"

    def cell(i: int, j: int) -> str:
        i, j = min(i, j), max(i, j)
        if i == j:
            return f"CASE WHEN {spread(i, i) if full[i] else f'v{i}'} > 0 THEN 1.0D END"
        if full[i] and full[j]:
            return f"try_divide({spread(i, j)}, sqrt(greatest({spread(i, i)}, 0.0D) * greatest({spread(j, j)}, 0.0D)))"
        return f"r{i}_{j}"

    entries = ", ".join(
        f"named_struct('a', {literal(a)}, 'b', {literal(b)}, 'r', {rounded(cell(i, j), digits)})"
        for i, a in enumerate(columns) for j, b in enumerate(columns))
    return one.selectExpr(f"inline(array({entries}))")


def target_correlation(df: DataFrame, columns: Sequence[str], target: str = "Churn", digits: int = 6) -> DataFrame:
    """Signed correlation of each column with the target, ascending."""
    numbers = df.selectExpr(
        f"CAST({quoted(target)} AS DOUBLE) AS label", *[f"CAST({quoted(c)} AS DOUBLE) AS c{i}" for i, c in enumerate(columns)])
    one = numbers.selectExpr(*[f"{pearson(f'c{i}', 'label')} AS r{i}" for i in range(len(columns))])
    entries = ", ".join(
        f"named_struct('feature', {literal(c)}, 'r', {rounded(f'r{i}', digits)})" for i, c in enumerate(columns))
    return one.selectExpr(f"inline(array({entries}))").orderBy("r", "feature")


def importance_preview(df: DataFrame, columns: Sequence[str], target: str = "Churn", top: int = 20) -> DataFrame:
    """The ``top`` features by absolute correlation with the target, four decimals."""
    strength = target_correlation(df, columns, target, 12).select(
        "feature", round_even(F.abs("r"), 4).alias("abs_correlation"))
    return strength.orderBy(F.col("abs_correlation").desc_nulls_last(), "feature").limit(top)
