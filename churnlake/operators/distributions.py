"""Moments, outlier fences, histograms, density curves and box statistics in long format.

``by`` is always a column with few values (the target, a risk tier). Tables with one row per group and
feature are the only thing that is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.numbers import adjusted_kurtosis, adjusted_skewness, exact_mean, percent, round_even
from churnlake.operators.quantiles import _match, long_values, quartiles


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std (n-1), min, max, adjusted skewness and kurtosis: one pass for all columns."""
    v = F.col("value")
    return long_values(df, columns, by).groupBy(*by, "feature").agg(
        F.count(v).alias("count"), exact_mean(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        adjusted_skewness(v).alias("skew"), adjusted_kurtosis(v).alias("kurtosis"),
    )


def describe(df: DataFrame, columns: Sequence[str], digits: int = 4, exact: bool = True) -> DataFrame:
    """The describe table with quartiles and shape; floating values rounded to ``digits``."""
    joined = moments(df, columns).join(F.broadcast(quartiles(df, columns, exact=exact)), "feature")
    numbers = ["mean", "std", "min", "q1", "median", "q3", "max", "skew", "kurtosis"]
    return joined.select("feature", "count", *[round_even(F.col(c), digits).alias(c) for c in numbers])


def stats_table(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Report form: two decimals, three for skewness and kurtosis."""
    full = moments(df, columns).join(F.broadcast(quartiles(df, columns, exact=exact)), "feature")
    return full.select(
        "feature",
        *[round_even(F.col(c), 2).alias(c) for c in ("mean", "median", "std", "min", "max")],
        *[round_even(F.col(c), 3).alias(c) for c in ("skew", "kurtosis")],
    )


def fences(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), exact: bool = True,
           whisker: float = 1.5) -> DataFrame:
    """Quartiles with the outlier limits ``whisker`` inter-quartile ranges beyond them."""
    q = quartiles(df, columns, by, exact)
    iqr = F.col("q3") - F.col("q1")
    return q.withColumns({
        "iqr": iqr,
        "lower": F.col("q1") - F.lit(whisker) * iqr,
        "upper": F.col("q3") + F.lit(whisker) * iqr,
    })


def outliers(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Limits and the number of values beyond them; nothing is removed."""
    values = _match(long_values(df, columns), fences(df, columns, exact=exact), ["feature"])
    beyond = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return values.groupBy("feature", "q1", "q3", "iqr", "lower", "upper").agg(
        F.count_if(beyond).alias("outliers"))


def outlier_report(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Rounded limits, and outliers as a percentage of all rows (null values included)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return outliers(df, columns, exact).select(
        "feature",
        *[round_even(F.col(c), 2).alias(c) for c in ("q1", "q3", "iqr", "lower", "upper")],
        "outliers", percent(F.col("outliers"), total).alias("outlier_pct"),
    )


def _edge(index: Column, low: Column, high: Column, bins: int) -> Column:
    """Left edge of bin ``index`` on an evenly spaced grid whose last edge is exactly ``high``."""
    step = (high - low) / F.lit(float(bins))
    return F.when(index >= bins, high).otherwise(index * step + low)


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1; bins are left-closed and the last one is closed on both sides."""
    raw = F.least(F.floor((value - low) / (high - low) * F.lit(float(bins))), F.lit(bins - 1))
    down = F.when(value < _edge(raw, low, high, bins), 1).otherwise(0)
    up = F.when((value >= _edge(raw + 1, low, high, bins)) & (raw != bins - 1), 1).otherwise(0)
    return (raw - down + up).cast("int")


def histogram(df: DataFrame, columns: Sequence[str], bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts per equal-width bin, each group on its own range, empty bins included.

    Two column-pruned passes: the range, then counts that are summed on the map side.
    """
    keys = [*by, "feature"]
    values = long_values(df, columns, by)
    seen = values.groupBy(*keys).agg(F.min("value").alias("min"), F.max("value").alias("max"))
    flat = F.col("min") == F.col("max")
    ranges = seen.select(
        *keys,
        F.when(flat, F.col("min") - 0.5).otherwise(F.col("min")).alias("low"),
        F.when(flat, F.col("max") + 0.5).otherwise(F.col("max")).alias("high"),
    )
    counted = (
        _match(values, ranges, keys)
        .groupBy(*keys, "low", "high", bin_index(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_group = counted.groupBy(*keys, "low", "high").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin"))
    grid = per_group.select(*keys, "low", "high", "by_bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    low, high = F.col("low"), F.col("high")
    return grid.select(
        *keys, "bin",
        _edge(F.col("bin"), low, high, bins).alias("bin_low"),
        _edge(F.col("bin") + 1, low, high, bins).alias("bin_high"),
        F.coalesce(F.col("by_bin")[F.col("bin")], F.lit(0)).alias("n"),
    )


def density(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), points: int = 1000,
    range_pad: float = 0.5, bandwidth_pad: float = 0.0, digits: int = 9,
) -> DataFrame:
    """Gaussian density estimate with Scott's bandwidth, n^(-1/5) times the sample standard deviation.

    The grid has ``points`` points and reaches ``range_pad`` times the data range plus ``bandwidth_pad``
    bandwidths beyond the data. Equal values are merged first, and a value only meets the grid points at
    which its kernel does not underflow to zero, so the work is one pass over distinct values with map-side
    sums. Groups without spread have no density and give no rows.
    """
    keys = [*by, "feature"]
    values = long_values(df, columns, by)
    stats = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("value").alias("sd"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    ).where(F.col("sd") > 0)
    h = F.pow(F.col("n").cast("double"), F.lit(-0.2)) * F.col("sd")
    pad = (F.col("max") - F.col("min")) * F.lit(range_pad) + F.lit(bandwidth_pad) * F.col("h")
    grid = stats.withColumn("h", h).select(
        *keys, "n", "h", (F.col("min") - pad).alias("start"),
        ((F.col("max") + pad - (F.col("min") - pad)) / F.lit(float(points - 1))).alias("step"),
    )
    merged = values.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("copies"))
    reach = F.lit(39.0) * F.col("h")
    first = F.greatest(F.lit(0), F.floor((F.col("value") - reach - F.col("start")) / F.col("step"))).cast("int")
    last = F.least(
        F.lit(points - 1), F.ceil((F.col("value") + reach - F.col("start")) / F.col("step"))).cast("int")
    distance = (F.col("start") + F.col("point") * F.col("step") - F.col("value")) / F.col("h")
    kernel = F.col("copies") * F.exp(F.lit(-0.5) * distance * distance)
    sums = (
        _match(merged, grid, keys)
        .select("*", F.explode(F.sequence(first, last)).alias("point"))
        .groupBy(*keys, "n", "h", "start", "step", "point").agg(F.sum(kernel).alias("total"))
    )
    per_group = sums.groupBy(*keys, "n", "h", "start", "step").agg(
        F.map_from_entries(F.collect_list(F.struct("point", "total"))).alias("by_point"))
    scale = F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi())
    return per_group.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    ).select(
        *keys, "point",
        round_even(F.col("start") + F.col("point") * F.col("step"), 6).alias("x"),
        round_even(F.coalesce(F.col("by_point")[F.col("point")], F.lit(0.0)) / scale, digits).alias("density"),
    )


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Quartiles, whiskers (furthest values inside the limits, never inside the box) and flier count."""
    keys = [*by, "feature"]
    values = _match(long_values(df, columns, by), fences(df, columns, by, exact), keys)
    inside = F.col("value").between(F.col("lower"), F.col("upper"))
    found = values.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("low"),
        F.max(F.when(inside, F.col("value"))).alias("high"),
        F.count_if(~inside).alias("fliers"),
    )
    return found.select(
        *keys, *[round_even(F.col(c), 4).alias(c) for c in ("q1", "median", "q3")],
        round_even(F.least("low", "q1"), 4).alias("whisker_low"),
        round_even(F.greatest("high", "q3"), 4).alias("whisker_high"),
        "fliers",
    )


def violin(df: DataFrame, columns: Sequence[str], by: Sequence[str], points: int = 100) -> DataFrame:
    """Density outline two bandwidths beyond the data, with the quartile lines as further rows."""
    keys = [*by, "feature"]
    outline = density(df, columns, by, points=points, range_pad=0.0, bandwidth_pad=2.0).select(
        *keys, F.lit("outline").alias("part"), "point", "x", "density")
    lines = quartiles(df, columns, by).unpivot(keys, ["q1", "median", "q3"], "part", "x").select(
        *keys, "part", F.lit(0).alias("point"), round_even(F.col("x"), 6).alias("x"),
        F.lit(None).cast("double").alias("density"))
    return outline.unionByName(lines)


def feature_profile(
    df: DataFrame, columns: Sequence[str], target: str = "Churn", max_levels: int = 6, points: int = 1000,
) -> DataFrame:
    """Crosstab for features with few values, density per class for the others: (kind, feature, class, x, y).

    Sketches rule out the clearly continuous features, so exact distinct counts are only taken of the rest.
    """
    sketch = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`"), 0.02).alias(c) for c in columns]).first()
    near = [c for c in columns if sketch[c] <= 4 * max_levels]
    exact = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(c) for c in near]).first() if near else {}
    few = [c for c in near if exact[c] <= max_levels]
    many = [c for c in columns if c not in few]
    parts = []
    if few:
        parts.append(
            long_values(df, few, [target]).where(F.col(target).isNotNull())
            .groupBy(target, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit("crosstab").alias("kind"), "feature", F.col(target).alias("target"),
                    F.col("value").alias("x"), F.col("n").cast("double").alias("y")))
    if many:
        parts.append(
            density(df.where(F.col(target).isNotNull()), many, [target], points)
            .select(F.lit("density").alias("kind"), "feature", F.col(target).alias("target"), "x",
                    F.col("density").alias("y")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def binned_points(
    df: DataFrame, x: str, y: str, bins: int = 50, by: Sequence[str] = (),
) -> DataFrame:
    """Point cloud as counts per cell of a ``bins`` by ``bins`` grid over the whole range."""
    ends = df.agg(F.struct(
        F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))).scalar()
    r = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *by, F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py"), ends.alias("ends"))

    def cell(value, low, high):
        flat = F.col(low) == F.col(high)
        return F.when(flat, F.lit(0)).otherwise(bin_index(F.col(value), F.col(low), F.col(high), bins))

    return r.groupBy(
        *by, cell("px", "ends.x0", "ends.x1").alias("x_bin"), cell("py", "ends.y0", "ends.y1").alias("y_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))
