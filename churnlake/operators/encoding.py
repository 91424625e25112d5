"""Text to numbers: flags, ordinal codes and named one-hot columns with a saved vocabulary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.text import mapped, quoted, with_expressions
from churnlake.spec import TELCO, ChurnSpec

Levels = dict[str, list[str]]


def encode_binary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Yes is 1; No and everything else is 0."""
    return with_expressions(df, {c: mapped(c, {"Yes": 1}, 0) for c in columns if c in df.columns})


def encode_ordinal(df: DataFrame, orders: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Codes from fixed maps, 0 for unknown text."""
    return with_expressions(df, {c: mapped(c, order, 0) for c, order in orders.items() if c in df.columns})


def level_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct (feature, value) pairs, reduced on the map side first."""
    return (
        df.selectExpr(*[f"CAST({quoted(c)} AS STRING) AS {quoted(c)}" for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .distinct()
    )


def learn_levels(df: DataFrame, columns: Sequence[str], max_levels: int = 256) -> Levels:
    """Sorted levels per column: the fitted state of the one-hot encoder.

    At most ``max_levels`` per column reach the driver. A column with more is an error, not a cut: such a
    column is a key, not a category.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    found = level_pairs(df, present).limit(max_levels * len(present) + 1).collect()
    levels = {c: sorted(row.value for row in found if row.feature == c) for c in present}
    too_many = [c for c, values in levels.items() if len(values) > max_levels]
    if too_many or len(found) > max_levels * len(present):
        raise ValueError(f"more than {max_levels} levels, not a category: {too_many or present}")
    return levels


def one_hot(df: DataFrame, levels: Levels, drop_first: bool = True) -> DataFrame:
    """0/1 columns ``<column>_<level>`` for all levels but the first; the text columns are replaced."""
    added = [
        f"{mapped(name, {value: 1}, 0)} AS {quoted(f'{name}_{value}')}"
        for name, values in levels.items() for value in values[1 if drop_first else 0:]
    ]
    return df.selectExpr(*[quoted(c) for c in df.columns if c not in levels], *added)


def levels_of_columns(columns: Sequence[str], nominal: Sequence[str] = TELCO.nominal) -> Levels:
    """The levels behind a saved column list. Scoring uses them, never the levels that a batch happens to hold."""
    return {n: [c[len(n) + 1:] for c in columns if c.startswith(f"{n}_")] for n in nominal}


def encode_saved(df: DataFrame, columns: Sequence[str], spec: ChurnSpec = TELCO) -> DataFrame:
    """Encode for a model that was trained on ``columns``; no pass over the data."""
    coded = encode_ordinal(encode_binary(df, spec.binary), spec.ordinal)
    return one_hot(coded, levels_of_columns(columns, spec.nominal), drop_first=False)


def encode(df: DataFrame, levels: Levels | None = None, spec: ChurnSpec = TELCO) -> DataFrame:
    """All three encodings. Pass the ``levels`` learned in training when scoring new data."""
    if levels is None:
        levels = learn_levels(df, spec.nominal)
    return one_hot(encode_ordinal(encode_binary(df, spec.binary), spec.ordinal), levels)


def drop_non_features(df: DataFrame, spec: ChurnSpec = TELCO, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the key, copies of the target and columns that a feature replaces, where present."""
    return df.drop(*[c for c in spec.drop if c not in keep])


def align(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``columns`` in that order, 0 for the ones that are missing."""
    present = set(df.columns)
    return df.selectExpr(
        *[quoted(c) for c in keep],
        *[quoted(c) if c in present else f"0 AS {quoted(c)}" for c in columns],
    )
