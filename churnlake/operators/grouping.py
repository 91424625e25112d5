"""Grouping sets: ROLLUP, CUBE and free lists of key sets, with subtotals and null keys kept apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a partial value of each kind is made from rows, and merged.
_FIRST = {
    "count": lambda c: {"n": F.count(c)},
    "sum": lambda c: {"s": F.sum(c.cast("decimal(28,4)"))},
    "mean": lambda c: {"s": F.sum(c.cast("decimal(28,4)")), "n": F.count(c)},
    "min": lambda c: {"least": F.min(c)},
    "max": lambda c: {"most": F.max(c)},
}
_MERGE = {"n": F.sum, "s": F.sum, "least": F.min, "most": F.max}


def rollup_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """All keys, all but the last, ..., none."""
    return [tuple(keys[:n]) for n in range(len(keys), -1, -1)]


def cube_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """Every subset of the keys."""
    return [s for n in range(len(keys), -1, -1) for s in combinations(keys, n)]


def _final(kind: str, name: str) -> Column:
    value = {part: _MERGE[part](f"__{name}_{part}") for part in _FIRST[kind](F.lit(0))}
    if kind == "mean":
        return F.try_divide(value["s"].cast("double"), value["n"])
    out = next(iter(value.values()))
    return out.cast("double") if kind == "sum" else out


def grouping_sets(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], measures: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """keys, grouping_id and the measures, one row per group of every set.

    ``measures`` maps a name to (count, sum, mean, min or max; column; None counts rows). In ``grouping_id`` the first key
    is the highest bit; a bit is 1 where the key is summed over, so that a null key and a subtotal are different rows.

    The table is read and combined once, to one row per task and finest group; only these rows, not those of the
    table, are multiplied by the number of sets. Every measure merges, so that no level goes back to the table. Sums are
    exact to four decimals. An empty table gives no row, the grand total included.
    """
    keys = list(keys)
    wanted = [set(s) for s in sets]
    if any(s - set(keys) for s in wanted):
        raise ValueError("a set has a column that is not a key")
    partial = []
    for name, (kind, column) in measures.items():
        if kind not in _FIRST or (column is None and kind != "count"):
            raise ValueError(f"measure {name}: {kind} of {column}")
        source = F.lit(1) if column is None else F.col(f"`{column}`")
        partial += [value.alias(f"__{name}_{part}") for part, value in _FIRST[kind](source).items()]
    finest = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*partial)
    lists = [[F.col(f"`{k}`") for k in keys if k in s] for s in wanted]
    return finest.groupingSets(lists, *[F.col(f"`{k}`") for k in keys]).agg(
        F.grouping_id().alias("grouping_id"),
        *[(F.coalesce(_final(kind, name), F.lit(0)) if kind == "count" else _final(kind, name)).alias(name)
          for name, (kind, _) in measures.items()])


def rollup(df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    return grouping_sets(df, keys, rollup_sets(keys), measures)


def cube(df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    return grouping_sets(df, keys, cube_sets(keys), measures)
