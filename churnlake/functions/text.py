"""SQL expression text: one string per derived column keeps a plan cheap to build from Python."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value) -> str:
    """A SQL literal; doubles keep their exact value."""
    if isinstance(value, bool) or value is None:
        return {True: "true", False: "false", None: "NULL"}[value]
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    escaped = "".join(
        c if c.isascii() and c.isprintable() and c not in "\\'" else "".join(f"\\u{unit:04X}" for unit in _units(c))
        for c in str(value))
    return f"'{escaped}'"


def _units(char: str) -> list[int]:
    code = char.encode("utf-16-be")
    return [int.from_bytes(code[i:i + 2], "big") for i in range(0, len(code), 2)]


def mapped(column: str, mapping: Mapping, otherwise=None) -> str:
    """``mapping`` as a CASE; other values become ``otherwise``."""
    cases = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
    return f"CASE {quoted(column)} {cases} ELSE {literal(otherwise)} END"


def with_expressions(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Replace columns in place, append new ones."""
    known = df.columns
    kept = [f"{expressions[c]} AS {quoted(c)}" if c in expressions else quoted(c) for c in known]
    added = [f"{e} AS {quoted(c)}" for c, e in expressions.items() if c not in known]
    return df.selectExpr(*kept, *added)


def rounded(expression: str, digits: int) -> str:
    """Half-even rounding on the scaled value; the text twin of ``numbers.round_even``."""
    return f"(rint(({expression}) * 1E{digits}D) / 1E{digits}D + 0.0D)"
