"""Cleaning rules. All but the de-duplication are narrow and fuse into one stage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from churnlake import spec as S
from churnlake.functions.text import literal, mapped, quoted, with_expressions

# What counts as a number in text.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _stripped(expression: str) -> str:
    return f"trim(BOTH {literal(S.WHITESPACE)} FROM {expression})"


def blank_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Empty or white-space-only text becomes null."""
    return with_expressions(df, {
        c: f"CASE WHEN {_stripped(quoted(c))} <> '' THEN {quoted(c)} END" for c in columns})


def text_to_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Text to double; anything that is not a finite number becomes null instead of failing."""
    def parsed(name: str) -> str:
        text = _stripped(f"CAST({quoted(name)} AS STRING)")
        return f"CASE WHEN {text} RLIKE '{NUMBER_PATTERN}' THEN try_cast({text} AS DOUBLE) END"

    return with_expressions(df, {c: parsed(c) for c in columns})


def map_flag(df: DataFrame, source: str, result: str, mapping: Mapping) -> DataFrame:
    """A readable copy of a coded column; unknown codes become null."""
    return with_expressions(df, {result: mapped(source, mapping)})


def fix_data_types(df: DataFrame) -> DataFrame:
    """TotalCharges from text to double, and a Yes/No copy of the senior flag."""
    typed = text_to_double(blank_to_null(df, ["TotalCharges"]), ["TotalCharges"])
    return map_flag(typed, "SeniorCitizen", "SeniorCitizenLabel", {0: "No", 1: "Yes"})


def fill_missing_charges(df: DataFrame) -> DataFrame:
    """A customer without a bill yet has paid 0."""
    return df.fillna({"TotalCharges": 0.0})


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact copies of a row collapse to one; copies are merged on the map side before the shuffle."""
    return df.dropDuplicates()


def strip_text(df: DataFrame) -> DataFrame:
    """Trim white space from every text column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return with_expressions(df, {c: _stripped(quoted(c)) for c in names})


def collapse_verbose_no(df: DataFrame, columns: Iterable[str] = (*S.ADD_ONS, "MultipleLines")) -> DataFrame:
    """"No internet service" and "No phone service" become plain "No"."""
    verbose = ", ".join(literal(v) for v in S.VERBOSE_NO)
    present = [c for c in columns if c in df.columns]
    return with_expressions(df, {
        c: f"CASE WHEN {quoted(c)} IN ({verbose}) THEN 'No' ELSE {quoted(c)} END" for c in present})


def encode_target(df: DataFrame, target: str = "Churn", label: str = "ChurnLabel") -> DataFrame:
    """Keep the text as ``label`` and code the target 1/0; unknown text becomes null."""
    return with_expressions(df, {label: quoted(target), target: mapped(target, {"Yes": 1, "No": 0})})


def standardise(df: DataFrame) -> DataFrame:
    return encode_target(collapse_verbose_no(strip_text(df)))


def clean(df: DataFrame, dedup_after_strip: bool = False) -> DataFrame:
    """The whole chain. Copies are removed before trimming, so rows that differ only in blanks stay;
    ``dedup_after_strip`` merges those too, at the price of a second shuffle."""
    result = standardise(drop_duplicate_rows(fill_missing_charges(fix_data_types(df))))
    return drop_duplicate_rows(result) if dedup_after_strip else result
