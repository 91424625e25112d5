"""Cleaning rules on four raw rows, one per rule."""

import pytest

from churnlake.operators import audit, cleaning
from churnlake.sources import sinks, tables

COLUMNS = (
    "customerID string, gender string, SeniorCitizen int, Partner string, Dependents string, tenure int, "
    "PhoneService string, MultipleLines string, InternetService string, OnlineSecurity string, Contract string, "
    "PaymentMethod string, MonthlyCharges double, TotalCharges string, Churn string")
ROWS = [
    ("1-AAA", "Male", 0, "Yes", "No", 1, "No", "No phone service", "DSL", "No", "Month-to-month",
     "Electronic check", 29.85, "29.85", "No"),
    ("2-BBB", "Female", 1, "No", "No", 34, "Yes", "No", "Fiber optic", "No internet service", "One year",
     "Mailed check", 56.95, "1889.50", "No"),
    ("3-CCC", "Male", 0, "Yes", "Yes", 0, "Yes", "Yes", "DSL", "Yes", "Month-to-month",
     "Electronic check", 53.85, " ", "Yes"),
    ("4-DDD", "Female", 0, "No", "No", 58, "Yes", "No", "No", "No internet service", "Two year",
     "Bank transfer", 20.65, "1397.47", "No"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def values(df, column):
    return {r[0]: r[1] for r in df.select("customerID", column).collect()}


def test_charges_become_double_and_blank_becomes_null(raw):
    typed = cleaning.fix_data_types(raw)
    assert dict(typed.dtypes)["TotalCharges"] == "double"
    assert values(typed, "TotalCharges") == {"1-AAA": 29.85, "2-BBB": 1889.5, "3-CCC": None, "4-DDD": 1397.47}
    assert values(typed, "SeniorCitizenLabel")["2-BBB"] == "Yes"


@pytest.mark.parametrize("text, expected", [
    ("", None), (" \t", None), ("  ", None), ("12.5", 12.5), (" 12.5 ", 12.5), ("-3", -3.0), (".5", 0.5),
    ("1e3", 1000.0), ("1d", None), ("2.0f", None), ("abc", None), ("NaN", None), ("1,000", None), (None, None),
])
def test_text_to_double(spark, text, expected):
    df = spark.createDataFrame([(text,)], "TotalCharges string")
    assert cleaning.text_to_double(cleaning.blank_to_null(df, ["TotalCharges"]), ["TotalCharges"]).first()[0] == expected


def test_missing_charges_are_zero(raw):
    filled = cleaning.fill_missing_charges(cleaning.fix_data_types(raw))
    assert values(filled, "TotalCharges")["3-CCC"] == 0.0


def test_duplicates(spark, raw):
    assert cleaning.drop_duplicate_rows(raw).count() == 4
    assert cleaning.drop_duplicate_rows(raw.union(raw.limit(1))).count() == 4
    nulls = spark.createDataFrame([(None, 1), (None, 1), ("a", None), ("a", None)], "k string, v int")
    assert cleaning.drop_duplicate_rows(nulls).count() == 2
    assert audit.duplicate_rows(nulls).first()[0] == 2
    assert audit.duplicate_keys(nulls, "k").first()[0] == 2


def test_standardise(raw):
    clean = cleaning.clean(raw)
    assert set(values(clean, "OnlineSecurity").values()) == {"No", "Yes"}
    assert set(values(clean, "MultipleLines").values()) == {"No", "Yes"}
    assert values(clean, "Churn") == {"1-AAA": 0, "2-BBB": 0, "3-CCC": 1, "4-DDD": 0}
    assert set(values(clean, "ChurnLabel").values()) == {"No", "Yes"}


def test_strip_removes_unicode_space(spark):
    df = spark.createDataFrame([("  a b\t ",), ("\x1c'q'\\\x1f",)], "s string")
    assert [r[0] for r in cleaning.strip_text(df).collect()] == ["a b", "'q'\\"]


def test_dedup_before_and_after_strip(spark, raw):
    padded = spark.createDataFrame([(*ROWS[0][:11], "Electronic check ", *ROWS[0][12:])], COLUMNS)
    both = raw.union(padded)
    assert cleaning.clean(both).count() == 5
    assert cleaning.clean(both, dedup_after_strip=True).count() == 4


def test_unknown_target_and_code_become_null(spark):
    df = spark.createDataFrame([("Maybe", 7), ("Yes", 1)], "Churn string, SeniorCitizen int")
    assert [r[0] for r in cleaning.encode_target(df).select("Churn").collect()] == [None, 1]
    labelled = cleaning.map_flag(df, "SeniorCitizen", "label", {0: "No", 1: "Yes"})
    assert [r[0] for r in labelled.select("label").collect()] == [None, "Yes"]


def test_csv_keeps_blanks_and_types(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    sinks.write_csv(raw, path)
    back = spark.read.schema(raw.schema).option("header", True).csv(path)
    assert sorted(back.collect()) == sorted(raw.collect())
    with pytest.raises(FileNotFoundError):
        tables.read_raw_csv(spark, str(tmp_path / "absent"))
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "absent"))


def test_validation_names_what_fails(raw):
    checks = {r.check: r.passed for r in audit.validate_clean(cleaning.clean(raw), min_rows=4, min_columns=17).collect()}
    assert all(checks.values()) and len(checks) == 6
    twice = cleaning.clean(raw).union(cleaning.clean(raw))
    checks = {r.check: r.passed for r in audit.validate_clean(twice, min_rows=9, min_columns=17).collect()}
    assert not checks["unique_key"] and not checks["enough_rows"] and checks["no_nulls"]
    assert not audit.all_passed(audit.validate_clean(twice))
