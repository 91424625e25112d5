"""Features, encodings and bands on customers at and beside every band edge."""

import pytest

from churnlake.functions.bands import band_code
from churnlake.operators import encoding, features
from churnlake.spec import ADD_ONS, ENGINEERED, TELCO

METHODS = ["Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check"]
# customer, months, monthly and total charge, contract, internet, add-ons taken, payment method, churned
ROWS = [
    ("none", 0, 0.0, 0.0, "Month-to-month", "No", (), METHODS[0], 0),
    ("low-edge", 12, 35.0, 420.0, "Month-to-month", "DSL", ADD_ONS[:1], METHODS[1], 1),
    ("low-past", 13, 35.01, 455.13, "Month-to-month", "DSL", ADD_ONS[1:3], METHODS[2], 1),
    ("mid-edge", 24, 65.0, 1560.5, "Month-to-month", "Fiber optic", ADD_ONS, METHODS[3], 0),
    ("mid-past", 25, 65.01, 1600.25, "Month-to-month", "Fiber optic", ADD_ONS[4:], METHODS[0], 0),
    ("high-edge", 48, 95.0, 4560.0, "One year", "Fiber optic", ADD_ONS[::2], METHODS[1], 0),
    ("high-past", 49, 95.01, 4700.49, "One year", "DSL", (), METHODS[2], 1),
    ("last-edge", 72, 120.0, 8640.0, "Two year", "Fiber optic", ADD_ONS, METHODS[3], 0),
    ("beyond", 73, 120.01, 8760.73, "Two year", "No", (), METHODS[0], 0),
    ("unknown", None, None, 100.0, "Two year", "DSL", ADD_ONS[:2], METHODS[2], 1),
]


@pytest.fixture(scope="module")
def clean(spark):
    rows = []
    for name, months, monthly, total, contract, internet, taken, method, churn in ROWS:
        rows.append((
            name, "Female", 0, "No", "Yes", "No", months, "Yes", "No", internet, *["Yes" if a in taken else "No" for a in ADD_ONS],
            contract, "Yes", method, monthly, total, churn, "Yes" if churn else "No"))
    return spark.createDataFrame(rows, "customerID string, gender string, SeniorCitizen int, SeniorCitizenLabel string, Partner string,"
                                 " Dependents string, tenure int, PhoneService string, MultipleLines string, InternetService string, "
                                 + ", ".join(f"{a} string" for a in ADD_ONS) + ", Contract string, PaperlessBilling string,"
                                 " PaymentMethod string, MonthlyCharges double, TotalCharges double, Churn int, ChurnLabel string")


@pytest.fixture(scope="module")
def featured(clean):
    return features.add_business_features(clean)


def test_all_features(featured):
    rows = featured.collect()
    assert set(ENGINEERED) <= set(featured.columns)
    for r in rows:
        assert r.ServiceCount == sum(r[a] == "Yes" for a in ADD_ONS)
        assert r.CLV == r.TotalCharges
        known = r.tenure is not None
        assert r.IsNewCustomer == int(known and r.tenure <= 12) and r.IsLongTermCustomer == int(known and r.tenure > 48)
        assert r.HasNoAddOns == int(r.ServiceCount == 0)
        assert r.AvgMonthlySpend == (round(r.TotalCharges / r.tenure, 2) if r.tenure else r.MonthlyCharges)
        assert r.ContractRisk == {"Month-to-month": 2, "One year": 1, "Two year": 0}[r.Contract]


@pytest.mark.parametrize("overflow, expected", [("lowest", [0, 0, 0, 1, 2, 3, 0]), ("top", [0, 0, 0, 1, 2, 3, 3])])
def test_band_edges(spark, overflow, expected):
    df = spark.createDataFrame([(v,) for v in (0, 1, 12, 13, 48, 72, 73)], "tenure int")
    assert [r[0] for r in df.selectExpr(band_code("tenure", (0, 12, 24, 48, 72), overflow)).collect()] == expected
    with pytest.raises(ValueError):
        band_code("tenure", (0, 12), "other")


def test_labels_outside_the_bands(spark, clean):
    bi = features.bi_projection(clean)
    rows = {r.customerID: r for r in bi.collect()}
    assert {k for k, r in rows.items() if r.TenureGroup == "nan"} == {"none", "beyond", "unknown"}
    assert {k for k, r in rows.items() if r.ChargesBand == "nan"} == {"none", "beyond", "unknown"}
    assert [rows[k].TenureGroup for k in ("low-edge", "mid-edge", "high-edge", "last-edge")] == [
        "0–12 months", "13–24 months", "25–48 months", "49–72 months"]
    assert [rows[k].ChargesBand for k in ("low-edge", "low-past", "mid-past", "high-past")] == [
        "Low (<$35)", "Medium ($35–65)", "High ($65–95)", "Premium (>$95)"]
    assert [rows[k].RuleBasedRisk for k in ("low-edge", "low-past", "mid-edge", "mid-past", "high-edge")] == [
        "High Risk", "Medium Risk", "Medium Risk", "Low Risk", "Low Risk"]
    named = features.bi_projection(clean, outside="Unknown")
    assert {r.TenureGroup for r in named.where("tenure = 0").collect()} == {"Unknown"}
    assert bi.columns[:3] == ["customerID", "ChurnStatus", "Churn"] and len(bi.columns) == 28


def test_encoding_leaves_only_numbers(featured):
    encoded = encoding.encode(featured)
    assert "PaymentMethod_Electronic check" in encoded.columns
    assert "PaymentMethod_Bank transfer (automatic)" not in encoded.columns
    final = encoding.drop_non_features(encoded)
    assert not {"customerID", "ChurnLabel", "gender"} & set(final.columns) and "Churn" in final.columns
    assert all(kind in ("int", "bigint", "double") for _, kind in final.dtypes)
    for r in encoded.collect():
        assert {r.Partner, r.PhoneService, r.PaperlessBilling} <= {0, 1} and r.Contract in (0, 1, 2)


def test_saved_columns_decide_the_levels(spark, featured):
    levels = encoding.learn_levels(featured, TELCO.nominal)
    assert levels["PaymentMethod"] == sorted(METHODS)
    trained = encoding.encode(featured, levels)
    batch = featured.where("PaymentMethod <> 'Bank transfer (automatic)'")
    saved = [c for c in trained.columns if c.startswith("PaymentMethod_")]
    scored = encoding.encode_saved(batch, saved)
    assert [c for c in scored.columns if c.startswith("PaymentMethod_")] == saved
    a = {r.customerID: r["PaymentMethod_Electronic check"] for r in trained.collect()}
    assert all(a[r.customerID] == r["PaymentMethod_Electronic check"] for r in scored.collect())


def test_unseen_level_is_all_zero_and_align_adds_zero(spark):
    df = spark.createDataFrame([("x", "New way"), ("y", None)], "customerID string, PaymentMethod string")
    hot = encoding.one_hot(df, {"PaymentMethod": ["a", "b", "c.d (e)"]})
    assert [tuple(r)[1:] for r in hot.collect()] == [(0, 0), (0, 0)]
    aligned = encoding.align(hot, ["missing", "PaymentMethod_c.d (e)"], keep=["customerID"])
    assert aligned.columns == ["customerID", "missing", "PaymentMethod_c.d (e)"]


def test_a_key_is_not_a_category(spark):
    df = spark.range(50).selectExpr("cast(id as string) AS k")
    with pytest.raises(ValueError):
        encoding.learn_levels(df, ["k"], max_levels=10)
    assert encoding.learn_levels(df, ["absent"]) == {}
