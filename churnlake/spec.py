"""Column roles, fixed vocabularies and business thresholds.

``ChurnSpec`` names the roles of the columns so that every operator can run on
another customer table; ``TELCO`` is the table the package ships defaults for.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column roles of the customer table.
CATEGORICAL = (
    "gender", "Partner", "Dependents", "PhoneService", "MultipleLines",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
    "PaperlessBilling", "PaymentMethod",
)
NUMERIC = ("tenure", "MonthlyCharges", "TotalCharges")
ADD_ONS = (
    "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies",
)
BINARY = ("Partner", "Dependents", "PhoneService", "PaperlessBilling", "SeniorCitizenLabel")
NOMINAL = (
    "PaymentMethod", "MultipleLines", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
)
DROP_BEFORE_TRAINING = (
    "customerID", "ChurnLabel", "ChurnStatus", "SeniorCitizen",
    "gender", "TenureGroup", "ChargesBand", "RuleBasedRisk",
)
ENGINEERED = (
    "ServiceCount", "AvgMonthlySpend", "ChargeToTenureRatio", "CLV",
    "TenureGroup_num", "ChargesBand_num", "ContractRisk",
    "IsNewCustomer", "IsLongTermCustomer", "HasNoAddOns",
)
SCALED = ("tenure", "MonthlyCharges", "TotalCharges", "AvgMonthlySpend", "ChargeToTenureRatio", "CLV")
SEGMENTS = (
    "gender", "SeniorCitizenLabel", "Partner", "Dependents",
    "PhoneService", "MultipleLines", "InternetService",
    "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies",
    "Contract", "PaperlessBilling", "PaymentMethod",
)
FOCUS_SEGMENTS = (
    "Contract", "PaymentMethod", "InternetService", "SeniorCitizenLabel",
    "gender", "Partner", "Dependents",
)
BI_LEAD = (
    "customerID", "ChurnStatus", "Churn", "gender", "SeniorCitizenLabel", "Partner",
    "Dependents", "tenure", "TenureGroup", "Contract", "PaymentMethod", "PaperlessBilling",
    "InternetService", "PhoneService", "MonthlyCharges", "ChargesBand", "TotalCharges", "CLV",
    "RuleBasedRisk",
)
PREDICTION_CONTEXT = (
    "gender", "SeniorCitizenLabel", "Partner", "Dependents", "Contract", "PaymentMethod",
    "InternetService", "PhoneService", "PaperlessBilling", "OnlineSecurity", "TechSupport",
    "MultipleLines", "StreamingTV", "StreamingMovies",
)

# Text that means "no add-on".
VERBOSE_NO = ("No internet service", "No phone service")

# Ordinal codes.
CONTRACT_ORDER = {"Month-to-month": 0, "One year": 1, "Two year": 2}
INTERNET_ORDER = {"No": 0, "DSL": 1, "Fiber optic": 2}
CONTRACT_RISK = {"Month-to-month": 2, "One year": 1, "Two year": 0}

# Right-closed band edges and their labels.
TENURE_EDGES = (0, 12, 24, 48, 72)
TENURE_LABELS = ("0–12 months", "13–24 months", "25–48 months", "49–72 months")
CHARGE_EDGES = (0, 35, 65, 95, 120)
CHARGE_LABELS = ("Low (<$35)", "Medium ($35–65)", "High ($65–95)", "Premium (>$95)")
OUT_OF_RANGE_LABEL = "nan"

# Risk tiers, highest first.
TIERS = ("High Risk", "Medium Risk", "Low Risk")

# Decision threshold, tier cut-offs, expected lifetime.
THRESHOLD = 0.40
HIGH_CUTOFF = 0.70
MEDIUM_CUTOFF = 0.40
EXPECTED_LIFETIME_MONTHS = 36

# Characters removed from both ends of a text value (everything Unicode calls white space).
WHITESPACE = "".join(chr(c) for c in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
))


def _raw_schema() -> T.StructType:
    s, i, d = T.StringType(), T.IntegerType(), T.DoubleType()
    fields = [
        ("customerID", s), ("gender", s), ("SeniorCitizen", i), ("Partner", s), ("Dependents", s),
        ("tenure", i), ("PhoneService", s), ("MultipleLines", s), ("InternetService", s),
        ("OnlineSecurity", s), ("OnlineBackup", s), ("DeviceProtection", s), ("TechSupport", s),
        ("StreamingTV", s), ("StreamingMovies", s), ("Contract", s), ("PaperlessBilling", s),
        ("PaymentMethod", s), ("MonthlyCharges", d), ("TotalCharges", s), ("Churn", s),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


RAW_SCHEMA = _raw_schema()


@dataclass(frozen=True)
class ChurnSpec:
    """Which column plays which role."""

    key: str = "customerID"
    target: str = "Churn"
    target_label: str = "ChurnLabel"
    numeric: tuple[str, ...] = NUMERIC
    add_ons: tuple[str, ...] = ADD_ONS
    binary: tuple[str, ...] = BINARY
    nominal: tuple[str, ...] = NOMINAL
    ordinal: dict = field(default_factory=lambda: {"Contract": CONTRACT_ORDER, "InternetService": INTERNET_ORDER})
    segments: tuple[str, ...] = SEGMENTS
    drop: tuple[str, ...] = DROP_BEFORE_TRAINING
    scaled: tuple[str, ...] = SCALED


TELCO = ChurnSpec()
