"""Business features and the reporting projection: narrow column expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame

from churnlake import spec as S
from churnlake.functions.bands import band_code, charges_band, tenure_group
from churnlake.functions.text import literal, mapped, quoted, rounded, with_expressions


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def service_count(add_ons=S.ADD_ONS) -> str:
    return "(" + " + ".join(_flag(f"{quoted(c)} = 'Yes'") for c in add_ons) + ")"


def add_business_features(df: DataFrame, overflow: str = "lowest") -> DataFrame:
    """The ten engineered columns; ``overflow`` is where values above the last band go."""
    first = with_expressions(df, {
        "ServiceCount": service_count(),
        "AvgMonthlySpend": f"CASE WHEN tenure > 0 THEN {rounded('TotalCharges / tenure', 2)} ELSE MonthlyCharges END",
    })
    return with_expressions(first, {
        "ChargeToTenureRatio": rounded("MonthlyCharges / (AvgMonthlySpend + 1E-6D)", 4),
        "CLV": rounded("TotalCharges", 2),
        "TenureGroup_num": band_code("tenure", S.TENURE_EDGES, overflow),
        "ChargesBand_num": band_code("MonthlyCharges", S.CHARGE_EDGES, overflow),
        "ContractRisk": mapped("Contract", S.CONTRACT_RISK, 1),
        "IsNewCustomer": _flag("tenure <= 12"),
        "IsLongTermCustomer": _flag("tenure > 48"),
        "HasNoAddOns": _flag("ServiceCount = 0"),
    })


def rule_based_risk() -> str:
    """First match wins: month-to-month customers in their first or second year."""
    high, medium, low = (literal(t) for t in S.TIERS)
    monthly = "Contract = 'Month-to-month'"
    return f"CASE WHEN {monthly} AND tenure <= 12 THEN {high} WHEN {monthly} AND tenure <= 24 THEN {medium} ELSE {low} END"


def bi_projection(df: DataFrame, outside: str = S.OUT_OF_RANGE_LABEL) -> DataFrame:
    """Clean table plus the five reporting columns, lead columns first."""
    wide = with_expressions(df, {
        "TenureGroup": tenure_group(outside),
        "ChargesBand": charges_band(outside),
        "CLV": rounded("tenure * MonthlyCharges", 2),
        "RuleBasedRisk": rule_based_risk(),
        "ChurnStatus": mapped("Churn", {1: "Churned", 0: "Active"}),
    })
    return wide.select(*S.BI_LEAD, *[c for c in wide.columns if c not in S.BI_LEAD])
