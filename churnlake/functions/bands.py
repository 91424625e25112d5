"""Right-closed value bands and risk tiers as ``CASE`` text."""

from __future__ import annotations

from collections.abc import Sequence

from churnlake import spec as S
from churnlake.functions.text import literal


def band(value: str, edges: Sequence[float], labels: Sequence, outside: str) -> str:
    """``labels[i]`` where ``edges[i] < value <= edges[i + 1]``, else the expression ``outside``."""
    cases = " ".join(
        f"WHEN {value} > {low} AND {value} <= {high} THEN {literal(label)}"
        for low, high, label in zip(edges, edges[1:], labels))
    return f"CASE {cases} ELSE {outside} END"


def band_code(value: str, edges: Sequence[float], overflow: str = "lowest") -> str:
    """Position of the band, 0 for values outside all bands.

    ``overflow="top"`` puts values above the last edge into the highest band instead.
    """
    codes = list(range(len(edges) - 1))
    if overflow not in ("lowest", "top"):
        raise ValueError("overflow is 'lowest' or 'top'")
    outside = "0" if overflow == "lowest" else f"CASE WHEN {value} > {edges[-1]} THEN {codes[-1]} ELSE 0 END"
    return band(value, edges, codes, outside)


def tenure_group(outside: str = S.OUT_OF_RANGE_LABEL) -> str:
    return band("tenure", S.TENURE_EDGES, S.TENURE_LABELS, literal(outside))


def charges_band(outside: str = S.OUT_OF_RANGE_LABEL) -> str:
    return band("MonthlyCharges", S.CHARGE_EDGES, S.CHARGE_LABELS, literal(outside))


def risk_tier(probability: str, high: float = S.HIGH_CUTOFF, medium: float = S.MEDIUM_CUTOFF) -> str:
    return (f"CASE WHEN {probability} >= {literal(high)} THEN {literal(S.TIERS[0])} "
            f"WHEN {probability} >= {literal(medium)} THEN {literal(S.TIERS[1])} ELSE {literal(S.TIERS[2])} END")


def tier_order(tier: str) -> str:
    """0, 1, 2 from the highest tier down, for a fixed report order."""
    cases = " ".join(f"WHEN {literal(name)} THEN {i}" for i, name in enumerate(S.TIERS))
    return f"CASE {tier} {cases} ELSE {len(S.TIERS)} END"
