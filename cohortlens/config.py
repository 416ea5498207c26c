"""Run parameters. Every threshold of the pipeline lives here, as plain values."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RiskCeiling:
    """Highest values a customer may show and still be in a risk level."""

    count_14plus_dpd: int
    missed_payment_ratio: float
    maturity_dpd: int


# Cohort names in report order, and the action attached to each.
LOW_HIGH = "Low Risk - High Value"
LOW_LOW = "Low Risk - Low Value"
MEDIUM_HIGH = "Medium Risk - High Value"
MEDIUM_LOW = "Medium Risk - Low Value"
HIGH_RISK = "High Risk"
SEGMENTS = (LOW_HIGH, LOW_LOW, MEDIUM_HIGH, MEDIUM_LOW, HIGH_RISK)

RECOMMENDATIONS = {
    "Low Risk - High Value": "Prioritize & reward",
    "Low Risk - Low Value": "Grow value",
    "Medium Risk - High Value": "Monitor risk, retain",
    "Medium Risk - Low Value": "Control exposure",
    "High Risk": "Restrict / red-flag",
}
DEFAULT_RECOMMENDATION = "Further analysis required"

# Columns of the wide profile row, in segment order.
WIDE_PROFILE_COLUMNS = (
    "low_risk_high_value",
    "low_risk_low_value",
    "medium_risk_high_value",
    "medium_risk_low_value",
    "high_risk",
)

# Demographic columns in mining order; the first five are coded.
CODED_DEMOGRAPHICS = (
    "gender",
    "marital_status",
    "purpose",
    "employment_status",
    "dw_channel_key",
)
DEMOGRAPHICS = CODED_DEMOGRAPHICS + ("age_category", "income_bracket")

# Bracket labels, one per half-open income bin.
INCOME_LABELS = (
    "<69k",
    "70k - 149k",
    "150k - 299k",
    "300k - 499k",
    "500k - 799k",
    "800k - 1.19M",
    "1.2M and above",
)


@dataclass(frozen=True)
class CohortConfig:
    excluded_products: tuple[str, ...] = ("DTP", "ON2D")
    customer_category: str = "Individual"
    income_loan_ratio_cap: float = 100.0
    dpd_flag_from: int = 14

    min_age: int = 18
    max_age: int = 65
    age_groups: int = 5
    income_edges: tuple[float, ...] = (
        0.0, 70000.0, 150000.0, 300000.0, 500000.0, 800000.0, 1200000.0,
    )
    income_labels: tuple[str, ...] = INCOME_LABELS

    low_risk: RiskCeiling = field(default=RiskCeiling(0, 0.4, 0))
    medium_risk: RiskCeiling = field(default=RiskCeiling(1, 0.7, 14))
    value_percentile: float = 0.75
    repayment_efficiency_min: float = 0.15

    lift_threshold: float = 1.2
    lift_epsilon: float = 1e-6
    coverage_threshold: float = 0.02
    max_combinations: int = 2

    # False reproduces the known run results: gender codes are not valid gender
    # names, so the second contract check turns every gender into 'Unknown'.
    keep_gender: bool = False
    # False drops rows with a missed payment ratio above 1 (contract check).
    # True keeps them; the risk rules then put them into High Risk.
    keep_overdrawn_ratios: bool = False


DEFAULT = CohortConfig()
