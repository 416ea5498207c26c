"""Risk level, value level and the cohort of a customer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlens.config import (
    CohortConfig, DEFAULT, DEFAULT_RECOMMENDATION, HIGH_RISK, LOW_HIGH, LOW_LOW, MEDIUM_HIGH,
    MEDIUM_LOW, RECOMMENDATIONS, RiskCeiling)
from cohortlens.functions.columns import case, number, quote, with_exprs
from cohortlens.functions.ranks import exact_quantiles


def _under(limit: RiskCeiling) -> str:
    return (f"count_14plus_dpd <= {limit.count_14plus_dpd} "
            f"AND missed_payment_ratio <= {number(limit.missed_payment_ratio)} "
            f"AND maturity_dpd <= {limit.maturity_dpd}")


def risk_level(config: CohortConfig = DEFAULT) -> str:
    """NULL inputs fail every ceiling and end as High."""
    return case([(_under(config.low_risk), "'Low'"), (_under(config.medium_risk), "'Medium'")],
                "'High'")


def value_threshold(df: DataFrame, config: CohortConfig = DEFAULT) -> float | None:
    return exact_quantiles(
        df, ["monthly_loan_volume"], [config.value_percentile])["monthly_loan_volume"][0]


def value_level(threshold: float | None, config: CohortConfig = DEFAULT) -> str:
    if threshold is None:
        return "'Low Value'"
    high = (f"monthly_loan_volume >= {number(threshold)} "
            f"AND repayment_efficiency >= {number(config.repayment_efficiency_min)}")
    return case([(high, "'High Value'")], "'Low Value'")


def combined_segment(risk: str = "risk_level", value: str = "value_level") -> str:
    """Cohort name of a (risk, value) pair of columns; high risk ignores value."""
    names = {("Low", "High Value"): LOW_HIGH, ("Low", "Low Value"): LOW_LOW,
             ("Medium", "High Value"): MEDIUM_HIGH, ("Medium", "Low Value"): MEDIUM_LOW}
    pairs = [(f"{risk} = {quote(r)} AND {value} = {quote(v)}", quote(name))
             for (r, v), name in names.items()]
    return case([(f"{risk} = 'High'", quote(HIGH_RISK)), *pairs], "'Unknown'")


def with_levels(df: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """risk_level and value_level, the threshold taken over exactly these rows."""
    limit = value_threshold(df, config)
    return with_exprs(df, {"risk_level": risk_level(config),
                           "value_level": value_level(limit, config)})


def with_segment(df: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Final cohort of every row."""
    leveled = with_levels(df, config)
    return with_exprs(leveled, {"segment": combined_segment()}).drop("risk_level", "value_level")


def recommendation(segment: str = "segment") -> str:
    return case([(f"{segment} = {quote(name)}", quote(action))
                 for name, action in RECOMMENDATIONS.items()], quote(DEFAULT_RECOMMENDATION))
