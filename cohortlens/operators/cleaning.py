"""Cleaning steps before and after the first contract check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlens.config import CohortConfig, DEFAULT
from cohortlens.functions.columns import (
    blank_if_null, clip, number, title, to_number, with_exprs)
from cohortlens.functions.ranks import medians
from cohortlens.operators.quality import OPTIONAL_TEXT_FIELDS

# Defaults of missing measures, and ranges of the clipped ones.
FILLS = {
    "total_missed_installment": "0D",
    "total_amount_overdue": "0D",
    "maturity_dpd": "0D",
    "count_14plus_dpd": "0D",
    "ontime_repayment_rate": "100D",
    "age": "30D",
    "tenor_in_months": "1D",
    "has_14plus_dpd": "0D",
}
CLIPS = {"ontime_repayment_rate": ("0D", "100D"), "age": ("18D", "100D"),
         "has_14plus_dpd": ("0D", "1D")}


def filled(c: str) -> str:
    """Number with its default and range."""
    x = to_number(c)
    if c in FILLS:
        x = f"coalesce({x}, {FILLS[c]})"
    return clip(x, *CLIPS[c]) if c in CLIPS else x


def whole_tenor() -> str:
    return f"bround({filled('tenor_in_months')}, 0)"


def binary_flag() -> str:
    return f"cast({filled('has_14plus_dpd')} AS int)"


def text_gender() -> str:
    return title(blank_if_null("gender"))


def fill_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs become the column's median; no pass beyond the count if there are none."""
    gaps = df.agg(*[F.expr(f"count_if({c} IS NULL) AS {c}") for c in columns]).first()
    holes = [c for c in columns if gaps[c]]
    if not holes:
        return df
    middle = medians(df, holes)
    return with_exprs(df, {c: f"coalesce({c}, {number(middle[c])})"
                           for c in holes if middle[c] is not None})


def pre_clean(df: DataFrame) -> DataFrame:
    """Types, defaults and ranges of the raw columns, all but the income median."""
    numbers = ("total_missed_installment", "total_amount_overdue", "total_loan_amount",
               "ontime_repayment_rate", "income", "loan_count", "maturity_dpd",
               "count_14plus_dpd", "age")
    return with_exprs(df, {
        **{c: filled(c) for c in numbers},
        **{c: blank_if_null(c) for c in OPTIONAL_TEXT_FIELDS},
        "tenor_in_months": whole_tenor(),
        "gender": text_gender(),
        "has_14plus_dpd": binary_flag(),
    })


def drop_critical_nulls(df: DataFrame) -> DataFrame:
    return (with_exprs(df, {"gender": title("coalesce(gender, 'Unknown')")})
            .na.drop(subset=["age", "income", "gender"]))


def others_if_blank(df: DataFrame, columns=OPTIONAL_TEXT_FIELDS) -> DataFrame:
    return with_exprs(df, {c: f"coalesce(nullif({c}, ''), 'Others')" for c in columns})


def within_age_range(df: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    return df.where(f"age BETWEEN {config.min_age} AND {config.max_age}")


def fill_numeric(df: DataFrame) -> DataFrame:
    """Second fill. Loan amounts need `fill_medians`, which costs a pass of its own."""
    fills = ("tenor_in_months", "total_missed_installment", "total_amount_overdue",
             "ontime_repayment_rate")
    return with_exprs(df, {
        **{c: f"coalesce({to_number(c)}, {FILLS[c]})" for c in fills},
        "total_loan_amount": to_number("total_loan_amount")})


def clean(df: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """All cleaning between the two contract checks, but for the medians."""
    return fill_numeric(within_age_range(others_if_blank(drop_critical_nulls(df)), config))
