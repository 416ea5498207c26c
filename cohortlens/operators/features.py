"""Payment and value features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlens.functions.columns import (
    clip_or_null, finite, number, one_if_zero, with_exprs)
from cohortlens.functions.ranks import medians
from cohortlens.operators.quality import FEATURE_FIELDS, require_columns

# Fixed value: keeps the denominators away from zero.
EPSILON = "1e-6D"


def ratio(top: str, bottom: str) -> str:
    return f"try_divide(cast({top} AS double), cast({bottom} AS double) + {EPSILON})"


def payment_features(df: DataFrame, guard_zero: bool = True, clipped: bool = True) -> DataFrame:
    """Missed payment ratio, overdue utilization, monthly volume, repayment efficiency."""
    require_columns(df)
    tenor, loan = "tenor_in_months", "total_loan_amount"
    if guard_zero:
        tenor, loan = one_if_zero(tenor), one_if_zero(loan)
    missed = ratio("total_missed_installment", tenor)
    overdue = ratio("total_amount_overdue", loan)
    ontime = "ontime_repayment_rate / 100"
    if clipped:
        missed, overdue = clip_or_null(missed, high="10D"), clip_or_null(overdue, high="1D")
        ontime = clip_or_null(ontime, "0D", "1D")
    return with_exprs(df, {
        "missed_payment_ratio": missed,
        "overdue_utilization": overdue,
        "monthly_loan_volume": ratio("total_loan_amount", tenor),
        "repayment_efficiency": ontime,
    })


def fill_feature_gaps(df: DataFrame) -> DataFrame:
    """Non-finite features become the column's median; one extra pass only if any exist."""
    usable = with_exprs(df, {c: finite(c) for c in FEATURE_FIELDS})
    gaps = usable.agg(*[F.expr(f"count_if({c} IS NULL) AS {c}") for c in FEATURE_FIELDS]).first()
    holes = [c for c in FEATURE_FIELDS if gaps[c]]
    if not holes:
        return usable
    middle = medians(usable, holes)
    return with_exprs(usable, {c: f"coalesce({c}, {number(middle[c])})"
                               for c in holes if middle[c] is not None})


def with_revenue(df: DataFrame) -> DataFrame:
    return with_exprs(df, {"revenue": "total_loan_amount - total_amount_overdue"})


# Behaviour features that are scaled and averaged.
CLUSTER_FEATURES = ("count_14plus_dpd", "maturity_dpd", "missed_payment_ratio",
                    "overdue_utilization", "ontime_repayment_rate")


def z_scores(df: DataFrame, columns=CLUSTER_FEATURES) -> DataFrame:
    """Population z-scores; a constant column is only centred. One aggregate pass."""
    row = df.agg(*[F.expr(f"avg(cast({c} AS double)) AS {c}_mean") for c in columns],
                 *[F.expr(f"stddev_pop(cast({c} AS double)) AS {c}_sd") for c in columns]).first()
    if row[f"{columns[0]}_mean"] is None:
        return df
    return with_exprs(df, {
        c: f"(cast({c} AS double) - {number(row[f'{c}_mean'])}) / {number(row[f'{c}_sd'] or 1.0)}"
        for c in columns})
