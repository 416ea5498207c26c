"""One row per customer from the snapshot fact, the dimension and the decisions.

Every aggregate over the fact is pre-aggregated on the map side, and the
distinct loan count is spread over (customer, loan) first, so a customer that
owns a third of all fact rows does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlens.config import CohortConfig, DEFAULT
from cohortlens.functions.columns import nan_to_null, quote
from cohortlens.sources.inputs import Inputs

KEY = "dw_customer_key"

CUSTOMER_COLUMNS = (
    "customer_id", "loan_count", "total_amount_overdue", "maturity_dpd",
    "total_missed_installment", "has_14plus_dpd", "count_14plus_dpd",
    "tenor_in_months", "ontime_repayment_rate", "age", "gender", "marital_status",
    "state", "location", "purpose", "employment_status", "dw_channel_key",
    "total_loan_amount", "income",
)

METRIC_COLUMNS = (
    "loan_count", "total_amount_overdue", "maturity_dpd", "total_missed_installment",
    "has_14plus_dpd", "count_14plus_dpd", "tenor_in_months", "ontime_repayment_rate",
    "total_loan_amount",
)


def included(config: CohortConfig = DEFAULT) -> str:
    """Product is not excluded. NULL codes are neither, so a filter drops them."""
    return f"product_code NOT IN ({', '.join(map(quote, config.excluded_products))})"


def keep_included(fact: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    return fact.where(included(config))


def per_customer(rows: DataFrame, *aggregates: str) -> DataFrame:
    return rows.groupBy(KEY).agg(*[F.expr(a) for a in aggregates])


# Sums run over decimals with ten places, so the result has the same bits
# whatever the order of the tasks. A customer with a value or a sum that they
# cannot hold (infinite, or from 1e28) gets the sum of the doubles instead, as
# it is: no value ends the job. NaN counts as missing.
def _double(c: str) -> str:
    return f"nanvl(cast({c} AS double), NULL)"


def _double_sum(c: str, kept: str) -> str:
    exact = f"try_cast({_double(c)} AS decimal(38,10))"
    return (f"coalesce(if(count({exact}) {kept} = count({_double(c)}) {kept}, "
            f"cast(try_sum({exact}) {kept} AS double), NULL), sum({_double(c)}) {kept})")


def exact_mean(c: str, keep: str = "true") -> str:
    kept = f"FILTER (WHERE {keep})"
    return f"try_divide({_double_sum(c, kept)}, count({_double(c)}) {kept}) AS {c}"


def exact_sum(fact: DataFrame, c: str, keep: str = "true") -> str:
    kept = f"FILTER (WHERE {keep})"
    if dict(fact.dtypes)[c].startswith("decimal"):
        return f"cast(sum({c}) {kept} AS double) AS {c}"
    return f"{_double_sum(c, kept)} AS {c}"


# The newest snapshot date and the highest dpd at it travel as one bigint:
# date * 2^33 + dpd + 2^31 + 1, with 0 in the low part for a NULL dpd. A
# struct would do, but makes Spark sort the fact instead of hashing it.
PACKED_SNAPSHOT = ("cast(dw_date_key AS bigint) * 8589934592 "
                   "+ coalesce(cast(maturity_dpd AS bigint) + 2147483649, 0)")


def snapshot_date(packed: str) -> str:
    return f"cast(floor({packed} / 8589934592BD) AS int)"


def snapshot_dpd(packed: str) -> str:
    return f"cast(nullif(pmod({packed}, 8589934592), 0) - 2147483649 AS int)"


def latest_loan_flag(fact: DataFrame) -> DataFrame:
    """Every fact row, flagged if dated at its customer's newest disbursement.

    An aggregate and a join instead of a window: the maximum is pre-aggregated,
    and AQE may split the fact rows of a hot customer over many tasks.
    """
    newest = per_customer(fact, "max(disbursement_date) AS newest")
    return fact.join(newest, KEY, "left").selectExpr(
        KEY, "loan_ref", "disbursement_date", "product_code",
        "coalesce(disbursement_date = newest, false) AS is_latest")


def latest_loan_customers(fact: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Customers whose overall newest loan is an included product."""
    return per_customer(
        fact, "max(disbursement_date) AS newest",
        f"max(disbursement_date) FILTER (WHERE {included(config)}) AS newest_included",
    ).where("newest = newest_included").select(KEY)


def latest_loan_rows(fact: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Included fact rows dated at the customer's newest disbursement; ties stay."""
    newest = per_customer(fact, "max(disbursement_date) AS disbursement_date")
    return keep_included(fact, config).join(newest, [KEY, "disbursement_date"], "left_semi")


def latest_snapshot_dpd(fact: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Highest maturity_dpd at the customer's newest snapshot date."""
    dated = keep_included(fact, config).where("dw_date_key IS NOT NULL")
    return per_customer(dated, f"max({PACKED_SNAPSHOT}) AS top").selectExpr(
        KEY, f"{snapshot_date('top')} AS latest_date_key", f"{snapshot_dpd('top')} AS maturity_dpd")


def loan_counts(fact: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    return per_customer(keep_included(fact, config), "count(DISTINCT loan_ref) AS loan_count")


def latest_dates(fact: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    return per_customer(keep_included(fact, config), "max(dw_date_key) AS latest_date_key")


def dpd_flags(fact: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    late = f"if(installment_dpd >= {config.dpd_flag_from}, 1, 0)"
    return per_customer(keep_included(fact, config), f"max({late}) AS has_14plus_dpd",
                        f"sum({late}) AS count_14plus_dpd")


def customer_sums(fact: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    return per_customer(
        keep_included(fact, config), exact_sum(fact, "total_amount_overdue"),
        exact_sum(fact, "total_loan_amount"),
        "sum(total_missed_installment) AS total_missed_installment",
        exact_mean("tenor_in_months"), exact_mean("ontime_repayment_rate"))


def customer_metrics(fact: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """All per-customer measures: one fused aggregate, plus the distinct loan count.

    A customer stays only if the newest disbursement over all products equals
    the newest over included products, which is the latest-loan rule.

    The loan count is an aggregate of its own over two narrow columns. Inside
    the fused one Spark would shuffle all measures once per (customer, loan)
    instead of once per customer. Both sides end up partitioned by customer,
    so the join adds no shuffle.
    """
    keep = included(config)
    late = f"if(installment_dpd >= {config.dpd_flag_from}, 1, 0)"
    measures = per_customer(
        fact.withColumn("keep", F.expr(f"coalesce({keep}, false)")),
        "max(disbursement_date) AS newest",
        "max(disbursement_date) FILTER (WHERE keep) AS newest_included",
        f"max({PACKED_SNAPSHOT}) FILTER (WHERE keep) AS top",
        f"max({late}) FILTER (WHERE keep) AS has_14plus_dpd",
        f"sum({late}) FILTER (WHERE keep) AS count_14plus_dpd",
        exact_sum(fact, "total_amount_overdue", "keep"),
        exact_sum(fact, "total_loan_amount", "keep"),
        "sum(total_missed_installment) FILTER (WHERE keep) AS total_missed_installment",
        exact_mean("tenor_in_months", "keep"),
        exact_mean("ontime_repayment_rate", "keep"))
    latest = measures.where("newest = newest_included")
    return latest.join(loan_counts(fact, config), KEY).selectExpr(
        KEY, "loan_count", "total_amount_overdue",
        f"coalesce(cast({snapshot_dpd('top')} AS bigint), 0) AS maturity_dpd",
        "total_missed_installment", "coalesce(has_14plus_dpd, 0) AS has_14plus_dpd",
        "coalesce(count_14plus_dpd, 0) AS count_14plus_dpd", "tenor_in_months",
        "ontime_repayment_rate", "total_loan_amount")


def customer_income(decision: DataFrame) -> DataFrame:
    """Best salary offer of a client, or else the best turnover offer."""
    return (decision.groupBy(F.col("user_client_id").alias(KEY))
            .agg(F.expr("max(monthly_salary_l6m) FILTER (WHERE lower(offer_type) LIKE '%salar%')")
                 .alias("salary"),
                 F.expr("max(turnover_last6m_trim) FILTER "
                        "(WHERE lower(offer_type) LIKE '%turnover%')").alias("turnover"))
            .selectExpr(KEY, "coalesce(salary, turnover) AS income"))


def category_customers(dim: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    return dim.where(f"customer_category = {quote(config.customer_category)}")


def to_contract_columns(wide: DataFrame) -> DataFrame:
    renamed = {"customer_id": KEY, "purpose": "purpose_of_loan"}
    return wide.selectExpr(*[
        f"{renamed[c]} AS {c}" if c in renamed else c for c in CUSTOMER_COLUMNS])


def within_ratio_cap(customers: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """abs(income / loan amount) under the cap; NULL or zero amounts drop the row."""
    return customers.where(
        f"abs(try_divide(income, total_loan_amount)) <= {config.income_loan_ratio_cap}")


def unfiltered_customers(src: Inputs, config: CohortConfig = DEFAULT) -> DataFrame:
    """The 19 columns before the ratio cap; income may be NULL here."""
    metrics = customer_metrics(src.loan_fact, config)
    dim = category_customers(src.customer_dim, config)
    joined = metrics.join(dim, KEY).join(customer_income(src.income_decision), KEY, "left")
    return nan_to_null(to_contract_columns(joined))


def customer_table(src: Inputs, config: CohortConfig = DEFAULT) -> DataFrame:
    return within_ratio_cap(unfiltered_customers(src, config), config)


def registry_customers(src: Inputs, config: CohortConfig = DEFAULT) -> DataFrame:
    """Every customer of the dimension, loans or not: measures may be NULL."""
    joined = (src.customer_dim
              .join(customer_metrics(src.loan_fact, config), KEY, "left")
              .join(customer_income(src.income_decision), KEY, "left"))
    return nan_to_null(to_contract_columns(joined))
