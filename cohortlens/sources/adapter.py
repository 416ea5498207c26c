"""Maps the order tables of the test data to the three loan inputs.

There are no loan tables in the test data, so every registered query starts
from this fixed row-by-row mapping (FIXTURES.md, section 3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.sources.inputs import Inputs


def loan_fact(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    missed = ("l_returnflag = 'R' AND l_linestatus = 'O' AND l_discount >= 0.08D")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).selectExpr(
        "o_custkey AS dw_customer_key",
        "l_orderkey AS loan_ref",
        "o_orderdate AS disbursement_date",
        "year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS dw_date_key",
        """CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'ON2D'
                WHEN o_orderpriority = '5-LOW' THEN 'DTP' ELSE 'TERM' END AS product_code""",
        """if(l_returnflag = 'R' AND l_discount >= 0.05D, cast(l_quantity AS int), 0)
           AS maturity_dpd""",
        f"if({missed} AND l_tax >= 0.05D, l_linenumber + 14, 0) AS installment_dpd",
        "if(l_returnflag = 'R', l_extendedprice * l_discount, 0D) AS total_amount_overdue",
        "l_extendedprice AS total_loan_amount",
        f"if({missed}, 1, 0) AS total_missed_installment",
        "cast(l_linenumber AS double) AS tenor_in_months",
        "if(l_returnflag = 'A', l_discount * 1000D, 0D) AS ontime_repayment_rate",
    )


def customer_dim(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return customer.join(places, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "c_custkey AS dw_customer_key",
        "cast(16 + (c_custkey * 37) % 60 AS int) AS age",
        """CASE WHEN c_custkey % 10 <= 5 THEN 'male' WHEN c_custkey % 10 <= 8 THEN ' FEMALE '
           END AS gender""",
        """CASE c_nationkey % 7 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' WHEN 2 THEN 'Divorced'
           WHEN 3 THEN 'Widowed' WHEN 4 THEN 'Separated' END AS marital_status""",
        "n_name AS state",
        "r_name AS location",
        "lower(c_mktsegment) AS purpose_of_loan",
        """CASE WHEN c_acctbal < 0 THEN 'UNEMPLOYED' WHEN c_acctbal < 4000 THEN 'EMPLOYED'
                WHEN c_acctbal < 8000 THEN 'SELF_EMPLOYED' END AS employment_status""",
        "if(c_custkey % 9 != 8, concat('CH', c_custkey % 9), NULL) AS dw_channel_key",
        "if(c_mktsegment = 'MACHINERY', 'Corporate', 'Individual') AS customer_category",
    )


def income_decision(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_custkey AS user_client_id",
        """CASE o_orderstatus WHEN 'F' THEN 'Salary Advance' WHEN 'O' THEN 'TURNOVER loan'
           WHEN 'P' THEN 'Other' END AS offer_type""",
        "o_totalprice * (1 + o_custkey % 5) / 2 AS monthly_salary_l6m",
        "o_totalprice * (1 + o_custkey % 4) AS turnover_last6m_trim",
    )


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    orders = table("orders")
    return Inputs(
        loan_fact(table("lineitem"), orders),
        customer_dim(table("customer"), table("nation"), table("region")),
        income_decision(orders),
    )
