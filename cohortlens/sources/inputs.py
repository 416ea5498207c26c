"""The three input tables, from Parquet/CSV files, catalog tables or JDBC."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

LOAN_FACT = T.StructType([
    T.StructField("dw_customer_key", T.LongType(), False),
    T.StructField("loan_ref", T.LongType(), False),
    T.StructField("disbursement_date", T.TimestampNTZType()),
    T.StructField("dw_date_key", T.IntegerType()),
    T.StructField("product_code", T.StringType()),
    T.StructField("maturity_dpd", T.IntegerType()),
    T.StructField("installment_dpd", T.IntegerType()),
    T.StructField("total_amount_overdue", T.DecimalType(18, 4)),
    T.StructField("total_loan_amount", T.DecimalType(18, 2)),
    T.StructField("total_missed_installment", T.IntegerType()),
    T.StructField("tenor_in_months", T.DoubleType()),
    T.StructField("ontime_repayment_rate", T.DoubleType()),
])

CUSTOMER_DIM = T.StructType([
    T.StructField("dw_customer_key", T.LongType(), False),
    T.StructField("age", T.IntegerType()),
    *[T.StructField(c, T.StringType()) for c in (
        "gender", "marital_status", "state", "location", "purpose_of_loan",
        "employment_status", "dw_channel_key", "customer_category")],
])

INCOME_DECISION = T.StructType([
    T.StructField("user_client_id", T.LongType()),
    T.StructField("offer_type", T.StringType()),
    T.StructField("monthly_salary_l6m", T.DoubleType()),
    T.StructField("turnover_last6m_trim", T.DoubleType()),
])


@dataclass(frozen=True)
class Inputs:
    loan_fact: DataFrame
    customer_dim: DataFrame
    income_decision: DataFrame


def from_folder(spark: SparkSession, folder: str, fmt: str = "parquet") -> Inputs:
    """Folder with loan_fact, customer_dim and income_decision tables."""
    def read(name: str, schema: T.StructType) -> DataFrame:
        reader = spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True)
        return reader.format(fmt).load(f"{folder}/{name}")

    return Inputs(read("loan_fact", LOAN_FACT), read("customer_dim", CUSTOMER_DIM),
                  read("income_decision", INCOME_DECISION))


def from_catalog(spark: SparkSession, fact: str, dim: str, decision: str) -> Inputs:
    return Inputs(spark.table(fact), spark.table(dim), spark.table(decision))


def jdbc_table(spark: SparkSession, table: str, key: str, low: int, high: int,
               partitions: int) -> DataFrame:
    """Partitioned JDBC read. Address and login come from the environment."""
    return (spark.read.format("jdbc")
            .option("url", os.environ["COHORTLENS_JDBC_URL"])
            .option("user", os.environ["COHORTLENS_JDBC_USER"])
            .option("password", os.environ["COHORTLENS_JDBC_PASSWORD"])
            .option("dbtable", table)
            .option("partitionColumn", key)
            .option("lowerBound", low).option("upperBound", high)
            .option("numPartitions", partitions)
            .option("fetchsize", 10_000)
            .load())
