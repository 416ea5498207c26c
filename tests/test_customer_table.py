"""Hand-made fact rows for the rules of the extract."""

import datetime as dt
from decimal import Decimal

import pytest

from cohortlens.operators import customer_table as ct
from cohortlens.sources.inputs import CUSTOMER_DIM, INCOME_DECISION, LOAN_FACT, Inputs

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)


def fact_row(k, loan=1, date=D1, key=20240101, product="TERM", dpd=0, inst=0, overdue="0",
             amount="1000", missed=0, tenor=6.0, ontime=50.0):
    return (k, loan, date, key, product, dpd, inst, Decimal(overdue), Decimal(amount), missed,
            tenor, ontime)


def dim_row(k, category="Individual", age=30):
    return (k, age, "male", None, "S", "L", "p", None, None, category)


@pytest.fixture(scope="module")
def src(spark):
    facts = [
        fact_row(1, product=None), fact_row(1, loan=2),                    # NULL product excluded
        fact_row(2, date=D1), fact_row(2, loan=2, date=D2, product="DTP"),  # newest excluded
        fact_row(3, key=20240301, dpd=2), fact_row(3, loan=2, key=20240301, dpd=9),
        fact_row(3, loan=2, key=20240201, dpd=50),                         # older, ignored
        fact_row(4, key=None, dpd=7),                                      # no dated snapshot
        fact_row(5, amount="0"),                                           # zero amount
        fact_row(6, amount="1"),                                           # ratio over the cap
        fact_row(7, inst=14), fact_row(7, loan=1, inst=13), fact_row(7, loan=2, inst=20),
        fact_row(8, key=20240301, dpd=None), fact_row(8, key=20240201, dpd=5),
        fact_row(9, overdue="0.1234", amount="0.10", tenor=2.0, ontime=10.0),
        fact_row(9, loan=9, overdue="0.0001", amount="999.90", tenor=5.0, ontime=20.0),
    ]
    dims = [dim_row(k) for k in range(1, 10)] + [dim_row(10)]
    offers = [
        (1, "Salary Advance", 500.0, None), (1, "TURNOVER loan", None, 900.0),
        (3, "turnover", None, 700.0), (4, "SALARY", 100.0, None), (5, "salary", 100.0, None),
        (6, "salary", 101.0, None), (7, "Other", 5.0, 5.0), (8, "salary", 10.0, None),
        (9, "salary", 10.0, None), (9, "salary", 20.0, None),
    ]
    return Inputs(spark.createDataFrame(facts, LOAN_FACT),
                  spark.createDataFrame(dims, CUSTOMER_DIM),
                  spark.createDataFrame(offers, INCOME_DECISION))


@pytest.fixture(scope="module")
def unfiltered(src):
    return {r["customer_id"]: r for r in ct.unfiltered_customers(src).collect()}


def test_null_product_and_excluded_newest(unfiltered):
    assert unfiltered[1]["loan_count"] == 1
    assert 2 not in unfiltered
    assert 10 not in unfiltered


def test_latest_snapshot(unfiltered):
    assert unfiltered[3]["maturity_dpd"] == 9
    assert unfiltered[4]["maturity_dpd"] == 0
    assert unfiltered[8]["maturity_dpd"] == 0


def test_snapshot_packing_keeps_dates_and_negative_dpd(spark):
    rows = [fact_row(1, key=20240301, dpd=-5), fact_row(1, key=20231231, dpd=2147483647),
            fact_row(2, key=20240301, dpd=None)]
    got = {r["dw_customer_key"]: (r["latest_date_key"], r["maturity_dpd"]) for r in
           ct.latest_snapshot_dpd(spark.createDataFrame(rows, LOAN_FACT)).collect()}
    assert got == {1: (20240301, -5), 2: (20240301, None)}


def test_dpd_counts_rows_not_loans(unfiltered):
    assert (unfiltered[7]["has_14plus_dpd"], unfiltered[7]["count_14plus_dpd"]) == (1, 2)
    assert unfiltered[7]["loan_count"] == 2


def test_income_prefers_salary(unfiltered):
    assert unfiltered[1]["income"] == 500.0
    assert unfiltered[3]["income"] == 700.0
    assert unfiltered[7]["income"] is None
    assert unfiltered[9]["income"] == 20.0


def test_sums_are_exact(unfiltered):
    r = unfiltered[9]
    assert (r["total_amount_overdue"], r["total_loan_amount"]) == (0.1235, 1000.0)
    assert (r["tenor_in_months"], r["ontime_repayment_rate"]) == (3.5, 15.0)


def test_double_amounts_sum_like_decimals(src):
    doubles = src.loan_fact.selectExpr(
        *[f"cast({c} AS double) AS {c}" if t.startswith("decimal") else c
          for c, t in src.loan_fact.dtypes])
    assert (sorted(ct.customer_metrics(doubles).collect())
            == sorted(ct.customer_metrics(src.loan_fact).collect()))


def test_sums_of_extreme_amounts(spark, src):
    inf = float("inf")
    amounts = {1: [0.00004] * 5, 2: [1e15] * 20, 3: [inf, 1.0], 4: [inf, -inf], 5: [1e30, 1.0],
               6: [float("nan"), 2.0], 7: [None, None]}
    fact = spark.createDataFrame([(k, x) for k, found in amounts.items() for x in found],
                                 "dw_customer_key bigint, amount double")
    got = {r[0]: r["amount"] for r in ct.per_customer(fact, ct.exact_sum(fact, "amount")).collect()}
    assert got.pop(4) != got.get(4)     # NaN
    assert got == {1: 0.0002, 2: 2e16, 3: inf, 5: 1e30, 6: 2.0, 7: None}
    means = {r[0]: r["amount"] for r in ct.per_customer(fact, ct.exact_mean("amount")).collect()}
    assert (means[1], means[2], means[3], means[7]) == (0.00004, 1e15, inf, None)


def test_ratio_cap(src):
    kept = {r["customer_id"] for r in ct.customer_table(src).collect()}
    assert kept == {1, 3, 4, 8, 9}


def test_latest_rules_agree(src):
    by_rows = {r[0] for r in ct.latest_loan_rows(src.loan_fact).select(ct.KEY).collect()}
    by_key = {r[0] for r in ct.latest_loan_customers(src.loan_fact).collect()}
    assert by_rows == by_key
    assert 2 not in by_key


def test_latest_flag_keeps_every_row(src):
    flagged = ct.latest_loan_flag(src.loan_fact)
    assert flagged.count() == src.loan_fact.count()
    assert {r["product_code"] for r in flagged.where("is_latest").where(f"{ct.KEY} = 2").collect()
            } == {"DTP"}


def test_fact_is_hash_aggregated_with_few_shuffles(spark, src, tmp_path):
    src.loan_fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    plan = ct.customer_metrics(fact)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    # Measures by customer; loans by (customer, loan), then by customer.
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("FileScan") == 2
    narrow = [line for line in plan.splitlines() if "FileScan" in line and "ReadSchema" in line
              and "maturity_dpd" not in line]
    assert len(narrow) == 1 and "loan_ref" in narrow[0]
