"""Contracts, cleaning, binning, encoding, features and scoring on small rows."""

import math

import pytest
from pyspark.sql import functions as F

from cohortlens.config import CohortConfig, HIGH_RISK, LOW_HIGH, LOW_LOW, MEDIUM_LOW
from cohortlens.functions import columns as sql
from cohortlens.functions import staging
from cohortlens.operators import binning, cleaning, encoding, explore, features, quality, scoring
from cohortlens.operators.customer_table import CUSTOMER_COLUMNS
from cohortlens.operators.decode import decode_known

GOOD = dict(customer_id=1, loan_count=1, total_amount_overdue=0.0, maturity_dpd=0,
            total_missed_installment=0, has_14plus_dpd=0, count_14plus_dpd=0,
            tenor_in_months=6.0, ontime_repayment_rate=50.0, age=30, gender="male",
            marital_status="Single", state="S", location="L", purpose="p",
            employment_status="E", dw_channel_key="CH1", total_loan_amount=100.0, income=10.0)
SCHEMA = ("customer_id bigint, loan_count double, total_amount_overdue double, "
          "maturity_dpd double, total_missed_installment double, has_14plus_dpd double, "
          "count_14plus_dpd double, tenor_in_months double, ontime_repayment_rate double, "
          "age double, gender string, marital_status string, state string, location string, "
          "purpose string, employment_status string, dw_channel_key string, "
          "total_loan_amount double, income double")


def customers(spark, *changes):
    rows = [{**GOOD, "customer_id": i, **change} for i, change in enumerate(changes, start=1)]
    return spark.createDataFrame(
        [tuple(float(r[c]) if isinstance(r[c], (int, float)) and c != "customer_id" else r[c]
               for c in CUSTOMER_COLUMNS) for r in rows], SCHEMA)


def column(df, c):
    return [r[c] for r in df.orderBy("customer_id").collect()]


def test_pre_clean_fills_and_ranges(spark):
    df = cleaning.pre_clean(sql.nan_to_null(customers(
        spark, dict(tenor_in_months=0.5), dict(tenor_in_months=2.5), dict(tenor_in_months=None),
        dict(age=17), dict(age=101), dict(age=None), dict(age=float("nan")),
        dict(ontime_repayment_rate=None), dict(ontime_repayment_rate=130),
        dict(has_14plus_dpd=7), dict(maturity_dpd=None, state=None))))
    assert column(df, "tenor_in_months")[:3] == [0.0, 2.0, 1.0]
    assert column(df, "age")[3:7] == [18.0, 100.0, 30.0, 30.0]
    assert column(df, "ontime_repayment_rate")[7:9] == [100.0, 100.0]
    assert column(df, "has_14plus_dpd")[9] == 1
    assert column(df, "maturity_dpd")[10] == 0.0
    assert column(df, "state")[10] == ""


@pytest.mark.parametrize("given,expected", [
    (" mALE ", "Male"), ("x", "Unknown"), (None, "Unknown"), ("other", "Other"),
    ("unknown", "Unknown")])
def test_gender_names(spark, given, expected):
    df = quality.coerce_record(cleaning.pre_clean(customers(spark, dict(gender=given))))
    assert column(df, "gender") == [expected]


@pytest.mark.parametrize("change,rule", [
    (dict(customer_id=0), "customer_id_above_0"),
    (dict(tenor_in_months=0), "tenor_in_months_above_0"),
    (dict(maturity_dpd=2.5), "maturity_dpd_is_whole"),
    (dict(total_loan_amount=None), "total_loan_amount_above_0"),
    (dict(income=-1), "income_at_least_0"),
    (dict(ontime_repayment_rate=101), "ontime_repayment_rate_in_0_100"),
    (dict(age=101), "age_in_18_100"),
    (dict(loan_count=None), "loan_count_at_least_0"),
])
def test_each_broken_rule_is_named(spark, change, rule):
    errors = column(quality.check_raw(customers(spark, change)), "errors")[0]
    assert rule in errors


def test_split_keeps_every_row(spark):
    checked = quality.check_raw(customers(spark, {}, dict(age=5), dict(income=None)))
    valid, rejected = quality.valid_rows(checked), quality.rejected_rows(checked)
    assert (valid.count(), rejected.count()) == (1, 2)
    assert dict(valid.dtypes)["loan_count"] == "bigint"
    assert quality.report(checked).first()["valid_percent"] == 33.3333


def test_ratio_above_one_is_rejected_unless_kept(spark):
    df = features.payment_features(customers(
        spark, dict(total_missed_installment=6), dict(total_missed_installment=7)))
    assert [len(e) for e in column(quality.check_derived(df), "errors")] == [0, 1]
    kept = quality.check_derived(df, CohortConfig(keep_overdrawn_ratios=True))
    assert [len(e) for e in column(kept, "errors")] == [0, 0]


def test_coded_gender_becomes_unknown(spark):
    coded, _ = encoding.fit_encode(customers(spark, dict(gender="Male"), dict(gender="Female")))
    assert column(quality.recode(coded), "gender") == ["Unknown", "Unknown"]
    assert column(quality.recode(coded, CohortConfig(keep_gender=True)), "gender") == ["1", "0"]


def test_required_columns_name_look_alikes(spark):
    df = customers(spark, {}).withColumnRenamed("tenor_in_months", "tenor")
    with pytest.raises(KeyError, match="tenor"):
        quality.require_columns(df)


def test_others_and_median(spark):
    df = customers(spark, dict(state=None, income=10), dict(state="", income=None),
                   dict(income=30), dict(income=50))
    assert column(cleaning.others_if_blank(df), "state") == ["Others", "Others", "S", "S"]
    assert column(cleaning.fill_medians(df, ["income"]), "income") == [10, 30, 30, 50]
    assert column(cleaning.fill_medians(df, ["age"]), "age") == [30.0] * 4


def test_income_brackets(spark):
    incomes = [0.0, 69999.99, 70000.0, 1199999.0, 1.2e6, math.inf, -1.0]
    df = customers(spark, *[dict(income=x) for x in incomes]).withColumn(
        "b", F.expr(binning.income_bracket()))
    assert column(df, "b") == ["<69k", "<69k", "70k - 149k", "800k - 1.19M", "1.2M and above",
                               "<69k", "<69k"]
    open_ended = F.expr(binning.income_bracket(outside_first=False))
    assert column(df.withColumn("b", open_ended), "b")[-2:] == [None, None]


def test_tiny_input_uses_fixed_age_bins(spark):
    df = binning.with_bins(customers(spark, *[dict(age=a) for a in (18, 30, 31, 51)]))
    assert column(df, "age_category") == ["18-30", "18-30", "31-40", "51+"]


def test_quantile_age_bins(spark):
    ages = [18, 20, 25, 30, 30, 35, 40, 45, 50, 65]
    df = customers(spark, *[dict(age=a) for a in ages])
    edges = binning.quantile_age_edges(df)
    assert edges == [18, 24, 30, 37, 46, 65]
    assert column(binning.with_bins(df), "age_category")[:3] == ["18-24", "18-24", "24-30"]


def test_balanced_edges_are_five_and_inside(spark):
    df = customers(spark, *[dict(age=a) for a in [18] * 50 + list(range(19, 66))])
    edges = binning.balanced_age_edges(df)
    assert edges[0] == 18 and edges[-1] == 65 and len(edges) >= 5
    assert edges == sorted(set(edges))
    assert binning.balanced_age_labels([18, 30, 65]) == ["18-30", "31-65"]


def test_codes_are_ranks_of_sorted_labels(spark):
    df = customers(spark, *[dict(purpose=p) for p in ("b", "a", None, "c", "a")])
    coded, codes = encoding.fit_encode(df)
    assert column(coded, "purpose") == [2, 1, 0, 3, 1]  # 'Unknown' sorts first
    got = {(r["code"], r["category"]) for r in codes.where("feature = 'purpose'").collect()}
    assert got == {(0, "Unknown"), (1, "a"), (2, "b"), (3, "c")}
    assert column(encoding.fit_encode(df, missing=None)[0], "purpose") == [1, 0, -1, 2, 0]


def test_thousands_of_labels_without_a_broadcast(spark, monkeypatch):
    labels = [f"p{i * 37 % 3001:05d}" for i in range(3001)]
    df = customers(spark, *[dict(purpose=p, state=str(i)) for i, p in enumerate(labels)])
    expected = {p: i for i, p in enumerate(sorted(set(labels)))}
    for limit in (staging.BROADCAST_BYTES, 1000):
        monkeypatch.setattr(staging.small_sides, "__defaults__", (limit,))
        coded, codes = encoding.fit_encode(df)
        got = {r["category"]: r["code"] for r in codes.where("feature = 'purpose'").collect()}
        assert got == expected
        assert {r["state"]: r["purpose"] for r in coded.collect()} == {str(i): expected[p] for i, p in enumerate(labels)}
        plan = coded.select("purpose")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("strategy=broadcast") == (5 if limit > 1000 else 4)    # the others are small


def test_feature_formulas(spark):
    r = features.payment_features(customers(spark, dict(
        total_missed_installment=3, total_amount_overdue=50, tenor_in_months=6,
        total_loan_amount=100, ontime_repayment_rate=40))).first()
    assert r["missed_payment_ratio"] == 3 / (6 + 1e-6)
    assert r["overdue_utilization"] == 50 / (100 + 1e-6)
    assert r["monthly_loan_volume"] == 100 / (6 + 1e-6)
    assert r["repayment_efficiency"] == 0.4
    zero = features.payment_features(customers(spark, dict(
        tenor_in_months=0, total_loan_amount=0, total_missed_installment=50))).first()
    assert zero["missed_payment_ratio"] == 10.0
    assert zero["overdue_utilization"] == 0.0


def test_feature_gaps_take_the_median(spark):
    df = features.payment_features(customers(
        spark, dict(ontime_repayment_rate=10), dict(ontime_repayment_rate=None),
        dict(ontime_repayment_rate=30)))
    assert column(features.fill_feature_gaps(df), "repayment_efficiency") == [0.1, 0.2, 0.3]


def test_risk_boundaries(spark):
    df = features.payment_features(customers(
        spark, dict(total_missed_installment=4, tenor_in_months=10),
        dict(total_missed_installment=7, tenor_in_months=10, count_14plus_dpd=1, maturity_dpd=14),
        dict(count_14plus_dpd=2), dict(maturity_dpd=15), dict(maturity_dpd=None)))
    assert column(df.withColumn("r", F.expr(scoring.risk_level())), "r") == [
        "Low", "Medium", "High", "High", "High"]


def test_segments(spark):
    df = features.payment_features(customers(
        spark, dict(total_loan_amount=1000), dict(total_loan_amount=10),
        dict(total_loan_amount=20, maturity_dpd=3), dict(maturity_dpd=99),
        dict(total_loan_amount=5000, ontime_repayment_rate=14.9)))
    # P75 of the volumes is the volume of the first row: >= includes it.
    assert column(scoring.with_segment(df), "segment") == [
        LOW_HIGH, LOW_LOW, MEDIUM_LOW, HIGH_RISK, LOW_LOW]


def test_unmapped_levels_and_recommendation(spark):
    df = spark.createDataFrame([("Odd", "High Value")], "risk_level string, value_level string")
    row = df.withColumn("segment", F.expr(scoring.combined_segment())).withColumn(
        "action", F.expr(scoring.recommendation())).first()
    assert (row["segment"], row["action"]) == ("Unknown", "Further analysis required")


def test_combination_text_round_trip(spark):
    df = spark.createDataFrame([("gender: 1 | age_category: 18-30 | x: a: b",), ("",), (None,),
                                ("loose",)], "combination string")
    rows = df.selectExpr(f"{sql.combination_items('combination')} AS items").collect()
    assert [(i["demo"], i["value"]) for i in rows[0]["items"]] == [
        ("gender", "1"), ("age_category", "18-30"), ("x", "a: b")]
    assert rows[1]["items"] == [] and rows[2]["items"] == []
    assert [(i["demo"], i["value"]) for i in rows[3]["items"]] == [(None, "loose")]


def test_decode_known(spark):
    df = spark.createDataFrame(
        [("marital_status: 1 | dw_channel_key: 7 | purpose: 99 | income_bracket: <69k | odd: 4",)],
        "combination string")
    assert decode_known(df).first()["decoded"] == (
        "married, channel: 7, for_99, income: <69k, odd: 4")
    own = decode_known(df, labels={"odd": {"4": "four"}}).first()["decoded"]
    assert own == "marital_status: 1, channel: 7, for_99, income: <69k, four"


def test_correlation_of_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0)],
                               "a double, b double, c double")
    got = {(r["column_a"], r["column_b"]): r["r"] for r in explore.correlations(df).collect()}
    assert got[("a", "b")] == 1.0 and got[("a", "c")] is None and got[("c", "c")] is None


def test_cat_summary_counts_values_and_frequencies(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "v string")
    r = explore.categorical_summary(df).first()
    assert (r["distinct_values"], r["distinct_frequencies"], r["top_value"], r["top_count"],
            r["missing"]) == (3, 2, "a", 2, 1)
