"""DuckDB twin of every registered query that SQL can express."""

from __future__ import annotations

from cohortlens.checks.ctes import (
    CLUSTER, CODED, DEMOS, RATIO_RULES, RISK, RULES, SEGMENT_NAMES, errors_of, with_ctes)
from cohortlens.operators.decode import KNOWN_LABELS

SQL: dict[str, str] = {}

C19 = ("customer_id", "loan_count", "total_amount_overdue", "maturity_dpd",
       "total_missed_installment", "has_14plus_dpd", "count_14plus_dpd", "tenor_in_months",
       "ontime_repayment_rate", "age", "gender", "marital_status", "state", "location",
       "purpose", "employment_status", "dw_channel_key", "total_loan_amount", "income")
NUMERIC = ("customer_id", "loan_count", "total_amount_overdue", "maturity_dpd",
           "total_missed_installment", "has_14plus_dpd", "count_14plus_dpd", "tenor_in_months",
           "ontime_repayment_rate", "age", "total_loan_amount", "income")
TEXTS = ("gender", "marital_status", "state", "location", "purpose", "employment_status",
         "dw_channel_key")
OPTIONAL = ("marital_status", "state", "location", "purpose", "employment_status",
            "dw_channel_key")
FEATURES = ("missed_payment_ratio", "overdue_utilization", "monthly_loan_volume",
            "repayment_efficiency")
RUN_1 = "'20260101_080000'"
TIME_1, TIME_2 = "TIMESTAMP '2026-01-01 08:00:00'", "TIMESTAMP '2026-01-02 08:00:00'"
# The action recommended for each cohort.
ACTION = """CASE segment WHEN 'Low Risk - High Value' THEN 'Prioritize & reward'
  WHEN 'Low Risk - Low Value' THEN 'Grow value'
  WHEN 'Medium Risk - High Value' THEN 'Monitor risk, retain'
  WHEN 'Medium Risk - Low Value' THEN 'Control exposure'
  WHEN 'High Risk' THEN 'Restrict / red-flag' ELSE 'Further analysis required' END"""


def rounded(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def union_all(parts) -> str:
    return " UNION ALL ".join(parts)


# -- sources and sinks -------------------------------------------------------
for key in ("src_extract", "src_csv", "src_parquet"):
    SQL[key] = "SELECT * FROM raw19"
SQL["src_latest_run"] = "SELECT customer_id, '20260102_080000' AS run_id FROM valid"
SQL["sink_raw"] = ("SELECT *, 'parquet' AS format FROM valid UNION ALL "
                   "SELECT *, 'csv' AS format FROM valid")
TYPES = {c: "string" for c in TEXTS} | {c: "int" for c in ("has_14plus_dpd", "age")} | {c: "double" for c in (
    "total_amount_overdue", "tenor_in_months", "ontime_repayment_rate", "total_loan_amount", "income")}
KINDS = {c: TYPES.get(c, "bigint") for c in C19}


def _column_summary(c: str) -> str:
    if c in TEXTS:
        counts = f"(SELECT {c} AS v, count(*) AS n FROM valid WHERE {c} IS NOT NULL GROUP BY 1)"
        figures = ("NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS median, NULL::DOUBLE AS std, "
                   f"NULL::BIGINT AS zeros, (SELECT count(DISTINCT n) FROM {counts}) AS distinct_frequencies, "
                   f"(SELECT v FROM {counts} ORDER BY n DESC, v LIMIT 1) AS top_value, (SELECT max(n) FROM {counts}) AS top_count")
    else:
        figures = (f"round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max, round(avg({c}::DOUBLE), 6) AS mean, "
                   f"round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median, round(stddev_samp({c}::DOUBLE), 6) AS std, "
                   f"count(*) FILTER ({c} = 0) AS zeros, NULL::BIGINT AS distinct_frequencies, NULL::VARCHAR AS top_value, "
                   "NULL::BIGINT AS top_count")
    return f"SELECT '{c}' AS column_name, '{KINDS[c]}' AS column_type, count(*) - count({c}) AS missing, {figures} FROM valid"


METADATA = f"""
SELECT {TIME_1} AS extraction_timestamp, count(*) AS record_count, '{",".join(C19)}' AS columns,
  '{", ".join(f"{c}:{KINDS[c]}" for c in C19)}' AS column_types, 'warehouse' AS data_source,
  sha256('customer table') AS query_hash, CAST(count(*) * {len(C19)}
  - ({" + ".join(f"count({c})" for c in C19)}) AS BIGINT) AS missing_values,
  min(customer_id) AS min_customer_id, max(customer_id) AS max_customer_id,
  round(avg(has_14plus_dpd), 6) AS default_rate, CAST(sum(has_14plus_dpd) AS BIGINT) AS default_count,
  count(*) FILTER (has_14plus_dpd = 0) AS non_default_count FROM valid"""
SQL["sink_metadata"] = f"SELECT * FROM ({METADATA}) m, ({union_all(_column_summary(c) for c in C19)}) s"


def fingerprinted(name: str, source: str, kinds: dict[str, str]) -> str:
    """Rows and fingerprint of a table: 60 bits of an MD5 a row, summed."""
    def text(c: str, kind: str) -> str:
        if kind == "double":
            return f"CAST(CAST(round({c}, 6) AS DECIMAL(38,6)) AS VARCHAR)"
        return f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if kind == "timestamp" else f"CAST({c} AS VARCHAR)"

    cells = " || ".join(f"coalesce(length({t}) || ':' || {t}, '-')" for t in (text(c, k) for c, k in sorted(kinds.items())))
    return (f"SELECT '{name}' AS table_name, count(*) AS rows, CAST(coalesce(sum(CAST('0x' || substr(md5({cells}), 1, 15) AS BIGINT)), 0) "
            f"AS VARCHAR) AS fingerprint FROM ({source})")


SQL["sink_features"] = f"SELECT customer_id, {rounded(FEATURES)}, {RUN_1} AS run_id FROM survivors"
UPSERT = f"""
SELECT CAST(v.customer_id AS VARCHAR) AS customer_id,
  coalesce(s.segment, 'Not assigned') AS segment_assigned, {ACTION} AS recommendation,
  CASE WHEN s.customer_id IS NULL THEN {TIME_1} ELSE {TIME_2} END AS updated_at
FROM valid v LEFT JOIN segmented s USING (customer_id)"""
DERIVED = {"income_bracket": "string", "age_category": "string", "segment": "string", **{c: "double" for c in FEATURES}}
PROFILE_KINDS = {"segment": "string", "combination_id": "string", "combination": "string", "observed_proportion": "double",
                 "expected_proportion": "double", "odds_ratio": "double", "count": "bigint", "coverage": "double", "place": "int"}
TARGET_KINDS = {"customer_id": "string", "segment_assigned": "string", "recommendation": "string", "updated_at": "timestamp"}
SUMMARY = f"""
SELECT {TIME_1} AS finished_at, CAST(sum(segment_size) AS BIGINT) AS total_customers,
  string_agg(segment || '=' || segment_size, ';' ORDER BY segment) AS distribution,
  (SELECT count(*) FROM profiles) AS profiles_generated FROM seg_sizes"""
SQL["sink_run_artifacts"] = union_all([
    fingerprinted("raw", "SELECT * FROM valid", KINDS),
    fingerprinted("metadata", METADATA, {"extraction_timestamp": "timestamp", "default_rate": "double", **{c: "bigint" for c in (
        "record_count", "columns", "column_types", "data_source", "query_hash", "missing_values", "min_customer_id",
        "max_customer_id", "default_count", "non_default_count")}}),
    fingerprinted("segmented", "SELECT * FROM segmented", KINDS | DERIVED),
    fingerprinted("profiles", "SELECT * FROM profiles", PROFILE_KINDS),
    fingerprinted("codes", "SELECT * FROM codes", {"feature": "string", "code": "int", "category": "string"}),
    fingerprinted("quarantine", "SELECT customer_id, len(errors) AS n_errors, list_aggregate(errors, 'string_agg', '; ') AS error "
                  "FROM checked_raw WHERE len(errors) > 0", {"customer_id": "bigint", "n_errors": "int", "error": "string"}),
    fingerprinted("customer_segment", f"SELECT CAST(customer_id AS VARCHAR) AS customer_id, segment AS segment_assigned, "
                  f"{ACTION} AS recommendation, {TIME_1} AS updated_at FROM segmented", TARGET_KINDS),
    fingerprinted("segment_profile", "SELECT * FROM wide_profile", {c: "string" for c in (
        "low_risk_high_value", "low_risk_low_value", "medium_risk_high_value", "medium_risk_low_value", "high_risk")}),
    fingerprinted("summary", SUMMARY, {"finished_at": "timestamp", "total_customers": "bigint", "distribution": "string",
                                       "profiles_generated": "bigint"})])
SQL["sink_segment_upsert"] = UPSERT
SQL["set_upsert_state"] = UPSERT
SQL["sink_profile_replace"] = "SELECT * FROM wide_profile"
SQL["sink_quarantine"] = """
SELECT customer_id, CAST(len(errors) AS INTEGER) AS n_errors,
  list_aggregate(errors, 'string_agg', '; ') AS error FROM checked_registry WHERE len(errors) > 0"""
SQL["sink_readback"] = """
SELECT coalesce(s.segment, 'Not assigned') AS segment_assigned, count(*) AS customer_count
FROM valid v LEFT JOIN segmented s USING (customer_id) GROUP BY 1"""

# -- filters, projections, cleaning ------------------------------------------
SQL["flt_product"] = "SELECT dw_customer_key, loan_ref, product_code, dw_date_key FROM kept_fact"
SQL["flt_category"] = """
SELECT dw_customer_key, age, state, customer_category FROM customer_dim
WHERE customer_category = 'Individual'"""
SQL["flt_income_ratio"] = """
SELECT customer_id, income, total_loan_amount, round(abs(income / total_loan_amount), 6) AS ratio
FROM raw19"""
SQL["prj_19col"] = "SELECT * FROM wide"
SQL["clean_preclean"] = "SELECT * FROM pre_registry"
SQL["dq_validate_raw"] = """
SELECT customer_id, len(errors) = 0 AS is_valid,
  coalesce(list_aggregate(errors, 'string_agg', '; '), '') AS error FROM checked_registry"""
SQL["dq_coerce"] = f"""
SELECT customer_id, CASE WHEN lower(trim(gender)) = 'male' THEN 'Male'
  WHEN lower(trim(gender)) = 'female' THEN 'Female' ELSE 'Unknown' END AS gender,
  coalesce(tenor_in_months, 1.0) AS tenor_in_months,
  {", ".join(f"coalesce({c}, '') AS {c}" for c in OPTIONAL)} FROM registry"""
SQL["dq_report"] = """
SELECT count(*) AS total_records, count(*) FILTER (WHERE len(errors) = 0) AS valid_records,
  count(*) FILTER (WHERE len(errors) > 0) AS invalid_records,
  round(count(*) FILTER (WHERE len(errors) = 0) * 100.0::DOUBLE / count(*), 4) AS valid_percent
FROM checked_registry"""
SQL["dq_report_rules"] = """
SELECT rule, count(*) AS n FROM (SELECT unnest(errors) AS rule FROM checked_registry)
GROUP BY rule"""
SQL["dq_report_first"] = SQL["sink_quarantine"] + " ORDER BY customer_id LIMIT 10"
SQL["flt_critical_nulls"] = """
SELECT customer_id, age, income, CASE WHEN gender IS NULL THEN 'Unknown'
  WHEN gender = 'male' THEN 'Male' ELSE 'Female' END AS gender
FROM registry WHERE age IS NOT NULL AND income IS NOT NULL"""
SQL["clean_others"] = "SELECT customer_id, " + ", ".join(
    f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'Others' ELSE {c} END AS {c}"
    for c in OPTIONAL) + " FROM registry"
SQL["flt_age"] = "SELECT customer_id, age FROM registry WHERE age >= 18 AND age <= 65"
SQL["clean_numeric_fill"] = """
SELECT customer_id, coalesce(tenor_in_months, 1) AS tenor_in_months,
  CAST(coalesce(total_missed_installment, 0) AS DOUBLE) AS total_missed_installment,
  coalesce(total_amount_overdue, 0) AS total_amount_overdue,
  coalesce(total_loan_amount, (SELECT median(total_loan_amount) FROM registry))
    AS total_loan_amount, coalesce(ontime_repayment_rate, 100) AS ontime_repayment_rate
FROM registry"""
SQL["flt_income_missing"] = """
SELECT customer_id, income FROM registry WHERE income IS NULL OR income = 0"""
SQL["flt_notebook"] = """
SELECT customer_id, age, gender, dw_channel_key, income FROM registry
WHERE gender <> 'Unknown' AND gender IS NOT NULL AND age IS NOT NULL
  AND dw_channel_key IS NOT NULL AND income IS NOT NULL"""
SQL["dq_validate_processed"] = f"""
SELECT customer_id, len(errors) = 0 AS is_valid,
  coalesce(list_aggregate(errors, 'string_agg', '; '), '') AS error
FROM (SELECT customer_id, {errors_of(RULES + RATIO_RULES)} AS errors FROM featured)"""
SQL["dq_required_columns"] = """
SELECT customer_id, total_missed_installment, tenor_in_months, total_amount_overdue,
  total_loan_amount, ontime_repayment_rate FROM registry"""

# -- joins -------------------------------------------------------------------
SQL["join_latest_loan"] = """
SELECT dw_customer_key, disbursement_date, loan_ref, product_code, dw_date_key FROM newest_rows"""
SQL["join_latest_snapshot"] = "SELECT * FROM snapshot_dpd"
SQL["join_left_aggs"] = "SELECT * FROM metrics"
SQL["join_dim"] = """
SELECT * FROM loan_counts JOIN customer_dim USING (dw_customer_key)
WHERE customer_category = 'Individual'"""
SQL["join_income"] = """
SELECT k.dw_customer_key, i.income FROM (SELECT DISTINCT dw_customer_key FROM newest_rows) k
LEFT JOIN incomes i USING (dw_customer_key)"""
SQL["join_merge_demo"] = f"""
SELECT s.customer_id, s.segment, {", ".join(f"round(s.{c}, 6) AS {c}" for c in CLUSTER)},
  {", ".join(f"f.{c}" for c in DEMOS)}
FROM ex_segmented s LEFT JOIN ex_featured f USING (customer_id)"""
SQL["join_population"] = "SELECT segment, demo, value, n, pop_n FROM items"

# -- aggregations ------------------------------------------------------------
SQL["agg_loan_count"] = "SELECT * FROM loan_counts"
SQL["agg_latest_date"] = """
SELECT dw_customer_key, max(dw_date_key) AS latest_date_key FROM kept_fact
GROUP BY dw_customer_key"""
SQL["agg_dpd14"] = "SELECT * FROM late_flags"
SQL["agg_customer"] = "SELECT * FROM sums"
SQL["agg_dedup"] = "SELECT DISTINCT dw_customer_key FROM newest_rows"
SQL["agg_coalesce"] = """
SELECT dw_customer_key, maturity_dpd, has_14plus_dpd, count_14plus_dpd FROM metrics"""
SQL["agg_value_counts"] = union_all(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM ex_adults "
    f"GROUP BY {c}" for c in ("has_14plus_dpd", "gender", "dw_channel_key", "marital_status",
                              "employment_status", "age_category"))
SQL["agg_segment_dist"] = """
SELECT segment, count(*) AS n, round(count(*) * 100.0::DOUBLE
  / (SELECT count(*) FROM segmented), 4) AS percent FROM segmented GROUP BY segment"""
SQL["agg_numeric_summary"] = union_all(f"""
SELECT '{c}' AS column_name, round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max,
  round(avg({c}::DOUBLE), 6) AS mean, round(stddev_samp({c}::DOUBLE), 6) AS std,
  count(*) FILTER (WHERE {c} = 0) AS zeros, count(*) - count({c}) AS missing,
  round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median FROM registry""" for c in NUMERIC)
SQL["agg_cat_summary"] = union_all(f"""
SELECT '{c}' AS column_name, count(v) AS distinct_values,
  count(DISTINCT CASE WHEN v IS NOT NULL THEN n END) AS distinct_frequencies,
  first(v ORDER BY n DESC, v) FILTER (WHERE v IS NOT NULL) AS top_value,
  coalesce(max(n) FILTER (WHERE v IS NOT NULL), 0) AS top_count,
  CAST(coalesce(sum(n) FILTER (WHERE v IS NULL), 0) AS BIGINT) AS missing
FROM (SELECT {c} AS v, count(*) AS n FROM registry GROUP BY {c})""" for c in TEXTS)
SQL["agg_missing"] = union_all(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM registry" for c in C19
) + " UNION ALL SELECT '(all)', " + " + ".join(
    f"(count(*) - count({c}))" for c in C19) + " FROM registry"
SQL["agg_null_ratio"] = union_all(f"""
SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count({c}) AS present,
  round((count(*) - count({c}))::DOUBLE / nullif(count({c}), 0), 6) AS null_ratio FROM registry"""
                                  for c in C19)
SQL["agg_default"] = """
SELECT round(avg(has_14plus_dpd), 6) AS default_rate,
  CAST(sum(has_14plus_dpd) AS BIGINT) AS default_count,
  count(*) FILTER (WHERE has_14plus_dpd = 0) AS non_default_count FROM raw19"""


def described(source: str, columns, percents) -> str:
    return union_all(f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}::DOUBLE), 6) AS mean,
  round(stddev_samp({c}::DOUBLE), 6) AS std, round(min({c})::DOUBLE, 6) AS min,
  round(max({c})::DOUBLE, 6) AS max, {", ".join(
    f"round(quantile_cont({c}::DOUBLE, {p}), 6) AS p{p * 100:g}" for p in percents)} FROM {source}""" for c in columns)


SQL["agg_describe"] = described("registry", NUMERIC, (0.05, 0.15, 0.25, 0.5, 0.75, 0.9, 0.95))
SQL["agg_describe_features"] = described("ex_featured", NUMERIC + CODED + FEATURES, (
    0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99))
SQL["agg_snapshot"] = union_all(f"""
SELECT '{c}' AS column_name, round(min({c})::DOUBLE, 6) AS best_case,
  round(avg({c}::DOUBLE), 6) AS average, round(max({c})::DOUBLE, 6) AS worst_case,
  count(*) AS sample_size, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median FROM ex_adults"""
    for c in ("loan_count", "total_loan_amount", "maturity_dpd", "tenor_in_months"))
SQL["agg_default_by_dim"] = union_all(f"""
SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value,
  round(avg(has_14plus_dpd), 6) AS default_rate,
  CAST(sum(has_14plus_dpd) AS BIGINT) AS defaults, count(*) AS customers
FROM ex_adults WHERE {c} IS NOT NULL GROUP BY {c}""" for c in (
    "age", "age_category", "gender", "marital_status", "employment_status", "dw_channel_key"))
SQL["agg_overall_mean"] = """
SELECT employment_status AS value, round(avg(has_14plus_dpd), 6) AS default_rate,
  count(*) AS customers, (SELECT round(avg(has_14plus_dpd), 6) FROM ex_adults) AS overall_rate
FROM ex_adults WHERE employment_status IS NOT NULL GROUP BY employment_status"""
SQL["agg_distinct_sketch"] = """
SELECT CAST(dw_date_key // 10000 AS INTEGER) AS year, count(DISTINCT loan_ref) AS loans, true AS within_bound
FROM loan_fact GROUP BY 1 UNION ALL
SELECT NULL, count(DISTINCT loan_ref), true FROM loan_fact"""
SQL["agg_corr"] = union_all(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(CASE WHEN isnan(corr({a}, {b})) "
    f"THEN NULL ELSE corr({a}, {b}) END, 6) AS r FROM ex_adults"
    for i, a in enumerate(NUMERIC) for b in NUMERIC[i:])
SQL["agg_revenue_share"] = """
SELECT segment, round(r::DOUBLE, 2) AS total_revenue,
  round_even(r::DOUBLE / (sum(r) OVER ())::DOUBLE * 100, 1) AS revenue_share
FROM (SELECT segment, sum(CAST(total_loan_amount - total_amount_overdue AS DECIMAL(28,4))) AS r
  FROM ex_segmented GROUP BY segment)"""
SQL["agg_cube_demographics"] = f"""
SELECT {", ".join(DEMOS)}, CAST(GROUPING({", ".join(DEMOS)}) AS BIGINT) AS grouping,
  count(*) AS n FROM segmented GROUP BY CUBE ({", ".join(DEMOS)})"""
SQL["agg_run_summary"] = f"""
SELECT {RUN_1} AS run_id, {TIME_1} AS finished_at, CAST(sum(n) AS BIGINT) AS total_customers,
  string_agg(segment || '=' || n, '; ' ORDER BY segment) AS distribution,
  (SELECT count(*) FROM profiles) AS profiles_generated
FROM (SELECT segment, count(*) AS n FROM segmented GROUP BY segment)"""
SQL["agg_key_unique"] = """
SELECT count(*) AS rows, count(DISTINCT customer_id) AS distinct_keys, min(customer_id) AS min_key,
  max(customer_id) AS max_key, count(*) = count(DISTINCT customer_id) AS is_unique
FROM segmented"""
_KINDS = {**{c: "string" for c in TEXTS}, **{c: "bigint" for c in (
    "customer_id", "loan_count", "maturity_dpd", "total_missed_installment",
    "count_14plus_dpd")}, "has_14plus_dpd": "int", "age": "int"}
SQL["agg_column_profile"] = union_all(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, "
    f"count(*) - count({c}) AS missing, '{_KINDS.get(c, 'double')}' AS data_type FROM registry"
    for c in C19)
SQL["agg_behaviour"] = f"""
SELECT segment, sub_cluster, {", ".join(f"round(avg({c}), 2) AS {c}" for c in CLUSTER)}
FROM ex_split GROUP BY segment, sub_cluster"""

# -- features, binning, encoding, scoring ------------------------------------
SQL["feat_payment"] = f"SELECT customer_id, {rounded(FEATURES)} FROM featured"
SQL["feat_median_fill"] = f"""
SELECT customer_id, {", ".join(
    f"round(coalesce({c}, median({c}) OVER ()), 6) AS {c}" for c in FEATURES)}
FROM (SELECT customer_id,
  CASE WHEN tenor_in_months IS NOT NULL THEN least(10.0::DOUBLE, total_missed_installment
    / (CASE WHEN tenor_in_months = 0 THEN 1 ELSE tenor_in_months END + 1e-6::DOUBLE)) END
    AS missed_payment_ratio,
  CASE WHEN total_loan_amount IS NOT NULL THEN least(1.0::DOUBLE, total_amount_overdue
    / (CASE WHEN total_loan_amount = 0 THEN 1 ELSE total_loan_amount END + 1e-6::DOUBLE)) END
    AS overdue_utilization,
  total_loan_amount / (CASE WHEN tenor_in_months = 0 THEN 1 ELSE tenor_in_months END
    + 1e-6::DOUBLE) AS monthly_loan_volume,
  CASE WHEN ontime_repayment_rate IS NOT NULL
    THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, ontime_repayment_rate / 100)) END
    AS repayment_efficiency FROM registry)"""
SQL["bin_income"] = """
SELECT customer_id, income, CASE WHEN income < 70000 THEN '<69k' WHEN income < 150000
  THEN '70k - 149k' WHEN income < 300000 THEN '150k - 299k' WHEN income < 500000
  THEN '300k - 499k' WHEN income < 800000 THEN '500k - 799k' WHEN income < 1200000
  THEN '800k - 1.19M' ELSE '1.2M and above' END AS income_bracket
FROM (SELECT customer_id, coalesce(income, median(income) OVER ()) AS income FROM registry)"""
SQL["bin_age_quantile"] = "SELECT customer_id, age, age_category FROM binned"
SQL["bin_age_balanced"] = "SELECT customer_id, age, age_category FROM ex_adults"
SQL["bin_income_dist"] = """
SELECT income_bracket, CAST(list_position(['<69k', '70k - 149k', '150k - 299k', '300k - 499k',
  '500k - 799k', '800k - 1.19M', '1.2M and above'], income_bracket) - 1 AS INTEGER) AS position,
  count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM ex_known), 6) AS share
FROM ex_known GROUP BY income_bracket"""
SQL["enc_ordinal"] = f"SELECT customer_id, {', '.join(CODED)} FROM encoded"
SQL["enc_map"] = "SELECT * FROM codes"
SQL["score_risk"] = f"SELECT customer_id, {RISK} AS risk_level FROM featured"
SQL["score_value"] = "SELECT customer_id, value_level FROM leveled_all"
SQL["score_segment"] = """
SELECT customer_id, risk_level, value_level, CASE WHEN risk_level = 'High' THEN 'High Risk'
  ELSE risk_level || ' Risk - ' || value_level END AS segment FROM leveled_all"""
SQL["score_segmenter"] = "SELECT customer_id, segment FROM segmented"
SQL["score_recommendation"] = f"""
SELECT customer_id, segment, {ACTION} AS recommendation FROM segmented"""
SQL["feat_zscore"] = f"SELECT customer_id, {rounded(CLUSTER)} FROM ex_scaled"
SQL["feat_revenue"] = """
SELECT customer_id, segment, round(total_loan_amount - total_amount_overdue, 4) AS revenue
FROM ex_segmented"""

# -- windows -----------------------------------------------------------------
SQL["ml_elbow_k"] = """
SELECT CAST(a.k AS INTEGER) AS k, round(a.inertia, 6) AS inertia, CAST((
    SELECT g.k FROM (
      SELECT b.k, p.inertia - b.inertia AS gain, b.inertia - s.inertia AS next_gain FROM km_inertia b
      JOIN km_inertia p ON p.k = b.k - 1 JOIN km_inertia s ON s.k = b.k + 1) g
    ORDER BY CASE WHEN gain = 0 AND next_gain = 0 THEN 0 ELSE 1 END,
      CASE WHEN next_gain <> 0 THEN gain / next_gain WHEN gain > 0 THEN '-inf'::DOUBLE ELSE 'inf'::DOUBLE END DESC, g.k
    LIMIT 1) AS INTEGER) AS optimal_k FROM km_inertia a"""
SQL["win_equal_split"] = "SELECT customer_id, segment, sub_cluster FROM ex_split"
SQL["win_topk_segment"] = """
SELECT segment, CAST(position AS INTEGER) AS position, CAST(size AS INTEGER) AS size, n, pop_n,
  CAST(place AS INTEGER) AS place FROM top_profiles"""
SQL["win_combo_id"] = """
SELECT segment, 'C' || position AS combination_id, combination, n, pop_n FROM winners"""
SQL["win_latest_flag"] = """
SELECT dw_customer_key, loan_ref, disbursement_date, product_code, coalesce(disbursement_date
  = max(disbursement_date) OVER (PARTITION BY dw_customer_key), false) AS is_latest
FROM loan_fact"""

# -- sort, limit, set operations ---------------------------------------------
SQL["sort_customer"] = """
SELECT customer_id, loan_count, total_loan_amount FROM raw19 ORDER BY customer_id"""
SQL["topk_states"] = """
SELECT state, round(avg(has_14plus_dpd), 6) AS default_rate FROM ex_adults
WHERE state IS NOT NULL GROUP BY state ORDER BY default_rate DESC, state LIMIT 10"""
SQL["sort_state_counts"] = """
SELECT state, count(*) AS n FROM ex_adults WHERE state IS NOT NULL GROUP BY state
ORDER BY n, state"""
SQL["limit_sample"] = """
SELECT customer_id, age, gender, state, income FROM raw19 ORDER BY customer_id LIMIT 5"""
SQL["sort_profiles"] = """
SELECT segment, CAST(position AS INTEGER) AS position,
  round(observed_proportion, 6) AS observed_proportion, round(odds_ratio, 6) AS odds_ratio
FROM winners ORDER BY 3 DESC, 4 DESC, 1, 2"""
SQL["set_union_profiles"] = "SELECT segment, combination_id, combination, count FROM profiles"
SQL["set_distinct"] = "SELECT DISTINCT segment FROM segmented"

# -- profile mining ----------------------------------------------------------
SQL["prof_lift"] = f"""
SELECT segment, demo, value, n, pop_n, {rounded(("lift", "observed", "expected"))} FROM lifted"""
SQL["prof_qualifying"] = SQL["prof_lift"] + " WHERE lift >= 1.2"
SQL["prof_combinations"] = """
SELECT segment, CAST(size AS INTEGER) AS size, combination, n,
  round(observed_proportion, 6) AS coverage FROM winners"""
SQL["prof_population"] = "SELECT segment, combination, pop_n, pop_size FROM winners"
SQL["prof_segment_profiles"] = f"""
SELECT segment, combination_id, combination, count, {rounded((
    "observed_proportion", "expected_proportion", "odds_ratio", "coverage"))} FROM profiles"""
SQL["prof_overrep"] = """
SELECT g.segment, g.sub_cluster, g.demo, g.value,
  round_even(g.n::DOUBLE / s.n, 4) AS observed_proportion,
  round_even(p.pop_n::DOUBLE / t.n, 4) AS expected_proportion,
  round_even((g.n::DOUBLE / s.n) / (p.pop_n::DOUBLE / t.n + 0.001::DOUBLE), 2)
    AS over_representation, g.n AS category_count
FROM (SELECT segment, sub_cluster, demo, value, count(*) AS n FROM ex_split_long
      WHERE value IS NOT NULL GROUP BY ALL) g
JOIN (SELECT segment, sub_cluster, count(*) AS n FROM ex_split GROUP BY ALL) s
  ON g.segment = s.segment AND g.sub_cluster IS NOT DISTINCT FROM s.sub_cluster
JOIN ex_pop p ON g.demo = p.demo AND g.value = p.value
CROSS JOIN (SELECT count(*) AS n FROM ex_featured) t"""
SQL["prof_rates"] = """
SELECT s.segment, s.demo, s.value, s.n, p.pop_n, round(s.n::DOUBLE / p.pop_n, 6) AS rate
FROM (SELECT segment, demo, value, count(*) AS n FROM ex_long WHERE value IS NOT NULL
      GROUP BY ALL) s JOIN ex_pop p USING (demo, value)"""
SQL["prof_combinations_nb"] = """
SELECT segment, CAST(size AS INTEGER) AS size, combination_id, combination, observed_proportion,
  expected_proportion, odds_ratio, n AS count, printf('%.1f%%', round(coverage * 100, 1)) AS coverage
FROM ex_best"""
SQL["prof_pivot"] = "SELECT * FROM wide_profile"
SQL["prof_report"] = """
SELECT s.segment, format('{:,}', s.segment_size) AS customers,
  printf('%.1f%%', round(s.segment_size * 100.0::DOUBLE / (SELECT count(*) FROM segmented), 1))
    AS percent, p.combination, CASE WHEN p.coverage IS NOT NULL
    THEN printf('%.1f%%', round(p.coverage * 100, 1)) END AS coverage,
  CASE WHEN p.odds_ratio IS NOT NULL THEN printf('%.2f', round(p.odds_ratio, 2)) END AS odds_ratio
FROM seg_sizes s LEFT JOIN profiles p USING (segment)"""

# -- scalar functions --------------------------------------------------------
SQL["fn_title"] = """
SELECT dw_customer_key, CASE gender WHEN 'male' THEN 'Male' WHEN ' FEMALE ' THEN 'Female' END
  AS gender, upper(left(purpose_of_loan, 1)) || substr(purpose_of_loan, 2) AS purpose
FROM customer_dim"""
SQL["fn_like"] = """
SELECT offer_type ILIKE '%salar%' AS salary_offer, offer_type ILIKE '%turnover%'
  AS turnover_offer, count(*) AS n FROM income_decision GROUP BY 1, 2"""
SQL["fn_case"] = """
SELECT customer_id, CASE WHEN total_loan_amount <> 0
  THEN round(abs(income / total_loan_amount), 6) END AS ratio,
  coalesce(maturity_dpd, 0) AS maturity_dpd, coalesce(has_14plus_dpd, 0) AS has_14plus_dpd
FROM registry"""
SQL["fn_to_numeric"] = """
SELECT dw_customer_key, TRY_CAST(state AS DOUBLE) AS from_text,
  TRY_CAST(substr(state, 8) AS DOUBLE) AS from_digits FROM customer_dim"""
SQL["fn_clip"] = """
SELECT customer_id, CASE WHEN age < 18 THEN 18 WHEN age > 60 THEN 60 ELSE age END AS age,
  CASE WHEN tenor_in_months > 4 THEN 4 ELSE tenor_in_months END AS tenor_in_months
FROM registry"""
SQL["fn_bround"] = """
SELECT customer_id, round_even(age / 2, 0) AS half_age,
  round_even(tenor_in_months, 0) AS tenor_in_months FROM registry"""
SQL["fn_replace"] = """
SELECT customer_id, CASE WHEN maturity_dpd = 0 THEN 1 ELSE maturity_dpd END AS maturity_dpd,
  total_loan_amount / nullif(ontime_repayment_rate, 0) AS ratio FROM registry"""
SQL["fn_combo_format"] = """
SELECT segment, CAST(position AS INTEGER) AS position, combination FROM winners"""
SQL["fn_combo_parse"] = """
SELECT segment, place, CAST(pos - 1 AS INTEGER) AS pos, demo, value FROM profile_parts"""
_KNOWN_ROWS = ", ".join(f"('{demo}', '{code}', '{label}')" for demo, codes in KNOWN_LABELS.items()
                        for code, label in codes.items())
SQL["fn_decode"] = f"""
SELECT p.segment, p.place, string_agg(coalesce(k.label, CASE p.demo
    WHEN 'income_bracket' THEN 'income: ' WHEN 'age_category' THEN 'age: '
    WHEN 'dw_channel_key' THEN 'channel: ' WHEN 'employment_status' THEN 'employment: '
    WHEN 'purpose' THEN 'for_' ELSE p.demo || ': ' END || p.value), ', ' ORDER BY p.pos) AS decoded,
  any_value(d.text) AS text
FROM profile_parts p JOIN decoded d ON d.segment = p.segment AND d.place = p.place
LEFT JOIN (VALUES {_KNOWN_ROWS}) AS k(demo, value, label)
  ON k.demo = p.demo AND k.value = p.value GROUP BY p.segment, p.place"""
SQL["fn_fields_present"] = """
SELECT f AS field, EXISTS (SELECT 1 FROM profiles WHERE contains(combination, f)) AS present
FROM (SELECT unnest(['marital_status', 'dw_channel_key', 'age_category', 'income_bracket',
  'employment_status', 'purpose', 'gender', 'state', 'location']) AS f)"""
SQL["fn_format"] = """
SELECT segment, format('{:,}', segment_size) AS customers, printf('%.1f%%', round(segment_size
  * 100.0::DOUBLE / (SELECT count(*) FROM segmented), 1)) AS share FROM seg_sizes"""
SQL["fn_run_id"] = """
SELECT strftime(disbursement_date, '%Y%m%d_%H%M%S') AS run_id, count(*) AS n FROM loan_fact
GROUP BY 1"""
SQL["fn_row_mean"] = """
SELECT customer_id, round(list_avg([loan_count::DOUBLE, age::DOUBLE, maturity_dpd::DOUBLE,
  tenor_in_months]), 6) AS row_mean FROM registry"""


def oracle() -> dict[str, str]:
    return {key: with_ctes(text) for key, text in SQL.items()}
