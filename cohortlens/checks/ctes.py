"""DuckDB building blocks of the SQL twins: named CTEs with their dependencies.

They are written the long way round (windows, joins, one scan per measure), so
a mistake in a fused Spark aggregate does not repeat itself here.
"""

from __future__ import annotations

import re

DEMOS = ("gender", "marital_status", "purpose", "employment_status", "dw_channel_key",
         "age_category", "income_bracket")
SEGMENT_NAMES = ("Low Risk - High Value", "Low Risk - Low Value", "Medium Risk - High Value",
                 "Medium Risk - Low Value", "High Risk")

CTES: dict[str, str] = {}

CTES["loan_fact"] = """
SELECT o.o_custkey AS dw_customer_key, l.l_orderkey AS loan_ref,
  o.o_orderdate AS disbursement_date,
  CAST(strftime(l.l_shipdate, '%Y%m%d') AS INTEGER) AS dw_date_key,
  CASE WHEN o.o_orderpriority <> '5-LOW' THEN 'TERM'
       WHEN o.o_orderstatus = 'F' THEN 'ON2D' ELSE 'DTP' END AS product_code,
  CASE WHEN l.l_returnflag = 'R' AND l.l_discount >= 0.05 THEN CAST(l.l_quantity AS INTEGER)
       ELSE 0 END AS maturity_dpd,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' AND l.l_discount >= 0.08
        AND l.l_tax >= 0.05 THEN 14 + l.l_linenumber ELSE 0 END AS installment_dpd,
  CASE WHEN l.l_returnflag = 'R' THEN CAST(CAST(l.l_extendedprice AS DECIMAL(18,2))
        * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) ELSE 0 END AS total_amount_overdue,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_loan_amount,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' AND l.l_discount >= 0.08
       THEN 1 ELSE 0 END AS total_missed_installment,
  CAST(l.l_linenumber AS DOUBLE) AS tenor_in_months,
  CASE WHEN l.l_returnflag = 'A' THEN l.l_discount * 1000 ELSE 0 END AS ontime_repayment_rate
FROM lineitem l, orders o WHERE l.l_orderkey = o.o_orderkey"""

CTES["customer_dim"] = """
SELECT c.c_custkey AS dw_customer_key, CAST(16 + (c.c_custkey * 37) % 60 AS INTEGER) AS age,
  CASE WHEN c.c_custkey % 10 = 9 THEN NULL WHEN c.c_custkey % 10 > 5 THEN ' FEMALE '
       ELSE 'male' END AS gender,
  ['Single', 'Married', 'Divorced', 'Widowed', 'Separated', NULL, NULL][c.c_nationkey % 7 + 1]
    AS marital_status,
  n.n_name AS state, r.r_name AS location, lower(c.c_mktsegment) AS purpose_of_loan,
  CASE WHEN c.c_acctbal >= 8000 THEN NULL WHEN c.c_acctbal >= 4000 THEN 'SELF_EMPLOYED'
       WHEN c.c_acctbal >= 0 THEN 'EMPLOYED' WHEN c.c_acctbal < 0 THEN 'UNEMPLOYED' END
    AS employment_status,
  CASE WHEN c.c_custkey % 9 < 8 THEN 'CH' || (c.c_custkey % 9) END AS dw_channel_key,
  CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'Corporate' ELSE 'Individual' END
    AS customer_category
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

CTES["income_decision"] = """
SELECT o_custkey AS user_client_id,
  CASE o_orderstatus WHEN 'F' THEN 'Salary Advance' WHEN 'O' THEN 'TURNOVER loan'
       WHEN 'P' THEN 'Other' END AS offer_type,
  o_totalprice * (1 + o_custkey % 5) / 2 AS monthly_salary_l6m,
  o_totalprice * (1 + o_custkey % 4) AS turnover_last6m_trim
FROM orders"""

CTES["kept_fact"] = "SELECT * FROM loan_fact WHERE product_code NOT IN ('DTP', 'ON2D')"

CTES["newest_rows"] = """
SELECT f.* FROM (SELECT *, max(disbursement_date) OVER (PARTITION BY dw_customer_key) AS newest
  FROM loan_fact) f
WHERE f.disbursement_date = f.newest AND f.product_code NOT IN ('DTP', 'ON2D')"""

CTES["snapshot_dpd"] = """
SELECT dw_customer_key, max(dw_date_key) AS latest_date_key, max(maturity_dpd) AS maturity_dpd
FROM (SELECT *, rank() OVER (PARTITION BY dw_customer_key ORDER BY dw_date_key DESC) AS r
      FROM kept_fact WHERE dw_date_key IS NOT NULL) WHERE r = 1 GROUP BY dw_customer_key"""

CTES["late_flags"] = """
SELECT dw_customer_key, max(CAST(installment_dpd >= 14 AS INTEGER)) AS has_14plus_dpd,
  CAST(count(*) FILTER (WHERE installment_dpd >= 14) AS BIGINT) AS count_14plus_dpd
FROM kept_fact GROUP BY dw_customer_key"""

CTES["loan_counts"] = """
SELECT dw_customer_key, count(DISTINCT loan_ref) AS loan_count
FROM kept_fact GROUP BY dw_customer_key"""

CTES["sums"] = """
SELECT dw_customer_key, CAST(sum(total_amount_overdue) AS DOUBLE) AS total_amount_overdue,
  CAST(sum(total_loan_amount) AS DOUBLE) AS total_loan_amount,
  CAST(sum(total_missed_installment) AS BIGINT) AS total_missed_installment,
  CAST(sum(CAST(tenor_in_months AS DECIMAL(18,6))) AS DOUBLE) / count(tenor_in_months)
    AS tenor_in_months,
  CAST(sum(CAST(ontime_repayment_rate AS DECIMAL(18,6))) AS DOUBLE)
    / count(ontime_repayment_rate) AS ontime_repayment_rate
FROM kept_fact GROUP BY dw_customer_key"""

CTES["metrics"] = """
SELECT k.dw_customer_key, c.loan_count, s.total_amount_overdue,
  CAST(coalesce(d.maturity_dpd, 0) AS BIGINT) AS maturity_dpd, s.total_missed_installment,
  coalesce(t.has_14plus_dpd, 0) AS has_14plus_dpd,
  coalesce(t.count_14plus_dpd, 0) AS count_14plus_dpd,
  s.tenor_in_months, s.ontime_repayment_rate, s.total_loan_amount
FROM (SELECT DISTINCT dw_customer_key FROM newest_rows) k
LEFT JOIN loan_counts c USING (dw_customer_key) LEFT JOIN snapshot_dpd d USING (dw_customer_key)
LEFT JOIN late_flags t USING (dw_customer_key) LEFT JOIN sums s USING (dw_customer_key)"""

CTES["incomes"] = """
SELECT user_client_id AS dw_customer_key,
  coalesce(max(CASE WHEN offer_type ILIKE '%salar%' THEN monthly_salary_l6m END),
           max(CASE WHEN offer_type ILIKE '%turnover%' THEN turnover_last6m_trim END)) AS income
FROM income_decision GROUP BY user_client_id"""

_C19 = """dw_customer_key AS customer_id, loan_count, total_amount_overdue, maturity_dpd,
  total_missed_installment, has_14plus_dpd, count_14plus_dpd, tenor_in_months,
  ontime_repayment_rate, age, gender, marital_status, state, location,
  purpose_of_loan AS purpose, employment_status, dw_channel_key, total_loan_amount, income"""

CTES["wide"] = f"""
SELECT {_C19} FROM metrics JOIN customer_dim USING (dw_customer_key)
LEFT JOIN incomes USING (dw_customer_key) WHERE customer_category = 'Individual'"""

CTES["raw19"] = """
SELECT * FROM wide WHERE income IS NOT NULL AND total_loan_amount <> 0
  AND abs(income / total_loan_amount) <= 100"""

CTES["registry"] = f"""
SELECT {_C19} FROM customer_dim LEFT JOIN metrics USING (dw_customer_key)
LEFT JOIN incomes USING (dw_customer_key)"""


def _title(x: str) -> str:
    return f"upper(left(trim({x}), 1)) || lower(substr(trim({x}), 2))"


def pre_clean(source: str) -> str:
    """Pre-cleaned columns; the income median is taken over the same rows."""
    blanks = ", ".join(f"coalesce({c}, '') AS {c}" for c in (
        "marital_status", "state", "location", "purpose", "employment_status", "dw_channel_key"))
    return f"""
SELECT customer_id, CAST(loan_count AS DOUBLE) AS loan_count,
  coalesce(total_amount_overdue, 0) AS total_amount_overdue,
  CAST(coalesce(maturity_dpd, 0) AS DOUBLE) AS maturity_dpd,
  CAST(coalesce(total_missed_installment, 0) AS DOUBLE) AS total_missed_installment,
  CAST(coalesce(has_14plus_dpd, 0) AS INTEGER) AS has_14plus_dpd,
  CAST(coalesce(count_14plus_dpd, 0) AS DOUBLE) AS count_14plus_dpd,
  round_even(coalesce(tenor_in_months, 1), 0) AS tenor_in_months,
  least(100.0, greatest(0.0, coalesce(ontime_repayment_rate, 100.0))) AS ontime_repayment_rate,
  CAST(least(100, greatest(18, coalesce(age, 30))) AS DOUBLE) AS age,
  {_title("coalesce(gender, '')")} AS gender, {blanks}, total_loan_amount,
  coalesce(income, (SELECT median(income) FROM {source})) AS income
FROM {source}"""


CTES["pre_raw"] = pre_clean("raw19")
CTES["pre_registry"] = pre_clean("registry")

RULES = (
    ("customer_id_above_0", "customer_id > 0"),
    ("loan_count_at_least_0", "loan_count >= 0"),
    ("total_amount_overdue_at_least_0", "total_amount_overdue >= 0"),
    ("maturity_dpd_at_least_0", "maturity_dpd >= 0"),
    ("total_missed_installment_at_least_0", "total_missed_installment >= 0"),
    ("has_14plus_dpd_in_0_1", "has_14plus_dpd BETWEEN 0 AND 1"),
    ("count_14plus_dpd_at_least_0", "count_14plus_dpd >= 0"),
    ("tenor_in_months_above_0", "tenor_in_months > 0"),
    ("ontime_repayment_rate_in_0_100", "ontime_repayment_rate BETWEEN 0 AND 100"),
    ("age_in_18_100", "age BETWEEN 18 AND 100"),
    ("total_loan_amount_above_0", "total_loan_amount > 0"),
    ("income_at_least_0", "income >= 0"),
)
WHOLE = ("loan_count", "maturity_dpd", "total_missed_installment", "count_14plus_dpd", "age")
RATIO_RULES = tuple(
    (f"{c}_in_0_1", f"{c} IS NULL OR {c} BETWEEN 0 AND 1")
    for c in ("missed_payment_ratio", "overdue_utilization", "repayment_efficiency"))


def errors_of(rules) -> str:
    arms = ", ".join(f"CASE WHEN coalesce({cond}, false) THEN NULL ELSE '{name}' END"
                     for name, cond in rules)
    return f"list_filter([{arms}], lambda x: x IS NOT NULL)"


def checked(source: str) -> str:
    whole = tuple((f"{c}_is_whole", f"{c} = floor({c})") for c in WHOLE)
    return f"""
SELECT * REPLACE (CASE WHEN gender IN ('Male', 'Female', 'Other', 'Unknown') THEN gender
  ELSE 'Unknown' END AS gender), {errors_of(RULES + whole)} AS errors FROM {source}"""


CTES["checked_raw"] = checked("pre_raw")
CTES["checked_registry"] = checked("pre_registry")

CTES["valid"] = """
SELECT * EXCLUDE (errors) REPLACE (CAST(loan_count AS BIGINT) AS loan_count,
  CAST(maturity_dpd AS BIGINT) AS maturity_dpd,
  CAST(total_missed_installment AS BIGINT) AS total_missed_installment,
  CAST(count_14plus_dpd AS BIGINT) AS count_14plus_dpd, CAST(age AS INTEGER) AS age)
FROM checked_raw WHERE len(errors) = 0"""

_OTHERS = ", ".join(
    f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'Others' ELSE {c} END AS {c}" for c in (
        "marital_status", "state", "location", "purpose", "employment_status", "dw_channel_key"))

CTES["cleaned"] = f"SELECT * REPLACE ({_OTHERS}) FROM valid WHERE age >= 18 AND age <= 65"

INCOME_CASE = """CASE WHEN income >= 1200000 AND income < 'inf'::DOUBLE THEN '1.2M and above'
  WHEN income >= 800000 AND income < 1200000 THEN '800k - 1.19M'
  WHEN income >= 500000 AND income < 800000 THEN '500k - 799k'
  WHEN income >= 300000 AND income < 500000 THEN '300k - 499k'
  WHEN income >= 150000 AND income < 300000 THEN '150k - 299k'
  WHEN income >= 70000 AND income < 150000 THEN '70k - 149k'"""

CTES["age_edges"] = """
SELECT list_sort(list_distinct([18, 65, CAST(floor(quantile_cont(age, 0.2)) AS INTEGER),
  CAST(floor(quantile_cont(age, 0.4)) AS INTEGER),
  CAST(floor(quantile_cont(age, 0.6)) AS INTEGER),
  CAST(floor(quantile_cont(age, 0.8)) AS INTEGER)])) AS e FROM cleaned"""

CTES["age_bins"] = """
SELECT e[i] AS lo, e[i + 1] AS hi, i = 1 AS is_first, e[i] || '-' || e[i + 1] AS label
FROM age_edges, unnest(range(1, len(e))) AS u(i)"""

CTES["binned"] = f"""
SELECT c.*, {INCOME_CASE} ELSE '<69k' END AS income_bracket,
  coalesce(b.label, '18-30') AS age_category
FROM cleaned c LEFT JOIN age_bins b
  ON c.age <= b.hi AND (c.age > b.lo OR (b.is_first AND c.age = b.lo))"""

CODED = ("gender", "marital_status", "purpose", "employment_status", "dw_channel_key")


def code_table(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code, "
        f"v AS category FROM (SELECT DISTINCT {f} AS v FROM {source} WHERE {f} IS NOT NULL)"
        for f in CODED)


def coded(source: str, codes: str) -> str:
    joins = " ".join(f"LEFT JOIN {codes} k_{f} ON k_{f}.feature = '{f}' AND k_{f}.category = s.{f}"
                     for f in CODED)
    columns = ", ".join(f"coalesce(k_{f}.code, -1) AS {f}" for f in CODED)
    return f"SELECT s.* REPLACE ({columns}) FROM {source} s {joins}"


CTES["codes"] = code_table("binned")
CTES["encoded"] = coded("binned", "codes")
_TEXT_CODES = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in CODED[1:])
CTES["processed"] = f"SELECT * REPLACE ('Unknown' AS gender, {_TEXT_CODES}) FROM encoded"

CTES["featured"] = """
SELECT *, least(10.0::DOUBLE, total_missed_installment
    / (CASE WHEN tenor_in_months = 0 THEN 1 ELSE tenor_in_months END + 1e-6::DOUBLE))
    AS missed_payment_ratio,
  least(1.0::DOUBLE, total_amount_overdue
    / (CASE WHEN total_loan_amount = 0 THEN 1 ELSE total_loan_amount END + 1e-6::DOUBLE))
    AS overdue_utilization,
  total_loan_amount / (CASE WHEN tenor_in_months = 0 THEN 1 ELSE tenor_in_months END
    + 1e-6::DOUBLE) AS monthly_loan_volume,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, ontime_repayment_rate / 100)) AS repayment_efficiency
FROM processed"""

CTES["survivors"] = """
SELECT * FROM featured WHERE missed_payment_ratio BETWEEN 0 AND 1
  AND overdue_utilization BETWEEN 0 AND 1 AND repayment_efficiency BETWEEN 0 AND 1"""

RISK = """CASE WHEN count_14plus_dpd <= 0 AND missed_payment_ratio <= 0.4 AND maturity_dpd <= 0
  THEN 'Low' WHEN count_14plus_dpd <= 1 AND missed_payment_ratio <= 0.7 AND maturity_dpd <= 14
  THEN 'Medium' ELSE 'High' END"""


def leveled(source: str) -> str:
    return f"""
SELECT *, {RISK} AS risk_level, CASE WHEN monthly_loan_volume >=
  (SELECT quantile_cont(monthly_loan_volume, 0.75) FROM {source})
  AND repayment_efficiency >= 0.15 THEN 'High Value' ELSE 'Low Value' END AS value_level
FROM {source}"""


def segmented(source: str) -> str:
    return f"""
SELECT * EXCLUDE (risk_level, value_level), CASE WHEN risk_level = 'High' THEN 'High Risk'
  ELSE risk_level || ' Risk - ' || value_level END AS segment FROM {source}"""


CTES["leveled_all"] = leveled("featured")
CTES["leveled"] = leveled("survivors")
CTES["segmented"] = segmented("leveled")


def long_demos(source: str, ids: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{d}' AS demo, {i} AS d, CAST({d} AS VARCHAR) AS value FROM {source}"
        for i, d in enumerate(DEMOS))


CTES["seg_long"] = long_demos("segmented", "customer_id, segment")
CTES["seg_sizes"] = "SELECT segment, count(*) AS segment_size FROM segmented GROUP BY segment"
CTES["pop_items"] = """
SELECT demo, value, count(*) AS pop_n FROM seg_long GROUP BY demo, value"""
CTES["items"] = """
SELECT i.*, s.segment_size, p.pop_n, (SELECT count(*) FROM segmented) AS pop_size
FROM (SELECT segment, demo, d, value, count(*) AS n FROM seg_long GROUP BY ALL) i
JOIN seg_sizes s USING (segment) JOIN pop_items p USING (demo, value)"""
CTES["lifted"] = """
SELECT *, n::DOUBLE / segment_size AS observed, pop_n::DOUBLE / pop_size AS expected,
  (n::DOUBLE / segment_size) / (pop_n::DOUBLE / pop_size + 1e-6::DOUBLE) AS lift FROM items"""
CTES["qualifying"] = """
SELECT *, row_number() OVER (PARTITION BY segment, demo ORDER BY n DESC, value) AS rank
FROM lifted WHERE lift >= 1.2"""

# Every customer's qualifying values in its own cohort, as a list in
# demographic order. Counted by windows over the rows: joining the long rows
# with the qualifying table derived from them stalls DuckDB on larger inputs.
CTES["basket_rows"] = """
SELECT *, dense_rank() OVER (PARTITION BY segment, demo ORDER BY n DESC, value) AS rank
FROM (SELECT *, count(*) OVER (PARTITION BY segment, demo, value) AS n,
    count(*) OVER (PARTITION BY demo, value) AS pop_n,
    count(*) OVER (PARTITION BY segment, demo) AS segment_size,
    count(*) OVER (PARTITION BY demo) AS pop_size FROM seg_long)
WHERE (n::DOUBLE / segment_size) / (pop_n::DOUBLE / pop_size + 1e-6::DOUBLE) >= 1.2"""
CTES["baskets"] = """
SELECT customer_id, segment, list(struct_pack(d := d, r := rank, t := demo || ': ' || value)
  ORDER BY d) AS items FROM basket_rows GROUP BY customer_id, segment"""
CTES["subset_counts"] = """
SELECT segment, combo, count(*) AS n FROM (
  SELECT segment, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS combo
  FROM baskets, unnest(range(1, CAST(power(2, len(items)) AS BIGINT))) AS u(mask))
WHERE len(combo) >= 2 GROUP BY ALL"""
CTES["covered"] = """
SELECT c.*, len(c.combo) AS size, s.segment_size,
  max(len(c.combo)) OVER (PARTITION BY segment) AS largest
FROM subset_counts c JOIN seg_sizes s USING (segment) WHERE c.n::DOUBLE / s.segment_size >= 0.02"""
CTES["largest"] = "SELECT * FROM covered WHERE size = largest"
# Population members of a combination: customers that hold all of its values.
CTES["held"] = """
SELECT customer_id, list(demo || ': ' || value) AS texts FROM seg_long GROUP BY customer_id"""
CTES["winners"] = """
SELECT *, row_number() OVER (PARTITION BY segment ORDER BY ds, rs) AS position,
  n::DOUBLE / segment_size AS observed_proportion,
  pop_n::DOUBLE / pop_size AS expected_proportion,
  (n::DOUBLE / segment_size) / (pop_n::DOUBLE / pop_size + 1e-6::DOUBLE) AS odds_ratio
FROM (SELECT w.segment, w.n, w.segment_size, w.size, [x.d FOR x IN w.combo] AS ds,
    [x.r FOR x IN w.combo] AS rs, list_aggregate([x.t FOR x IN w.combo], 'string_agg', ' | ')
    AS combination,
    (SELECT count(*) FROM held h WHERE list_has_all(h.texts, [x.t FOR x IN w.combo])) AS pop_n,
    (SELECT count(*) FROM segmented) AS pop_size FROM largest w)"""
CTES["top_profiles"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment
  ORDER BY observed_proportion DESC, odds_ratio DESC, position) AS place FROM winners)
WHERE place <= 2"""
CTES["profiles"] = """
SELECT segment, 'C' || position AS combination_id, combination, observed_proportion,
  expected_proportion, odds_ratio, n AS count, observed_proportion AS coverage,
  CAST(place AS INTEGER) AS place FROM top_profiles"""

# Readable texts: the run's own labels, and the fixed label list.
CTES["profile_parts"] = """
SELECT segment, place, i AS pos, split_part(part, ': ', 1) AS demo,
  substr(part, strpos(part, ': ') + 2) AS value
FROM (SELECT segment, place, string_split(combination, ' | ') AS parts FROM profiles),
  unnest(range(1, len(parts) + 1)) AS u(i), unnest([parts[i]]) AS v(part)"""
_FALLBACK = """CASE demo WHEN 'income_bracket' THEN 'income: ' WHEN 'age_category' THEN 'age: '
  WHEN 'dw_channel_key' THEN 'channel: ' WHEN 'employment_status' THEN 'employment: '
  WHEN 'purpose' THEN 'for_' ELSE demo || ': ' END || value"""
CTES["decoded"] = f"""
SELECT segment, place, string_agg(coalesce(lower(category), {_FALLBACK}), ', ' ORDER BY pos) AS text
FROM profile_parts LEFT JOIN codes ON feature = demo AND CAST(code AS VARCHAR) = value
GROUP BY segment, place"""
CTES["wide_profile"] = "SELECT " + ", ".join(
    f"coalesce(string_agg(text, ', ' ORDER BY place) FILTER (WHERE segment = '{s}'), '') AS {c}"
    for s, c in zip(SEGMENT_NAMES, (
        "low_risk_high_value", "low_risk_low_value", "medium_risk_high_value",
        "medium_risk_low_value", "high_risk"))) + " FROM decoded"

# Exploratory flow ----------------------------------------------------------
_EX_FILL = ", ".join(f"coalesce({c}, 'Others') AS {c}" for c in (
    "employment_status", "marital_status", "state", "location"))
CTES["ex_known"] = f"""
SELECT * REPLACE ({_EX_FILL}), {INCOME_CASE} WHEN income >= 0 AND income < 70000 THEN '<69k' END
  AS income_bracket
FROM raw19 WHERE gender IS NOT NULL AND gender <> 'Unknown' AND age IS NOT NULL
  AND dw_channel_key IS NOT NULL AND income IS NOT NULL"""
CTES["ex_upto"] = "SELECT * FROM ex_known WHERE age <= 65"
CTES["ex_start"] = """
SELECT floor(count(*) / 4) * 0.5 AS smallest, 18 AS e0,
  CAST(floor(quantile_cont(age, 0.2)) AS INTEGER) AS e1,
  CAST(floor(quantile_cont(age, 0.4)) AS INTEGER) AS e2,
  CAST(floor(quantile_cont(age, 0.6)) AS INTEGER) AS e3,
  CAST(floor(quantile_cont(age, 0.8)) AS INTEGER) AS e4, 65 AS e5 FROM ex_upto"""


def _merge(i: int) -> str:
    lo, hi = f"e{i - 1}", f"e{i}"
    return (f"SELECT * REPLACE (CASE WHEN (SELECT count(*) FROM ex_upto WHERE age >= s.{lo} "
            f"AND age < s.{hi}) < smallest THEN {lo} ELSE {hi} END AS {hi}) FROM {{}} s")


CTES["ex_m1"] = _merge(1).format("ex_start")
CTES["ex_m2"] = _merge(2).format("ex_m1")
CTES["ex_m3"] = _merge(3).format("ex_m2")
CTES["ex_m4"] = _merge(4).format("ex_m3")


def _split(source: str) -> str:
    """Split the widest gap (the last of equals) while there are fewer than five edges."""
    widest = ("list_max([{'w': e[i + 1] - e[i], 'i': i} FOR i IN range(1, len(e))])")
    return (f"SELECT CASE WHEN len(e) >= 5 THEN e ELSE list_sort(list_distinct(list_append(e, "
            f"CAST(e[m.i] + m.w // 2 AS INTEGER)))) END AS e FROM (SELECT e, {widest} AS m FROM {source})")


CTES["ex_s0"] = "SELECT list_sort(list_distinct([e0, e1, e2, e3, e4, e5])) AS e FROM ex_m4"
CTES["ex_s1"] = _split("ex_s0")
CTES["ex_s2"] = _split("ex_s1")
CTES["ex_s3"] = _split("ex_s2")
CTES["ex_edges"] = """
SELECT [18] || list_filter(e, lambda x: x > 18 AND x < 65) || [65] AS e FROM ex_s3"""
CTES["ex_bins"] = """
SELECT e[i] AS lo, e[i + 1] AS hi, i = 1 AS is_first,
  (CASE WHEN i = 1 THEN e[i] ELSE e[i] + 1 END) || '-' || e[i + 1] AS label
FROM ex_edges, unnest(range(1, len(e))) AS u(i)"""
CTES["ex_adults"] = """
SELECT c.*, b.label AS age_category FROM ex_upto c LEFT JOIN ex_bins b
  ON c.age <= b.hi AND (c.age > b.lo OR (b.is_first AND c.age = b.lo))"""
CTES["ex_codes"] = code_table("ex_adults")
CTES["ex_coded"] = coded("ex_adults", "ex_codes")
CTES["ex_featured"] = """
SELECT *, total_missed_installment / (tenor_in_months + 1e-6::DOUBLE) AS missed_payment_ratio,
  total_amount_overdue / (total_loan_amount + 1e-6::DOUBLE) AS overdue_utilization,
  total_loan_amount / (tenor_in_months + 1e-6::DOUBLE) AS monthly_loan_volume,
  ontime_repayment_rate / 100 AS repayment_efficiency FROM ex_coded"""
CTES["ex_leveled"] = leveled("ex_featured")
CTES["ex_segmented"] = segmented("ex_leveled")

CLUSTER = ("count_14plus_dpd", "maturity_dpd", "missed_payment_ratio", "overdue_utilization",
           "ontime_repayment_rate")
CTES["ex_scaled"] = "SELECT * REPLACE (" + ", ".join(
    f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}"
    for c in CLUSTER) + ") FROM ex_segmented"
CTES["ex_split"] = f"""
SELECT * EXCLUDE (place, n), CASE WHEN n >= 100 THEN CASE WHEN place <= n // 2 THEN 1 ELSE 2 END
  END AS sub_cluster
FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY cluster_score, customer_id)
    AS place, count(*) OVER (PARTITION BY segment) AS n
  FROM (SELECT *, round(({' + '.join(CLUSTER)}) / 5, 9) AS cluster_score FROM ex_scaled))"""
CTES["ex_pop_long"] = long_demos("ex_featured", "customer_id")
CTES["ex_pop"] = """
SELECT demo, value, count(*) AS pop_n FROM ex_pop_long WHERE value IS NOT NULL
GROUP BY demo, value"""
CTES["ex_split_long"] = long_demos("ex_split", "customer_id, segment, sub_cluster")

# k-means: centres at fixed places of the row mean, then ten unrolled steps.
_DIM = range(1, len(CLUSTER) + 1)
CTES["km_points"] = f"""
SELECT *, row_number() OVER (ORDER BY score, customer_id) AS place, count(*) OVER () AS n
FROM (SELECT *, round(({" + ".join(f"x{i}" for i in _DIM)}) / {len(CLUSTER)}, 9) AS score FROM (
  SELECT customer_id, {", ".join(f"round({c}, 9) AS x{i}" for i, c in zip(_DIM, CLUSTER))} FROM ex_scaled))"""
CTES["km_c0"] = f"""
SELECT k, i, {", ".join(f"x{d}" for d in _DIM)} FROM km_points
JOIN (SELECT k, i FROM range(1, 5) AS a(k), range(1, 5) AS b(i) WHERE i <= k)
  ON place = ((2 * i - 1) * n) // (2 * k) + 1"""


def _assigned(centres: str) -> str:
    apart = " + ".join(f"(p.x{d} - c.x{d}) * (p.x{d} - c.x{d})" for d in _DIM)
    return f"""
SELECT customer_id, k, i, d, {", ".join(f"x{d}" for d in _DIM)} FROM (
  SELECT p.*, c.k, c.i, {apart} AS d, row_number() OVER (PARTITION BY p.customer_id, c.k ORDER BY {apart}, c.i) AS rank
  FROM km_points p JOIN {centres} c ON true) WHERE rank = 1"""


def _recentred(step: int) -> str:
    means = ", ".join(f"coalesce(CAST(sum(CAST(a.x{d} AS DECIMAL(20,9))) AS DOUBLE) / count(a.x{d}), any_value(c.x{d})) AS x{d}"
                      for d in _DIM)
    return f"""
SELECT c.k, c.i, {means} FROM km_c{step - 1} c LEFT JOIN km_a{step} a ON a.k = c.k AND a.i = c.i GROUP BY c.k, c.i"""


KM_STEPS = 10
for _step in range(1, KM_STEPS + 1):
    CTES[f"km_a{_step}"] = _assigned(f"km_c{_step - 1}")
    CTES[f"km_c{_step}"] = _recentred(_step)
CTES["km_last"] = _assigned(f"km_c{KM_STEPS}")
CTES["km_inertia"] = """
SELECT k, CAST(sum(CAST(d AS DECIMAL(38,12))) AS DOUBLE) AS inertia FROM km_last GROUP BY k"""

# Search without a coverage threshold.
CTES["ex_long"] = long_demos("ex_segmented", "customer_id, segment")
CTES["ex_population"] = "SELECT * FROM ex_segmented WHERE age_category IS NOT NULL"
CTES["ex_items"] = """
SELECT i.*, coalesce(p.pop_n, 0) AS pop_n,
  i.n::DOUBLE / sum(i.n) OVER (PARTITION BY i.segment, i.demo) AS observed,
  coalesce(p.pop_n, 0)::DOUBLE / (SELECT count(*) FROM ex_population) AS expected
FROM (SELECT segment, demo, d, value, count(*) AS n FROM ex_long GROUP BY ALL) i
LEFT JOIN ex_pop p USING (demo, value)"""
CTES["ex_qualifying"] = """
SELECT *, row_number() OVER (PARTITION BY segment, demo ORDER BY n DESC, value NULLS FIRST) AS rank
FROM ex_items WHERE observed / (expected + 1e-6::DOUBLE) >= 1.2"""


def _product_step(i: int) -> str:
    """Extend every partial product by each qualifying value of demographic i, if any."""
    source = f"ex_p{i - 1}" if i else "(SELECT segment, [] AS rs, []::VARCHAR[] AS ts, []::INTEGER[] AS ds FROM (SELECT DISTINCT segment FROM ex_qualifying))"
    return f"""
SELECT p.segment, CASE WHEN q.rank IS NULL THEN p.rs ELSE list_append(p.rs, q.rank) END AS rs,
  CASE WHEN q.rank IS NULL THEN p.ts ELSE list_append(p.ts, q.demo || ': '
    || coalesce(q.value, 'nan')) END AS ts,
  CASE WHEN q.rank IS NULL THEN p.ds ELSE list_append(p.ds, q.d) END AS ds
FROM {source} p LEFT JOIN ex_qualifying q ON q.segment = p.segment AND q.d = {i}"""


for _i in range(len(DEMOS)):
    CTES[f"ex_p{_i}"] = _product_step(_i)
CTES["ex_held"] = """
SELECT customer_id, segment, list(demo || ': ' || value) AS texts FROM ex_long
WHERE value IS NOT NULL GROUP BY ALL"""
CTES["ex_products"] = f"""
SELECT p.segment, len(p.ds) AS size, list_aggregate(p.ts, 'string_agg', ' | ') AS combination, p.ts,
  row_number() OVER (ORDER BY list_position({list(SEGMENT_NAMES)}, p.segment), p.rs) AS position
FROM ex_p6 p WHERE len(p.ds) >= 2"""
CTES["ex_scored"] = """
SELECT p.*, (SELECT count(*) FROM ex_held h WHERE h.segment = p.segment
    AND list_has_all(h.texts, p.ts)) AS n,
  (SELECT count(*) FROM ex_held h JOIN ex_population USING (customer_id)
    WHERE list_has_all(h.texts, p.ts)) AS pop_n,
  (SELECT count(*) FROM ex_segmented s WHERE s.segment = p.segment) AS segment_size,
  (SELECT count(*) FROM ex_population) AS pop_size FROM ex_products p"""
CTES["ex_best"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment
    ORDER BY observed_proportion DESC, odds_ratio DESC, position) AS place
  FROM (SELECT segment, size, 'C' || position AS combination_id, combination, position, n,
      n::DOUBLE / segment_size AS coverage,
      round_even(n::DOUBLE / segment_size, 4) AS observed_proportion,
      round_even(pop_n::DOUBLE / pop_size, 4) AS expected_proportion,
      round_even((n::DOUBLE / segment_size) / (pop_n::DOUBLE / pop_size + 1e-6::DOUBLE), 3)
        AS odds_ratio FROM ex_scored)) WHERE place <= 2"""

_TABLE = re.compile(r"\b(?:FROM|JOIN)\s+([a-z_][a-z0-9_]*)")


def with_ctes(final: str) -> str:
    """The final SELECT preceded by every CTE it needs, in dependency order."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in _TABLE.findall(text):
            if name in CTES and name not in ordered:
                need(CTES[name])
                ordered.append(name)

    need(final)
    body = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name].strip()})" for name in ordered)
    return f"WITH {body}\n{final.strip()}" if ordered else final.strip()
