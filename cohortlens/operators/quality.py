"""Row contracts as data: a list of named predicates, checked in one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cohortlens.config import CohortConfig, DEFAULT, SEGMENTS
from cohortlens.functions.columns import quote, title, to_number, with_exprs
from cohortlens.operators.customer_table import CUSTOMER_COLUMNS

INTEGER_FIELDS = ("customer_id", "loan_count", "maturity_dpd", "total_missed_installment",
                  "has_14plus_dpd", "count_14plus_dpd", "age")
SMALL_INTEGER_FIELDS = ("has_14plus_dpd", "age")
FLOAT_FIELDS = ("total_amount_overdue", "tenor_in_months", "ontime_repayment_rate",
                "total_loan_amount", "income")
OPTIONAL_TEXT_FIELDS = ("marital_status", "state", "location", "purpose",
                        "employment_status", "dw_channel_key")
RATIO_FIELDS = ("missed_payment_ratio", "overdue_utilization", "repayment_efficiency")
FEATURE_FIELDS = ("missed_payment_ratio", "overdue_utilization", "monthly_loan_volume",
                  "repayment_efficiency")
PROCESSED_COLUMNS = CUSTOMER_COLUMNS + ("income_bracket", "age_category") + FEATURE_FIELDS + (
    "segment",)

# The gender names a record may carry.
GENDERS = ("Male", "Female", "Other", "Unknown")


@dataclass(frozen=True)
class Rule:
    """A row passes if `holds` (SQL) is true; NULL counts as broken."""

    name: str
    holds: str


def _at_least(c: str, low: float) -> Rule:
    return Rule(f"{c}_at_least_{low:g}", f"{c} >= {low}")


def _above(c: str, low: float) -> Rule:
    return Rule(f"{c}_above_{low:g}", f"{c} > {low}")


def _between(c: str, low: float, high: float) -> Rule:
    return Rule(f"{c}_in_{low:g}_{high:g}", f"{c} BETWEEN {low} AND {high}")


def _whole(c: str) -> Rule:
    return Rule(f"{c}_is_whole", f"cast({c} AS double) = rint(cast({c} AS double))")


def raw_rules(df: DataFrame) -> list[Rule]:
    """The 19-column contract. Whole-number checks only where the type allows fractions."""
    fractional = {name for name, kind in df.dtypes
                  if kind in ("double", "float", "string") or kind.startswith("decimal")}
    return [
        _above("customer_id", 0),
        _at_least("loan_count", 0),
        _at_least("total_amount_overdue", 0),
        _at_least("maturity_dpd", 0),
        _at_least("total_missed_installment", 0),
        _between("has_14plus_dpd", 0, 1),
        _at_least("count_14plus_dpd", 0),
        _above("tenor_in_months", 0),
        _between("ontime_repayment_rate", 0, 100),
        _between("age", 18, 100),
        _above("total_loan_amount", 0),
        _at_least("income", 0),
        *[_whole(c) for c in INTEGER_FIELDS if c in fractional],
    ]


def derived_rules(df: DataFrame, config: CohortConfig = DEFAULT) -> list[Rule]:
    """Ratio bounds and cohort names, for the columns present. NULL is allowed."""
    rules = [Rule(f"{c}_in_0_1", f"{c} IS NULL OR {c} BETWEEN 0 AND 1")
             for c in RATIO_FIELDS if c in df.columns
             and not (config.keep_overdrawn_ratios and c == "missed_payment_ratio")]
    if "segment" in df.columns:
        names = ", ".join(map(quote, SEGMENTS))
        rules.append(Rule("segment_known", f"segment IS NULL OR segment IN ({names})"))
    return rules


def coerce_record(df: DataFrame, keep_gender: bool = False) -> DataFrame:
    """Field coercions of the contract: tenor, optional texts, gender names."""
    name = title("cast(gender AS string)")
    names = ", ".join(map(quote, GENDERS))
    changes = {c: f"coalesce(cast({c} AS string), '')" for c in OPTIONAL_TEXT_FIELDS}
    changes["tenor_in_months"] = f"coalesce({to_number('tenor_in_months')}, 1D)"
    if not keep_gender:
        changes["gender"] = f"if({name} IN ({names}), {name}, 'Unknown')"
    else:
        changes["gender"] = "cast(gender AS string)"
    return with_exprs(df, changes)


def with_errors(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds `errors`, the names of the broken rules."""
    broken = [f"if(coalesce({r.holds}, false), NULL, {quote(r.name)})" for r in rules]
    return df.withColumn("errors", F.expr(f"array_compact(array({', '.join(broken)}))"))


def to_contract_types(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    wanted = {c: "int" if c in SMALL_INTEGER_FIELDS else "bigint" for c in INTEGER_FIELDS}
    wanted.update({c: "double" for c in FLOAT_FIELDS})
    return with_exprs(df, {c: f"cast({c} AS {t})" for c, t in wanted.items() if types[c] != t})


def valid_rows(checked: DataFrame) -> DataFrame:
    return to_contract_types(checked.where("size(errors) = 0").drop("errors"))


def rejected_rows(checked: DataFrame) -> DataFrame:
    """Quarantine table: who failed and which rules broke."""
    return checked.where("size(errors) > 0").selectExpr(
        "customer_id", "size(errors) AS n_errors", "array_join(errors, '; ') AS error")


def check_raw(df: DataFrame) -> DataFrame:
    coerced = coerce_record(df)
    return with_errors(coerced, raw_rules(coerced))


def recode(df: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Coded rows in contract form: contract columns only, codes as text.

    A coded gender is not a valid gender name, so it becomes 'Unknown' here
    unless the config keeps it.
    """
    kept = df.select(*[c for c in PROCESSED_COLUMNS if c in df.columns])
    return to_contract_types(coerce_record(kept, keep_gender=config.keep_gender))


def check_derived(df: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Only the rules about derived columns, for rows that passed the raw contract."""
    return with_errors(df, derived_rules(df, config))


def check_processed(df: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Full contract of processed rows: raw rules again plus the derived ones."""
    coded = recode(df, config)
    return with_errors(coded, raw_rules(coded) + derived_rules(coded, config))


def report(checked: DataFrame) -> DataFrame:
    """One row: total, valid, invalid and valid percent."""
    return checked.selectExpr("size(errors) = 0 AS ok").agg(
        F.expr("count(*) AS total_records"),
        F.expr("count_if(ok) AS valid_records"),
        F.expr("count_if(NOT ok) AS invalid_records"),
        F.expr("round(try_divide(count_if(ok) * 100D, count(*)), 4) AS valid_percent"))


def errors_by_rule(checked: DataFrame) -> DataFrame:
    return (checked.select(F.explode("errors").alias("rule"))
            .groupBy("rule").agg(F.count("*").alias("n")))


def first_errors(checked: DataFrame, n: int = 10) -> DataFrame:
    return rejected_rows(checked).orderBy("customer_id").limit(n)


FEATURE_INPUTS = ("total_missed_installment", "tenor_in_months", "total_amount_overdue",
                  "total_loan_amount", "ontime_repayment_rate")


def require_columns(df: DataFrame, needed: tuple[str, ...] = FEATURE_INPUTS) -> DataFrame:
    """Stop before planning if an input is missing, with look-alike names as hints."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        hints = {m: [c for c in df.columns if m.lower() in c.lower() or c.lower() in m.lower()]
                 for m in missing}
        raise KeyError(f"missing columns {missing}; similar names: {hints}")
    return df
