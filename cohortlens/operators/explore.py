"""Dataset summaries and breakdowns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cohortlens.functions.columns import case, number, quote
from cohortlens.functions.ranks import exact_quantiles
from cohortlens.functions.staging import unpivot_numbers, unpivot_text

FLAG = "has_14plus_dpd"


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("int", "bigint", "double", "float", "smallint", "tinyint")
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() in kinds
            or f.dataType.simpleString().startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]


def _sum_up(df: DataFrame, columns: list[str], *aggregates: str) -> DataFrame:
    """One row per numeric column; `x` is the value in the aggregates."""
    return (unpivot_numbers(df, [], columns).groupBy("column_name")
            .agg(*[F.expr(a) for a in aggregates]))


def with_quantiles(summary: DataFrame, df: DataFrame, columns: list[str],
                   probs: dict[str, float], digits: int = 6) -> DataFrame:
    """Adds exact quantile columns to a one-row-per-column summary."""
    found = exact_quantiles(df, columns, list(probs.values()))
    out = summary
    for i, name in enumerate(probs):
        arms = [(f"column_name = {quote(c)}", number(found[c][i])) for c in columns
                if found[c][i] is not None]
        value = case(arms) if arms else "cast(NULL AS double)"
        out = out.withColumn(name, F.expr(f"round({value}, {digits})"))
    return out


def numeric_summary(df: DataFrame) -> DataFrame:
    """min, max, mean, median, sample std, zeros and missing per numeric column."""
    columns = numeric_columns(df)
    summary = _sum_up(
        df, columns, "round(min(x), 6) AS min", "round(max(x), 6) AS max",
        "round(avg(x), 6) AS mean", "round(stddev_samp(x), 6) AS std",
        "count_if(x = 0) AS zeros", "count_if(x IS NULL) AS missing")
    return with_quantiles(summary, df, columns, {"median": 0.5})


def categorical_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct values, distinct frequencies, top value and missing per text column.

    `distinct_frequencies` counts how many different value counts occur, which
    is what the earlier summaries published as the number of unique values.
    """
    columns = columns or text_columns(df)
    counts = (unpivot_text(df, [], columns, "column_name", "value")
              .groupBy("column_name", "value").agg(F.count("*").alias("n")))
    # Ties of the top count go to the smallest value. The minimum of
    # (-n, value) combines on the map side, so no column is ever sorted.
    return counts.groupBy("column_name").agg(
        F.expr("count(value) AS distinct_values"),
        F.expr("count(DISTINCT if(value IS NOT NULL, n, NULL)) AS distinct_frequencies"),
        F.expr("min(struct(-n AS k, value)) FILTER (WHERE value IS NOT NULL) AS top"),
        F.expr("coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS missing"),
    ).selectExpr("column_name", "distinct_values", "distinct_frequencies",
                 "top.value AS top_value", "coalesce(-top.k, 0) AS top_count", "missing")


def _wide_counts(df: DataFrame) -> DataFrame:
    """One pass: per column a struct of null and non-null counts, turned long."""
    cells = ", ".join(
        f"named_struct('column_name', {quote(c)}, 'missing', count_if({c} IS NULL), "
        f"'present', count({c}))" for c in df.columns)
    return df.agg(F.expr(f"array({cells}) AS cells")).selectExpr("inline(cells)")


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, and the total under '(all)'."""
    per_column = _wide_counts(df).select("column_name", "missing")
    return per_column.rollup("column_name").agg(F.sum("missing").alias("missing")).select(
        F.coalesce("column_name", F.lit("(all)")).alias("column_name"), "missing")


def null_ratios(df: DataFrame) -> DataFrame:
    """Missing over present values; NULL for a column that is all missing."""
    return _wide_counts(df).selectExpr(
        "column_name", "missing", "present",
        "round(try_divide(cast(missing AS double), cast(present AS double)), 6) AS null_ratio")


def column_profile(df: DataFrame) -> DataFrame:
    """Type, distinct and missing values per column."""
    types = F.create_map(*[F.lit(v) for f in df.schema.fields
                           for v in (f.name, f.dataType.simpleString())])
    # Adding 0.0 makes -0.0 and 0.0 one value before they become text.
    floats = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("float", "double")]
    df = df.withColumns({c: F.expr(f"`{c}` + 0.0D") for c in floats})
    counts = (unpivot_text(df, [], df.columns, "column_name", "value")
              .groupBy("column_name").agg(F.countDistinct("value").alias("distinct_values"),
                                          F.expr("count_if(value IS NULL) AS missing")))
    return counts.withColumn("data_type", types[F.col("column_name")])


def default_analysis(df: DataFrame) -> DataFrame:
    return df.agg(F.expr(f"round(avg(cast({FLAG} AS double)), 6) AS default_rate"),
                  F.expr(f"sum(cast({FLAG} AS bigint)) AS default_count"),
                  F.expr(f"count_if({FLAG} = 0) AS non_default_count"))


def describe(df: DataFrame, probs: list[float], columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, percentiles (linear) and max per numeric column."""
    columns = columns or numeric_columns(df)
    summary = _sum_up(
        df, columns, "count(x) AS count", "round(avg(x), 6) AS mean",
        "round(stddev_samp(x), 6) AS std", "round(min(x), 6) AS min", "round(max(x), 6) AS max")
    names = {f"p{p * 100:g}": p for p in probs}
    return with_quantiles(summary, df, columns, names)


def snapshot(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Best, average, median and worst case per metric, with the sample size."""
    summary = _sum_up(
        df, metrics, "round(min(x), 6) AS best_case", "round(avg(x), 6) AS average",
        "round(max(x), 6) AS worst_case", "count(*) AS sample_size")
    return with_quantiles(summary, df, metrics, {"median": 0.5})


def value_counts(df: DataFrame, columns: list[str], keep_null: bool = True) -> DataFrame:
    """Count per value of each column, largest first."""
    long = unpivot_text(df, [], columns, "column_name", "value")
    if not keep_null:
        long = long.where("value IS NOT NULL")
    return (long.groupBy("column_name", "value").agg(F.count("*").alias("n"))
            .orderBy("column_name", F.desc("n"), "value"))


def with_share(counts: DataFrame, n: str = "n", digits: int = 4) -> DataFrame:
    """Percent of the total, for a result of a few rows."""
    return (counts.withColumn("_total", F.sum(n).over(Window.partitionBy()))
            .withColumn("percent", F.expr(f"round({n} * 100D / _total, {digits})"))
            .drop("_total"))


def segment_distribution(df: DataFrame) -> DataFrame:
    return with_share(df.groupBy("segment").agg(F.count("*").alias("n")))


def default_rate_by(df: DataFrame, dims: list[str]) -> DataFrame:
    """Mean, sum and count of the default flag per value of several dimensions, one pass."""
    return (unpivot_text(df, [FLAG], dims, "dimension", "value").where("value IS NOT NULL")
            .groupBy("dimension", "value")
            .agg(F.expr(f"round(avg(cast({FLAG} AS double)), 6) AS default_rate"),
                 F.expr(f"sum(cast({FLAG} AS bigint)) AS defaults"),
                 F.count("*").alias("customers"))
            .orderBy("dimension", F.desc("default_rate"), "value"))


def rate_against_overall(df: DataFrame, dim: str) -> DataFrame:
    """Default rate per value next to the overall rate.

    The overall rate comes from the per-value sums, not from a second scan.
    """
    everyone = Window.partitionBy()
    return (df.groupBy(F.col(dim).alias("value"))
            .agg(F.expr(f"sum(cast({FLAG} AS bigint)) AS defaults"),
                 F.count(FLAG).alias("customers"))
            .withColumn("all_defaults", F.sum("defaults").over(everyone))
            .withColumn("all_customers", F.sum("customers").over(everyone))
            .where("value IS NOT NULL")
            .selectExpr("value", "round(defaults / customers, 6) AS default_rate", "customers",
                        "round(all_defaults / all_customers, 6) AS overall_rate"))


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every numeric pair over rows where both are present.

    Built from covariance and deviations with a guarded division: `corr`
    raises on a constant column in ANSI mode. Constant columns give NULL.
    """
    columns = columns or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    cells = ", ".join(f"{quote(a)}, {quote(b)}, cast({a} AS double), cast({b} AS double)"
                      for a, b in pairs)
    # One short aggregate over (pair, x, y) rows keeps the generated code
    # small; the rows collapse to one per pair before the shuffle.
    long = df.selectExpr(f"stack({len(pairs)}, {cells}) AS (column_a, column_b, x, y)").selectExpr(
        "column_a", "column_b", "if(y IS NULL, NULL, x) AS x", "if(x IS NULL, NULL, y) AS y")
    return long.groupBy("column_a", "column_b").agg(F.expr(
        "round(try_divide(covar_pop(x, y), stddev_pop(x) * stddev_pop(y)), 6) AS r"))


def revenue_share(df: DataFrame) -> DataFrame:
    """Revenue per cohort and its share of the total, largest first."""
    amount = "cast(total_loan_amount - total_amount_overdue AS decimal(28,4))"
    return (df.groupBy("segment").agg(F.expr(f"sum({amount}) AS revenue"))
            .withColumn("total", F.sum("revenue").over(Window.partitionBy()))
            .selectExpr("segment", "round(cast(revenue AS double), 2) AS total_revenue",
                        "bround(cast(revenue AS double) / cast(total AS double) * 100, 1) "
                        "AS revenue_share")
            .orderBy(F.desc("total_revenue")))


def key_check(df: DataFrame, key: str = "customer_id") -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("distinct_keys"),
                  F.min(key).alias("min_key"), F.max(key).alias("max_key")).withColumn(
        "is_unique", F.expr("rows = distinct_keys"))


def top_states(df: DataFrame, n: int = 10) -> DataFrame:
    return (df.where("state IS NOT NULL").groupBy("state")
            .agg(F.expr(f"round(avg(cast({FLAG} AS double)), 6) AS default_rate"))
            .orderBy(F.desc("default_rate"), "state").limit(n))


def state_counts(df: DataFrame) -> DataFrame:
    return (df.where("state IS NOT NULL").groupBy("state").agg(F.count("*").alias("n"))
            .orderBy("n", "state"))


def sample_rows(df: DataFrame, n: int = 5, key: str = "customer_id") -> DataFrame:
    return df.orderBy(key).limit(n)


def missing_income(df: DataFrame) -> DataFrame:
    return df.where("income IS NULL OR income = 0").select("customer_id", "income")
