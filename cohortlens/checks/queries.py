"""One registered query per operator, all starting from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.config import CODED_DEMOGRAPHICS, DEMOGRAPHICS, SEGMENTS
from cohortlens.functions import columns as sql
from cohortlens.functions.fingerprint import fingerprint
from cohortlens.functions.staging import new_path, write_stage
from cohortlens.operators import (
    binning, cleaning, clustering, customer_table as ct, decode, encoding, explore, features, profiles,
    quality, scoring, sketches, subclusters)
from cohortlens.plans.exploration import Exploration, known_customers
from cohortlens.plans.pipeline import CohortRun
from cohortlens.sources import adapter, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Times and run ids of the registered runs, so results repeat.
FIRST_RUN, SECOND_RUN = "20260101_080000", "20260102_080000"
FIRST_TIME = "timestamp_ntz'2026-01-01 08:00:00'"
SECOND_TIME = "timestamp_ntz'2026-01-02 08:00:00'"


def query(f):
    QUERIES[f.__name__] = f
    return f


def on_run(f):
    """Register a query over the full run."""
    QUERIES[f.__name__] = lambda spark, sf: f(CohortRun(adapter.inputs(spark, sf)))
    return f


def on_inputs(f):
    """Register a query over the three inputs."""
    QUERIES[f.__name__] = lambda spark, sf: f(adapter.inputs(spark, sf))
    return f


def on_fact(f):
    QUERIES[f.__name__] = lambda spark, sf: f(adapter.inputs(spark, sf).loan_fact)
    return f


def on_registry(f):
    """Register a query over all customers of the dimension, where gaps occur."""
    QUERIES[f.__name__] = lambda spark, sf: f(ct.registry_customers(adapter.inputs(spark, sf)))
    return f


def on_exploration(f):
    QUERIES[f.__name__] = lambda spark, sf: f(Exploration(adapter.inputs(spark, sf)))
    return f


# -- sources and sinks -------------------------------------------------------

@on_run
def src_extract(run):
    return run.raw


@on_run
def src_csv(run):
    return sinks.round_trip(run.raw, "customers-csv", "csv")


@on_run
def src_parquet(run):
    return sinks.round_trip(run.raw, "customers-parquet")


@on_run
def src_latest_run(run):
    path = new_path(run.raw.sparkSession, "runs")
    sinks.append_run(run.checked.df.select("customer_id"), path, FIRST_RUN)
    sinks.append_run(run.valid.select("customer_id"), path, SECOND_RUN)
    return sinks.latest_run(sinks.read_table(run.raw.sparkSession, path))


@on_run
def sink_raw(run):
    return (sinks.round_trip(run.valid, "raw").withColumn("format", F.lit("parquet"))
            .unionByName(sinks.round_trip(run.valid, "raw", "csv")
                         .withColumn("format", F.lit("csv"))))


@on_run
def sink_metadata(run):
    raw, figures = sinks.observed(run.valid)
    written = sinks.round_trip(raw, "raw")
    rows = sinks.metadata(written, figures.get, "warehouse", FIRST_TIME, "customer table")
    return sinks.round_trip(rows, "metadata").selectExpr("* EXCEPT (summary)", "inline(summary)")


@on_run
def sink_features(run):
    path = new_path(run.raw.sparkSession, "features")
    kept = run.survivors.df.select("customer_id", *quality.FEATURE_FIELDS)
    sinks.append_run(kept, path, FIRST_RUN)
    return sinks.read_table(run.raw.sparkSession, path).selectExpr(
        "customer_id", *[f"round({c}, 6) AS {c}" for c in quality.FEATURE_FIELDS], "run_id")


@on_run
def sink_run_artifacts(run):
    """Rows and fingerprint of every table that a run leaves behind."""
    spark = run.raw.sparkSession
    paths = run.save(new_path(spark, "artifacts"), FIRST_RUN, FIRST_TIME)
    tables = {name: sinks.read_table(spark, path).drop("run_id", "summary") for name, path in paths.items()
              if name not in ("customer_segment", "segment_profile")}
    changes = sinks.segment_rows(run.segmented, FIRST_TIME)
    tables["customer_segment"] = sinks.read_upserted(spark, paths["customer_segment"], changes.schema)
    tables["segment_profile"] = spark.read.parquet(sinks.current_version(spark, paths["segment_profile"]))
    parts = [fingerprint(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _upserted(run: CohortRun) -> DataFrame:
    """All valid customers as not assigned, then the cohorts of this run on top."""
    path = new_path(run.raw.sparkSession, "customer_segment")
    sinks.upsert_parquet(path, sinks.segment_rows(
        run.valid.selectExpr("customer_id", "'Not assigned' AS segment"), FIRST_TIME), unique=True)
    return sinks.upsert_parquet(path, sinks.segment_rows(run.segmented, SECOND_TIME))


@on_run
def sink_segment_upsert(run):
    return _upserted(run)


@on_run
def sink_profile_replace(run):
    path = new_path(run.raw.sparkSession, "segment_profile")
    wide = run.wide_profile()
    sinks.replace_table(wide.selectExpr(*[f"'old' AS {c}" for c in wide.columns]), path)
    return sinks.replace_table(wide, path)


def _registry_checked(registry: DataFrame) -> DataFrame:
    stage = write_stage(cleaning.pre_clean(registry), "registry")
    return quality.check_raw(cleaning.fill_medians(stage.df, ["income"]))


@on_registry
def sink_quarantine(registry):
    return sinks.round_trip(quality.rejected_rows(_registry_checked(registry)), "quarantine")


@on_run
def sink_readback(run):
    return sinks.segment_counts(_upserted(run))


# -- filters, projections, cleaning ------------------------------------------

@on_fact
def flt_product(fact):
    return ct.keep_included(fact).select("dw_customer_key", "loan_ref", "product_code",
                                         "dw_date_key")


@on_inputs
def flt_category(src):
    return ct.category_customers(src.customer_dim).select(
        "dw_customer_key", "age", "state", "customer_category")


@on_inputs
def flt_income_ratio(src):
    return ct.customer_table(src).selectExpr(
        "customer_id", "income", "total_loan_amount",
        "round(abs(income / total_loan_amount), 6) AS ratio")


@on_inputs
def prj_19col(src):
    return ct.unfiltered_customers(src)


@on_registry
def clean_preclean(registry):
    stage = write_stage(cleaning.pre_clean(registry), "registry")
    return cleaning.fill_medians(stage.df, ["income"])


@on_registry
def dq_validate_raw(registry):
    return _registry_checked(registry).selectExpr(
        "customer_id", "size(errors) = 0 AS is_valid", "array_join(errors, '; ') AS error")


@on_registry
def dq_coerce(registry):
    return quality.coerce_record(registry).select(
        "customer_id", "gender", "tenor_in_months", *quality.OPTIONAL_TEXT_FIELDS)


@on_registry
def dq_report(registry):
    return quality.report(_registry_checked(registry))


@on_registry
def dq_report_rules(registry):
    return quality.errors_by_rule(_registry_checked(registry))


@on_registry
def dq_report_first(registry):
    return quality.first_errors(_registry_checked(registry))


@on_registry
def flt_critical_nulls(registry):
    return cleaning.drop_critical_nulls(registry).select("customer_id", "age", "income", "gender")


@on_registry
def clean_others(registry):
    return cleaning.others_if_blank(registry).select(
        "customer_id", *quality.OPTIONAL_TEXT_FIELDS)


@on_registry
def flt_age(registry):
    return cleaning.within_age_range(registry).select("customer_id", "age")


@on_registry
def clean_numeric_fill(registry):
    stage = write_stage(cleaning.fill_numeric(registry), "registry")
    return cleaning.fill_medians(stage.df, ["total_loan_amount"]).select(
        "customer_id", "tenor_in_months", "total_missed_installment", "total_amount_overdue",
        "total_loan_amount", "ontime_repayment_rate")


@on_registry
def flt_income_missing(registry):
    return explore.missing_income(registry)


@on_registry
def flt_notebook(registry):
    return known_customers(registry).select("customer_id", "age", "gender", "dw_channel_key",
                                            "income")


@on_run
def dq_validate_processed(run):
    return quality.check_processed(run.featured).selectExpr(
        "customer_id", "size(errors) = 0 AS is_valid", "array_join(errors, '; ') AS error")


@on_registry
def dq_required_columns(registry):
    return quality.require_columns(registry).select("customer_id", *quality.FEATURE_INPUTS)


# -- joins -------------------------------------------------------------------

@on_fact
def join_latest_loan(fact):
    return ct.latest_loan_rows(fact).select(
        "dw_customer_key", "disbursement_date", "loan_ref", "product_code", "dw_date_key")


@on_fact
def join_latest_snapshot(fact):
    return ct.latest_snapshot_dpd(fact)


@on_fact
def join_left_aggs(fact):
    return ct.customer_metrics(fact)


@on_inputs
def join_dim(src):
    return ct.loan_counts(src.loan_fact).join(
        ct.category_customers(src.customer_dim), "dw_customer_key")


@on_inputs
def join_income(src):
    return ct.latest_loan_customers(src.loan_fact).join(
        ct.customer_income(src.income_decision), "dw_customer_key", "left")


@on_exploration
def join_merge_demo(ex):
    return ex.merged.selectExpr(
        "customer_id", "segment",
        *[f"round({c}, 6) AS {c}" for c in features.CLUSTER_FEATURES], *DEMOGRAPHICS)


@on_run
def join_population(run):
    return profiles.item_counts(run.cells).select("segment", "demo", "value", "n", "pop_n")


# -- aggregations ------------------------------------------------------------

@on_fact
def agg_loan_count(fact):
    return ct.loan_counts(fact)


@on_fact
def agg_latest_date(fact):
    return ct.latest_dates(fact)


@on_fact
def agg_dpd14(fact):
    return ct.dpd_flags(fact)


@on_fact
def agg_customer(fact):
    return ct.customer_sums(fact)


@on_fact
def agg_dedup(fact):
    return ct.latest_loan_rows(fact).select("dw_customer_key").distinct()


@on_fact
def agg_coalesce(fact):
    return ct.customer_metrics(fact).select(
        "dw_customer_key", "maturity_dpd", "has_14plus_dpd", "count_14plus_dpd")


@on_exploration
def agg_value_counts(ex):
    return explore.value_counts(ex.adults, [
        "has_14plus_dpd", "gender", "dw_channel_key", "marital_status", "employment_status",
        "age_category"])


@on_run
def agg_segment_dist(run):
    return explore.segment_distribution(run.segmented)


@on_registry
def agg_numeric_summary(registry):
    stage = write_stage(registry, "registry")
    return explore.numeric_summary(stage.df)


@on_registry
def agg_cat_summary(registry):
    return explore.categorical_summary(registry)


@on_registry
def agg_missing(registry):
    return explore.missing_counts(registry)


@on_registry
def agg_null_ratio(registry):
    return explore.null_ratios(registry)


@on_run
def agg_default(run):
    return explore.default_analysis(run.raw)


DESCRIBE_AT = [0.05, 0.15, 0.25, 0.5, 0.75, 0.9, 0.95]


@on_registry
def agg_describe(registry):
    stage = write_stage(registry, "registry")
    return explore.describe(stage.df, DESCRIBE_AT)


@on_exploration
def agg_describe_features(ex):
    return explore.describe(ex.featured.df, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])


@on_exploration
def agg_snapshot(ex):
    return explore.snapshot(ex.adults, [
        "loan_count", "total_loan_amount", "maturity_dpd", "tenor_in_months"])


@on_exploration
def agg_default_by_dim(ex):
    return explore.default_rate_by(ex.adults, [
        "age", "age_category", "gender", "marital_status", "employment_status",
        "dw_channel_key"])


@on_exploration
def agg_overall_mean(ex):
    return explore.rate_against_overall(ex.adults, "employment_status")


@on_exploration
def agg_corr(ex):
    return explore.correlations(ex.adults)


@on_exploration
def agg_revenue_share(ex):
    return explore.revenue_share(ex.segmented)


@on_run
def agg_cube_demographics(run):
    return profiles.crossed_counts(run.cells)


@on_run
def agg_run_summary(run):
    text = "array_join(transform(map_entries(distribution), e -> concat(e.key, '=', e.value)), '; ')"
    return run.summary(FIRST_RUN, FIRST_TIME).withColumn("distribution", F.expr(text))


@on_run
def agg_key_unique(run):
    return explore.key_check(run.segmented)


@on_registry
def agg_column_profile(registry):
    return explore.column_profile(registry)


@on_fact
def agg_distinct_sketch(fact):
    """Loans per snapshot year and over all years: exact, and from the years' sketches."""
    runs = fact.selectExpr("cast(dw_date_key div 10000 AS int) AS year", "loan_ref")
    kept = write_stage(sketches.distinct_sketches(runs, ["year"], "loan_ref"), "sketches").df
    estimates = sketches.merged_counts(kept, ["year"]).unionByName(
        sketches.merged_counts(kept).withColumn("year", F.lit(None).cast("int")))
    exact = runs.rollup("year").agg(F.countDistinct("loan_ref").alias("loans"), F.grouping("year").alias("all"))
    return (exact.join(estimates.withColumnRenamed("year", "y"), F.expr("year <=> y"))
            .selectExpr("year", "loans", f"abs(estimate - loans) <= greatest(1, {sketches.error_bound()} * loans) AS within_bound"))


@on_exploration
def agg_behaviour(ex):
    return subclusters.behaviour(_scaled_split(ex))


# -- features, binning, encoding, scoring ------------------------------------

def _feature_values(df: DataFrame) -> DataFrame:
    return df.selectExpr("customer_id", *[f"round({c}, 6) AS {c}" for c in quality.FEATURE_FIELDS])


@on_run
def feat_payment(run):
    return _feature_values(run.featured)


@on_registry
def feat_median_fill(registry):
    stage = write_stage(features.payment_features(registry), "registry")
    return _feature_values(features.fill_feature_gaps(stage.df))


@on_registry
def bin_income(registry):
    stage = write_stage(registry.select("customer_id", "income"), "registry")
    filled = cleaning.fill_medians(stage.df, ["income"])
    return filled.selectExpr("customer_id", "income",
                             f"{binning.income_bracket()} AS income_bracket")


@on_run
def bin_age_quantile(run):
    return run.binned.select("customer_id", "age", "age_category")


@on_exploration
def bin_age_balanced(ex):
    return ex.adults.select("customer_id", "age", "age_category")


@on_exploration
def bin_income_dist(ex):
    return binning.income_distribution(ex.bracketed)


@on_run
def enc_ordinal(run):
    return run.encoded.select("customer_id", *CODED_DEMOGRAPHICS)


@on_run
def enc_map(run):
    return run.codes


@on_run
def score_risk(run):
    return run.featured.selectExpr("customer_id", f"{scoring.risk_level()} AS risk_level")


def _first_levels(run: CohortRun) -> DataFrame:
    """Levels before the contract drops rows, with the threshold of that moment."""
    stage = write_stage(run.featured, "featured")
    return scoring.with_levels(stage.df)


@on_run
def score_value(run):
    return _first_levels(run).select("customer_id", "value_level")


@on_run
def score_segment(run):
    return _first_levels(run).selectExpr(
        "customer_id", "risk_level", "value_level", f"{scoring.combined_segment()} AS segment")


@on_run
def score_segmenter(run):
    return run.segmented.select("customer_id", "segment")


@on_run
def score_recommendation(run):
    return run.segmented.selectExpr("customer_id", "segment",
                                    f"{scoring.recommendation()} AS recommendation")


@on_exploration
def feat_zscore(ex):
    return features.z_scores(ex.featured.df).selectExpr(
        "customer_id", *[f"round({c}, 6) AS {c}" for c in features.CLUSTER_FEATURES])


@on_exploration
def ml_elbow_k(ex):
    return clustering.elbow(features.z_scores(ex.featured.df)).selectExpr("k", "round(inertia, 6) AS inertia", "optimal_k")


@on_exploration
def feat_revenue(ex):
    return features.with_revenue(ex.segmented).selectExpr(
        "customer_id", "segment", "round(revenue, 4) AS revenue")


# -- windows -----------------------------------------------------------------

def _scaled_split(ex: Exploration) -> DataFrame:
    stage = ex.segmented_stage
    return subclusters.equal_split(features.z_scores(stage.df))


@on_exploration
def win_equal_split(ex):
    return _scaled_split(ex).select("customer_id", "segment", "sub_cluster")


def _winners(run: CohortRun) -> DataFrame:
    items = profiles.qualifying_items(profiles.item_counts(run.cells))
    return profiles.winning_combinations(profiles.combination_counts(run.cells, items))


@on_run
def win_topk_segment(run):
    return profiles.top_combinations(_winners(run)).select(
        "segment", "position", "size", "n", "pop_n", "place")


@on_run
def win_combo_id(run):
    return _winners(run).selectExpr(
        "segment", "concat('C', position) AS combination_id",
        f"{sql.combination_text('combo')} AS combination", "n", "pop_n")


@on_fact
def win_latest_flag(fact):
    return ct.latest_loan_flag(fact)


# -- sort, limit, set operations ---------------------------------------------

@on_run
def sort_customer(run):
    return run.raw.select("customer_id", "loan_count", "total_loan_amount").orderBy("customer_id")


@on_exploration
def topk_states(ex):
    return explore.top_states(ex.adults)


@on_exploration
def sort_state_counts(ex):
    return explore.state_counts(ex.adults)


@on_run
def limit_sample(run):
    return explore.sample_rows(run.raw.select("customer_id", "age", "gender", "state", "income"))


@on_run
def sort_profiles(run):
    return _winners(run).selectExpr(
        "segment", "position", "round(observed_proportion, 6) AS observed_proportion",
        "round(odds_ratio, 6) AS odds_ratio",
    ).orderBy(F.desc("observed_proportion"), F.desc("odds_ratio"), "segment", "position")


@on_run
def set_union_profiles(run):
    parts = [run.profiles_stage.df.where(f"segment = {sql.quote(s)}") for s in SEGMENTS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("segment", "combination_id", "combination", "count")


@on_run
def set_distinct(run):
    return run.segmented.select("segment").distinct()


@on_run
def set_upsert_state(run):
    current = sinks.segment_rows(
        run.valid.selectExpr("customer_id", "'Not assigned' AS segment"), FIRST_TIME)
    return sinks.upserted(current, sinks.segment_rows(run.segmented, SECOND_TIME))


# -- profile mining ----------------------------------------------------------

def _rounded_lift(df: DataFrame) -> DataFrame:
    return df.selectExpr("segment", "demo", "value", "n", "pop_n", "round(lift, 6) AS lift",
                         "round(observed, 6) AS observed", "round(expected, 6) AS expected")


@on_run
def prof_lift(run):
    return _rounded_lift(profiles.item_counts(run.cells).selectExpr(
        "*", *profiles.lift_columns()))


@on_run
def prof_qualifying(run):
    return _rounded_lift(profiles.qualifying_items(profiles.item_counts(run.cells)))


@on_run
def prof_combinations(run):
    return _winners(run).selectExpr(
        "segment", "size", f"{sql.combination_text('combo')} AS combination", "n",
        "round(observed_proportion, 6) AS coverage")


@on_run
def prof_population(run):
    return _winners(run).selectExpr(
        "segment", f"{sql.combination_text('combo')} AS combination", "pop_n", "pop_size")


@on_run
def prof_segment_profiles(run):
    return run.profiles.selectExpr(
        "segment", "combination_id", "combination",
        *[f"round({c}, 6) AS {c}" for c in (
            "observed_proportion", "expected_proportion", "odds_ratio", "coverage")],
        "count")


@on_exploration
def prof_overrep(ex):
    return subclusters.over_representation(_scaled_split(ex), ex.featured.df, ex.featured.rows)


@on_exploration
def prof_rates(ex):
    return subclusters.segment_rates(ex.segmented_stage.df, ex.featured.df)


@on_exploration
def prof_combinations_nb(ex):
    df = ex.segmented_stage.df
    return profiles.full_size_combinations(
        df, df.where("age_category IS NOT NULL"), subclusters.population_counts(df)).selectExpr(
        "segment", "size", "combination_id", "combination", "observed_proportion",
        "expected_proportion", "odds_ratio", "count",
        f"{sql.percent_text('coverage', 1)} AS coverage")


@on_run
def prof_pivot(run):
    return run.wide_profile()


@on_run
def prof_report(run):
    return run.report().drop("place")


# -- scalar functions --------------------------------------------------------

@on_inputs
def fn_title(src):
    return src.customer_dim.selectExpr(
        "dw_customer_key", f"{sql.title('gender')} AS gender",
        f"{sql.title('purpose_of_loan')} AS purpose")


@on_inputs
def fn_like(src):
    return (src.income_decision.selectExpr(
        "lower(offer_type) LIKE '%salar%' AS salary_offer",
        "lower(offer_type) LIKE '%turnover%' AS turnover_offer")
        .groupBy("salary_offer", "turnover_offer").agg(F.count("*").alias("n")))


@on_registry
def fn_case(registry):
    return registry.selectExpr(
        "customer_id", "CASE WHEN income IS NULL OR total_loan_amount IS NULL "
        "OR total_loan_amount = 0 THEN NULL ELSE round(abs(income / total_loan_amount), 6) END "
        "AS ratio", "coalesce(maturity_dpd, 0) AS maturity_dpd",
        "coalesce(has_14plus_dpd, 0) AS has_14plus_dpd")


@on_inputs
def fn_to_numeric(src):
    return src.customer_dim.selectExpr(
        "dw_customer_key", f"{sql.to_number('state')} AS from_text",
        f"{sql.to_number('substring(state, 8)')} AS from_digits")


@on_registry
def fn_clip(registry):
    return registry.selectExpr(
        "customer_id", f"{sql.clip_or_null('age', '18', '60')} AS age",
        f"{sql.clip_or_null('tenor_in_months', high='4D')} AS tenor_in_months")


@on_registry
def fn_bround(registry):
    return registry.selectExpr("customer_id", "bround(age / 2, 0) AS half_age",
                               "bround(tenor_in_months, 0) AS tenor_in_months")


@on_registry
def fn_replace(registry):
    return registry.selectExpr(
        "customer_id", f"{sql.one_if_zero('maturity_dpd')} AS maturity_dpd",
        f"{sql.finite('total_loan_amount / nullif(ontime_repayment_rate, 0D)')} AS ratio")


@on_run
def fn_combo_format(run):
    return _winners(run).selectExpr("segment", "position",
                                    f"{sql.combination_text('combo')} AS combination")


@on_run
def fn_combo_parse(run):
    return run.profiles_stage.df.selectExpr(
        "segment", "place", f"posexplode({sql.combination_items('combination')}) AS (pos, x)",
    ).selectExpr("segment", "place", "pos", "x.demo AS demo", "x.value AS value")


@on_run
def fn_decode(run):
    known = decode.decode_known(run.profiles_stage.df)
    return decode.decode_with_codes(known, run.codes).select(
        "segment", "place", "decoded", "text")


@on_run
def fn_fields_present(run):
    return decode.fields_present(run.profiles_stage.df)


@on_run
def fn_format(run):
    return explore.segment_distribution(run.segmented).selectExpr(
        "segment", "format_number(n, 0) AS customers",
        f"{sql.percent_text('percent / 100', 1)} AS share")


@on_fact
def fn_run_id(fact):
    return (fact.select(F.expr(sql.run_id("disbursement_date")).alias("run_id"))
            .groupBy("run_id").agg(F.count("*").alias("n")))


@on_registry
def fn_row_mean(registry):
    mean = sql.row_mean(["loan_count", "age", "maturity_dpd", "tenor_in_months"])
    return registry.selectExpr("customer_id", f"round({mean}, 6) AS row_mean")
