"""Equal split of large cohorts and over-representation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlens.config import DEMOGRAPHICS
from cohortlens.functions.columns import case, number, quote, row_mean
from cohortlens.functions.ranks import distributed_row_number, select_places
from cohortlens.functions.staging import unpivot_text, write_stage
from cohortlens.operators.features import CLUSTER_FEATURES

# Smallest cohort that is split, smoothing of the expected share.
MIN_SPLIT_ROWS = 100
EXPECTED_SMOOTHING = 0.001


def with_score(df: DataFrame, columns=CLUSTER_FEATURES) -> DataFrame:
    """Mean of the features, rounded so that equal customers tie exactly."""
    return df.withColumn("cluster_score", F.expr(f"round({row_mean(list(columns))}, 9)"))


def equal_split(df: DataFrame, columns=CLUSTER_FEATURES) -> DataFrame:
    """sub_cluster 1 for the first n // 2 rows by (mean feature, id), 2 for the rest.

    Rows without a mean come last, rows without an id first among equal means. The row at
    place n // 2 is found by counting over three narrow columns, after which a filter splits
    the cohort: no row is sorted or moved. Rows equal to it in both are numbered, so the
    halves are exact whatever repeats. Cohorts under MIN_SPLIT_ROWS are not split and get NULL.
    """
    scored = with_score(df, columns).withColumn("_at", F.expr(
        "struct(cluster_score IS NULL OR isnan(cluster_score) AS late, coalesce(nanvl(cluster_score, 0D), 0D) AS score, "
        f"coalesce(cast(customer_id AS bigint), {-2 ** 63 + 1}L) AS key)"))
    order = write_stage(scored.select("segment", "_at.*"), "split-order").df
    # One row per cohort.
    sizes = order.groupBy("segment").agg(F.count("*").alias("n"), F.expr("count_if(late)").alias("gaps")).collect()
    rows, place = {}, {}
    for segment, n, gaps in sizes:
        if n >= MIN_SPLIT_ROWS:
            # The middle lies among the rows with a mean, or among those without.
            late = n // 2 > n - gaps
            rows[segment] = f"segment <=> {_literal(segment)} AND {'' if late else 'NOT '}late"
            place[segment] = (late, n // 2 - (n - gaps if late else 0))
    cuts = select_places(order, rows, "score", "key", lambda segment, _: [place[segment][1]])
    ends, taken = [], {}
    for segment, (late, at) in place.items():
        cut = cuts[segment][0]
        if at - cut.before < cut.equal:
            taken[segment] = at - cut.before      # of the rows equal to the cut
        ends.append((f"segment <=> {_literal(segment)}", f"struct(struct({str(late).lower()} AS late, {number(cut.score)} AS score, {cut.key}L AS key) "
                     f"AS at, {1 - (segment in taken)} AS level)"))
    if not ends:
        return scored.drop("_at").withColumn("sub_cluster", F.lit(None).cast("int"))
    split = (scored.withColumn("_cut", F.expr(case(ends)))
             .withColumn("sub_cluster", F.expr("CASE WHEN _cut IS NULL THEN NULL WHEN _at < _cut.at THEN 1 WHEN _at = _cut.at THEN _cut.level ELSE 2 END"))
             .drop("_at", "_cut"))
    if not taken:
        return split
    tied = distributed_row_number(split.where("sub_cluster = 0"), "segment", ["cluster_score", "customer_id"], "_place")
    half = case([(f"segment <=> {_literal(s)} AND _place <= {n}", "1") for s, n in taken.items()], "2")
    return split.where("sub_cluster IS NULL OR sub_cluster > 0").unionByName(
        tied.withColumn("sub_cluster", F.expr(half)).drop("_place"))


def _literal(text: str | None) -> str:
    return "NULL" if text is None else quote(text)


def behaviour(split: DataFrame, columns=CLUSTER_FEATURES) -> DataFrame:
    """Mean features of every (cohort, sub-cluster)."""
    return split.groupBy("segment", "sub_cluster").agg(
        *[F.expr(f"round(avg(cast({c} AS double)), 2) AS {c}") for c in columns])


def population_counts(df: DataFrame, demographics=DEMOGRAPHICS) -> DataFrame:
    """(demo, value, pop_n) of the whole population; missing values are not counted."""
    return (unpivot_text(df, [], demographics).where("value IS NOT NULL")
            .groupBy("demo", "value").agg(F.count("*").alias("pop_n")))


def group_counts(split: DataFrame, demographics=DEMOGRAPHICS) -> DataFrame:
    """(segment, sub_cluster, demo, value, n); missing values are not counted."""
    return (unpivot_text(split, ["segment", "sub_cluster"], demographics)
            .where("value IS NOT NULL")
            .groupBy("segment", "sub_cluster", "demo", "value").agg(F.count("*").alias("n")))


def over_representation(split: DataFrame, population: DataFrame, population_rows: int,
                        demographics=DEMOGRAPHICS) -> DataFrame:
    """Observed and expected share and their ratio per group, demographic and value."""
    counts = group_counts(split, demographics)
    # At most two rows per cohort. Cohorts that are not split have a NULL
    # sub_cluster, hence the null-safe condition.
    sizes = (split.groupBy("segment", "sub_cluster").agg(F.count("*").alias("group_n"))
             .selectExpr("segment AS s", "sub_cluster AS c", "group_n"))
    joined = (counts.join(F.broadcast(sizes), F.expr("segment <=> s AND sub_cluster <=> c"))
              .join(population_counts(population, demographics), ["demo", "value"], "left"))
    observed = "n / group_n"
    expected = f"coalesce(pop_n, 0) / {population_rows}D"
    return joined.selectExpr(
        "segment", "sub_cluster", "demo", "value",
        f"bround({observed}, 4) AS observed_proportion",
        f"bround({expected}, 4) AS expected_proportion",
        f"bround({observed} / ({expected} + {number(EXPECTED_SMOOTHING)}), 2) "
        "AS over_representation",
        "n AS category_count")


def segment_rates(df: DataFrame, population: DataFrame, demographics=DEMOGRAPHICS) -> DataFrame:
    """Cohort count over population count per value; unknown values divide by 0.001."""
    mine = (unpivot_text(df, ["segment"], demographics).where("value IS NOT NULL")
            .groupBy("segment", "demo", "value").agg(F.count("*").alias("n")))
    joined = mine.join(population_counts(population, demographics), ["demo", "value"], "left")
    return joined.selectExpr(
        "segment", "demo", "value", "n", "coalesce(pop_n, 0) AS pop_n",
        "round(n / coalesce(cast(pop_n AS double), 0.001D), 6) AS rate")
