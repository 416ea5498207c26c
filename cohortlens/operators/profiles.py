"""Over-represented demographic combinations per cohort.

Customers are first reduced to demographic cells (one row per distinct
combination with a count per cohort). Everything after that costs by the
number of cells, not customers.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from cohortlens.config import (
    CohortConfig, DEFAULT, DEMOGRAPHICS, SEGMENTS, WIDE_PROFILE_COLUMNS)
from cohortlens.functions.columns import case, combination_text, number, quote
from cohortlens.functions.ranks import distributed_row_number
from cohortlens.functions.staging import small_side, unpivot_text, write_stage


def _share(n: str, total: str) -> str:
    return f"coalesce(try_divide(cast({n} AS double), cast({total} AS double)), 0D)"


def lift_columns(n: str = "n", total: str = "segment_size", pop_n: str = "pop_n",
                 pop_total: str = "pop_size", epsilon: float = DEFAULT.lift_epsilon,
                 names: tuple[str, str, str] = ("lift", "observed", "expected")) -> list[str]:
    """SELECT items: smoothed lift, observed and expected share (0 for an empty total)."""
    observed, expected = _share(n, total), _share(pop_n, pop_total)
    return [f"{observed} / ({expected} + {number(epsilon)}) AS {names[0]}",
            f"{observed} AS {names[1]}", f"{expected} AS {names[2]}"]


PUBLISHED = ("odds_ratio", "observed_proportion", "expected_proportion")


def segment_position(segment: str = "segment") -> str:
    return case([(f"{segment} = {quote(s)}", str(i)) for i, s in enumerate(SEGMENTS)])


def _segment_array() -> str:
    return f"array({', '.join(map(quote, SEGMENTS))})"


def demographic_cells(df: DataFrame, demographics=DEMOGRAPHICS) -> DataFrame:
    """Customers per cohort and distinct demographic combination (map-side combined)."""
    return (df.selectExpr("segment", *[f"cast({c} AS string) AS {c}" for c in demographics])
            .groupBy("segment", *demographics).agg(F.count("*").alias("n")))


def crossed_counts(cells: DataFrame, demographics=DEMOGRAPHICS) -> DataFrame:
    """Counts for every subset of the demographics: a cube over the cells."""
    return (cells.cube(*demographics)
            .agg(F.grouping_id().alias("grouping"), F.sum("n").alias("n")))


def cohort_sizes(cells: DataFrame) -> DataFrame:
    """At most one row per cohort: its size and the population size."""
    sizes = cells.groupBy("segment").agg(F.sum("n").alias("segment_size"))
    return sizes.withColumn("pop_size", F.sum("segment_size").over(Window.partitionBy()))


def item_counts(cells: DataFrame, demographics=DEMOGRAPHICS) -> DataFrame:
    """(segment, demo, value): count, cohort size, population count and size."""
    long = unpivot_text(cells, ["segment", "n"], demographics)
    per_segment = ", ".join(
        f"named_struct('segment', {quote(s)}, 'n', sum(n) FILTER (WHERE segment = {quote(s)}))"
        for s in SEGMENTS)
    counts = (long.groupBy("demo", "value")
              .agg(F.sum("n").alias("pop_n"), F.expr(f"array({per_segment})").alias("split"))
              .selectExpr("demo", "value", "pop_n", "inline(split)")
              .where("n IS NOT NULL"))
    return (counts.join(F.broadcast(cohort_sizes(cells)), "segment")
            .select("segment", "demo", "value", "n", "segment_size", "pop_n", "pop_size"))


def qualifying_items(items: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Values whose lift reaches the threshold."""
    return items.selectExpr(
        "segment", "demo", "value", "n", "segment_size", "pop_n", "pop_size",
        *lift_columns(epsilon=config.lift_epsilon),
    ).where(f"lift >= {number(config.lift_threshold)}")


def ranked_items(items: DataFrame, demographics=DEMOGRAPHICS) -> DataFrame:
    """Adds the demographic's position and the value's rank: count descending, then value."""
    position = case([(f"demo = {quote(c)}", str(i)) for i, c in enumerate(demographics)])
    rank = F.row_number().over(
        Window.partitionBy("segment", "demo").orderBy(F.desc("n"), F.asc("value")))
    return items.withColumn("rank", rank).withColumn("d", F.expr(position))


def _covered(config: CohortConfig) -> str:
    return f"n / segment_size >= {number(config.coverage_threshold)}"


def _rank_maps(qualifying: DataFrame, config: CohortConfig, demographics) -> DataFrame:
    """One row per cohort: map 'position:value' -> rank of the minable values.

    A value rarer than the coverage threshold cannot be part of a combination
    that reaches it, so at most 1 / coverage values per demographic remain and
    leaving the others out does not change the order of the rest.
    """
    frequent = qualifying.where(f"value IS NOT NULL AND {_covered(config)}")
    return (ranked_items(frequent, demographics).groupBy(F.col("segment").alias("target"))
            .agg(F.expr("map_from_entries(collect_list(struct(concat(d, ':', value), rank)))")
                 .alias("ranks"),
                 F.max("segment_size").alias("segment_size"),
                 F.max("pop_size").alias("pop_size")))


def combination_counts(cells: DataFrame, qualifying: DataFrame,
                       config: CohortConfig = DEFAULT,
                       demographics=DEMOGRAPHICS) -> DataFrame:
    """Cohort and population counts of every combination of two or more qualifying values.

    Every cell is looked at once per cohort, keeps the values that qualify
    there and emits their subsets; one shuffle sums them up. The broadcast side
    has one row per cohort and at most (demographics / coverage) map entries.
    """
    if config.coverage_threshold <= 0:
        raise ValueError("use full_size_combinations for a zero coverage threshold")
    ranks = _rank_maps(qualifying, config, demographics)
    items = ", ".join(
        f"named_struct('d', {i}, 'rank', try_element_at(ranks, concat('{i}:', {c})), "
        f"'demo', {quote(c)}, 'value', {c})" for i, c in enumerate(demographics))
    seen = (cells.withColumn("target", F.expr(f"explode({_segment_array()})"))
            .join(F.broadcast(ranks), "target")
            .selectExpr("target", "segment_size", "pop_size", "n", "segment = target AS own",
                        f"filter(array({items}), x -> x.rank IS NOT NULL) AS items")
            .where("size(items) >= 2"))
    subsets = (seen.withColumn("mask", F.expr("explode(sequence(1, shiftleft(1, size(items)) - 1))"))
               .where("bit_count(mask) >= 2")
               .withColumn("combo", F.expr("filter(items, (x, i) -> getbit(mask, i) = 1)")))
    return (subsets.groupBy(F.col("target").alias("segment"), "combo")
            .agg(F.expr("coalesce(sum(n) FILTER (WHERE own), 0) AS n"),
                 F.sum("n").alias("pop_n"),
                 F.max("segment_size").alias("segment_size"),
                 F.max("pop_size").alias("pop_size")))


def winning_combinations(counts: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Covered combinations of the largest size that has any, numbered per cohort.

    For a fixed set of demographics every customer matches one combination, so
    at most 1 / coverage combinations per set pass: the windows stay small.
    """
    mine = Window.partitionBy("segment")
    largest = (counts.where(f"n > 0 AND {_covered(config)}")
               .withColumn("size", F.size("combo"))
               .withColumn("largest", F.max("size").over(mine)).where("size = largest"))
    return (largest.withColumn("order_key", F.expr(
                "struct(transform(combo, i -> i.d), transform(combo, i -> i.rank))"))
            .withColumn("position", F.row_number().over(mine.orderBy("order_key")))
            .selectExpr("segment", "position", "size", "combo", "n", "segment_size", "pop_n",
                        "pop_size", *lift_columns(epsilon=config.lift_epsilon, names=PUBLISHED)))


def top_combinations(winners: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    best = Window.partitionBy("segment").orderBy(
        F.desc("observed_proportion"), F.desc("odds_ratio"), F.asc("position"))
    return (winners.withColumn("place", F.row_number().over(best))
            .where(f"place <= {config.max_combinations}"))


def profile_table(top: DataFrame) -> DataFrame:
    """The eight published columns plus the place within the cohort."""
    return top.selectExpr(
        "segment", "concat('C', position) AS combination_id",
        f"{combination_text('combo')} AS combination",
        "observed_proportion", "expected_proportion", "odds_ratio", "n AS count",
        "observed_proportion AS coverage", "place")


def segment_profiles(cells: DataFrame, config: CohortConfig = DEFAULT,
                     demographics=DEMOGRAPHICS) -> DataFrame:
    qualifying = qualifying_items(item_counts(cells, demographics), config)
    counts = combination_counts(cells, qualifying, config, demographics)
    return profile_table(top_combinations(winning_combinations(counts, config), config))


def wide_profile(decoded: DataFrame) -> DataFrame:
    """One row, one text column per cohort; cohorts without a profile give ''.

    Needs columns segment, place and text; at most a few rows per cohort.
    """
    return decoded.agg(*[
        F.expr("array_join(transform(array_sort(collect_list(struct(place, text)) FILTER "
               f"(WHERE segment = {quote(name)} AND text != '')), p -> p.text), ', ') AS {column}")
        for name, column in zip(SEGMENTS, WIDE_PROFILE_COLUMNS)])


@dataclass(frozen=True)
class _Shape:
    """The product of a cohort's qualifying values: one digit per demographic that has any."""
    segment: str
    digits: tuple[tuple[int, int], ...]    # (demographic's position, number of values)
    segment_size: int
    offset: int                            # products of the cohorts before

    @property
    def steps(self) -> list[int]:
        """Weight of every digit, exact at any size."""
        return [math.prod(w for _, w in self.digits[i + 1:]) for i in range(len(self.digits))]

    @property
    def products(self) -> int:
        return math.prod(w for _, w in self.digits)

    def first(self, k: int) -> list[list[int]]:
        """The ranks of the first k products."""
        widths = [range(1, w + 1) for _, w in self.digits]
        return [list(ranks) for ranks in itertools.islice(itertools.product(*widths), k)]


def _shapes(items: DataFrame) -> list[_Shape]:
    """Shapes in cohort order; a row per cohort and demographic comes to the driver."""
    rows = items.groupBy("segment", "d").agg(F.max("rank").alias("width"), F.max("segment_size").alias("size")).collect()
    shapes, offset = [], 0
    for segment in SEGMENTS:
        mine = sorted((r["d"], r["width"], r["size"]) for r in rows if r["segment"] == segment)
        if len(mine) >= 2:
            shapes.append(_Shape(segment, tuple((d, w) for d, w, _ in mine), mine[0][2], offset))
            offset += shapes[-1].products
    if offset >= 10 ** 38:
        raise OverflowError(f"{offset} combinations: their running ids do not fit a decimal of 38 digits")
    return shapes


def full_size_combinations(df: DataFrame, population: DataFrame, population_items: DataFrame,
                           config: CohortConfig = DEFAULT,
                           demographics=DEMOGRAPHICS) -> DataFrame:
    """Search variant without a coverage threshold.

    Then the largest size always wins: all demographics that have a qualifying
    value take part and every product of their values counts, matched or not.
    The products are never generated. A product is the list of its values' ranks, whose
    order is the order of the running ids. Matched products come from the cells; of the
    others only the first of a cohort can be among its best, so twice as many as are
    published are listed beside them. Running ids are exact decimals; a search with
    10^38 products or more fails.

    `df` holds the cohorts, `population` the rows expected shares refer to,
    `population_items` the (demo, value, pop_n) counts of the population. Cells and
    qualifying values are staged; a value is a row, never an entry of one.
    """
    spark = df.sparkSession
    own = demographic_cells(df, demographics).withColumn("whole", F.lit(False))
    whole = demographic_cells(population.withColumn("segment", F.lit(None).cast("string")), demographics).withColumn("whole", F.lit(True))
    cells = write_stage(own.unionByName(whole).withColumn("cell", F.monotonically_increasing_id()), "cells").df

    total = cells.where("whole").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    counts = item_counts(cells.where("NOT whole"), demographics).drop("pop_n", "pop_size")
    sized = counts.join(population_items, ["demo", "value"], "left").selectExpr(
        "segment", "demo", "value", "n", "segment_size", "coalesce(pop_n, 0) AS pop_n",
        f"cast({total} AS bigint) AS pop_size")
    position = case([(f"demo = {quote(c)}", str(i)) for i, c in enumerate(demographics)])
    ranked = distributed_row_number(qualifying_items(sized, config).selectExpr(
        "segment", f"{position} AS d", "demo", "value", "segment_size", f"concat(segment, '/', {position}) AS g", "-n AS k"),
        "g", ["k", "value"], "rank").withColumn("rank", F.col("rank").cast("int"))
    items = write_stage(ranked.drop("g", "k"), "items").df
    shapes = _shapes(items)
    if not shapes:
        return spark.createDataFrame([], "segment string, size int, combination_id string, combination string, observed_proportion double, "
                                         "expected_proportion double, odds_ratio double, count bigint, coverage double, place int")

    def local(rows: Iterable[str], names: str) -> DataFrame:
        return F.broadcast(spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})"))    # a few rows per cohort

    # Every cell's ranks in every cohort in which all demographics that take part have one.
    values = ", ".join(f"named_struct('d', {i}, 'value', {c})" for i, c in enumerate(demographics))
    long = cells.selectExpr("cell", "segment", "whole", "n", f"inline(array({values}))").where("value IS NOT NULL")
    sizes = local([f"({quote(s.segment)}, {len(s.digits)})" for s in shapes], "target, size")
    hits = (long.join(small_side(items.where("value IS NOT NULL").selectExpr("segment AS target", "d", "value", "rank")), ["d", "value"])
            .where("whole OR segment = target")
            .groupBy("cell", "whole", "n", "target").agg(F.array_sort(F.collect_list(F.struct("d", "rank"))).alias("at"))
            .join(sizes, "target").where("size(at) = size")
            .selectExpr("target AS segment", "transform(at, x -> x.rank) AS ranks", "if(whole, 0L, n) AS n", "if(whole, n, 0L) AS pop_n"))
    first = local([f"({quote(s.segment)}, array({', '.join(map(str, ranks))}), 0L, 0L)" for s in shapes
                   for ranks in s.first(2 * config.max_combinations)], "segment, ranks, n, pop_n")
    totals = local([f"({quote(s.segment)}, {s.segment_size}L, {total}L)" for s in shapes], "segment, segment_size, pop_size")
    scored = (hits.unionByName(first).groupBy("segment", "ranks").agg(F.sum("n").alias("n"), F.sum("pop_n").alias("pop_n"))
              .join(totals, "segment").selectExpr("segment", "ranks", "n", *lift_columns(epsilon=config.lift_epsilon))
              .selectExpr("segment", "ranks", "n AS count", "observed AS coverage", "bround(observed, 4) AS observed_proportion",
                          "bround(expected, 4) AS expected_proportion", "bround(lift, 3) AS odds_ratio"))
    best = Window.partitionBy("segment").orderBy(
        F.desc("observed_proportion"), F.desc("odds_ratio"), F.asc("ranks"))
    top = scored.withColumn("place", F.row_number().over(best)).where(f"place <= {config.max_combinations}")

    # Ids and texts of the published few.
    digits = local([f"({quote(s.segment)}, {i}, {d}, cast('{step}' AS decimal(38,0)), cast('{s.offset}' AS decimal(38,0)))"
                    for s in shapes for i, ((d, _), step) in enumerate(zip(s.digits, s.steps))], "segment, i, d, step, offset")
    kept = [c for c in top.columns if c != "ranks"]
    parts = (top.selectExpr(*kept, "posexplode(ranks) AS (i, rank)").join(digits, ["segment", "i"])
             .join(items.select("segment", "d", "rank", "demo", "value"), ["segment", "d", "rank"]))
    named = F.struct("i", "demo", F.coalesce("value", F.lit("nan")).alias("value"))
    return (parts.groupBy(*kept).agg(F.expr("cast(sum(step * (rank - 1)) + max(offset) + 1 AS decimal(38,0)) AS id"),
                                     F.array_sort(F.collect_list(named)).alias("combo"), F.count(F.lit(1)).cast("int").alias("size"))
            .selectExpr("segment", "size", "concat('C', id) AS combination_id", f"{combination_text('combo')} AS combination",
                        "observed_proportion", "expected_proportion", "odds_ratio", "count", "coverage", "place"))
