"""Income brackets and age categories."""

from __future__ import annotations

from functools import reduce
from heapq import heapify, heappop, heappush
from itertools import pairwise

from pyspark.sql import DataFrame, Window, functions as F

from cohortlens.config import CohortConfig, DEFAULT
from cohortlens.functions.columns import case, number, quote, with_exprs

# Bins used when there are fewer rows than age groups.
FALLBACK_AGE_EDGES = (30, 40, 50)
FALLBACK_AGE_LABELS = ("18-30", "31-40", "41-50", "51+")


def income_bracket(config: CohortConfig = DEFAULT, outside_first: bool = True) -> str:
    """Half-open bins [low, high). Values outside, and infinity, fall back to the first label."""
    lows = config.income_edges
    highs = lows[1:] + (float("inf"),)
    arms = [(f"income >= {number(low)} AND income < {number(high)}", quote(label))
            for low, high, label in zip(lows, highs, config.income_labels)]
    return case(arms, quote(config.income_labels[0]) if outside_first else None)


def income_distribution(df: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Count and share per bracket, with the bracket's position for ordering."""
    position = case([(f"income_bracket = {quote(x)}", str(i))
                     for i, x in enumerate(config.income_labels)])
    counts = df.groupBy("income_bracket").agg(F.count("*").alias("n"))
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy())).selectExpr(
        "income_bracket", f"{position} AS position", "n", "round(n / total, 6) AS share")


def interval_label(value: str, edges: list[int], labels: list[str]) -> str:
    """Label of (low, high] bins, the first one closed on both ends."""
    return case([
        (f"{value} {'>=' if i == 0 else '>'} {edges[i]} AND {value} <= {edges[i + 1]}",
         quote(label)) for i, label in enumerate(labels)])


def age_quantiles(df: DataFrame, probs: list[float]) -> tuple[int, list[float]]:
    """Row count and exact age quantiles. Ages are few, so `percentile` stays small."""
    row = df.agg(F.count("*").alias("n"),
                 F.percentile("age", F.array(*[F.lit(p) for p in probs])).alias("q")).first()
    return row["n"], list(row["q"]) if row["q"] is not None else []


def _bounded_age(config: CohortConfig) -> str:
    return f"least(greatest(age, {config.min_age}), {config.max_age})"


def quantile_age_edges(df: DataFrame, config: CohortConfig = DEFAULT) -> list[int] | None:
    """Whole-year edges at the group quantiles; None if there are too few rows."""
    groups = config.age_groups
    clipped = df.selectExpr(f"{_bounded_age(config)} AS age")
    n, inner = age_quantiles(clipped, [i / groups for i in range(1, groups)])
    if n < groups:
        return None
    return sorted({config.min_age, *(int(q) for q in inner), config.max_age})


def age_category(edges: list[int] | None, config: CohortConfig = DEFAULT) -> str:
    """Label 'low-high' of the quantile bin, or of the fixed bins for tiny inputs."""
    if edges is None:
        edges = [config.min_age, *FALLBACK_AGE_EDGES, config.max_age]
        labels = list(FALLBACK_AGE_LABELS)
        # These bins are open below, so the minimum age takes the fill value,
        # which is the label of the first bin.
    else:
        labels = [f"{a}-{b}" for a, b in zip(edges, edges[1:])]
    label = interval_label(_bounded_age(config), edges, labels)
    return f"coalesce({label}, {quote(FALLBACK_AGE_LABELS[0])})"


def with_bins(df: DataFrame, config: CohortConfig = DEFAULT) -> DataFrame:
    """Adds both binned columns; income must already be filled."""
    edges = quantile_age_edges(df, config)
    return with_exprs(df, {
        "income_bracket": income_bracket(config),
        "age": _bounded_age(config),
        "age_category": age_category(edges, config),
    })


def balanced_age_edges(df: DataFrame, groups: int = 4,
                       config: CohortConfig = DEFAULT) -> list[int]:
    """Edges of the alternative binning.

    Fifths of the ages are walked upwards; a bin under half of an equal share joins the
    next one. While there are too few bins, the widest (of several, the oldest) is
    halved. Only the age histogram, one row per year of age, reaches the driver.
    """
    low, high = config.min_age, config.max_age
    n, fifths = age_quantiles(df, [0.2, 0.4, 0.6, 0.8])
    histogram = df.where("age IS NOT NULL").groupBy("age").count().collect()

    def bin_size(start: int, end: int) -> int:
        return sum(r["count"] for r in histogram if start <= r["age"] < end)

    def walk(edges: list[int], edge: int) -> list[int]:
        return [*edges, edge] if bin_size(edges[-1], edge) >= n // groups / 2 else edges

    edges = sorted({*reduce(walk, map(int, fifths), [low]), high})
    bins = [(start - end, -start, end) for start, end in pairwise(edges)]
    heapify(bins)
    while len(bins) < groups and bins[0][0] <= -2:
        _, start, end = heappop(bins)
        middle = -start + (end + start) // 2
        heappush(bins, (-start - middle, start, middle))
        heappush(bins, (middle - end, -middle, end))
    inner = sorted(-start for _, start, _ in bins)
    return [low, *(e for e in inner if low < e < high), high]


def balanced_age_labels(edges: list[int]) -> list[str]:
    """Labels that do not overlap: every bin but the first starts one year later."""
    return [f"{a if i == 0 else a + 1}-{b}" for i, (a, b) in enumerate(zip(edges, edges[1:]))]


def balanced_age_category(edges: list[int]) -> str:
    return interval_label("age", edges, balanced_age_labels(edges))
