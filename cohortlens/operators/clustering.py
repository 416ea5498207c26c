"""Number of clusters by the elbow of the k-means inertia, the same on every run.

Centres start at fixed places of the row mean: centre i of k at place (2i - 1) n / 2k in the
order (row mean, customer_id). Then a fixed number of steps assigns every row to its
nearest centre (the first of equals) and moves a centre to the mean of its rows; an
empty one stays. Coordinates have nine digits and are summed as decimals, so no order of
rows or tasks changes a mean. The centres of all k, some tens of numbers, travel as
literals: a step is one aggregate over the same table, whatever came before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cohortlens.functions.columns import number, row_mean, with_exprs
from cohortlens.functions.ranks import select_places
from cohortlens.functions.staging import write_stage
from cohortlens.operators.features import CLUSTER_FEATURES

STEPS = 10
DIGITS = 9

Centre = tuple[float, ...]


def _points(scaled: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows that have all coordinates, to DIGITS digits, with their mean."""
    whole = scaled.na.drop(subset=list(columns))
    cut = with_exprs(whole, {c: f"round(cast({c} AS double), {DIGITS})" for c in columns})
    return cut.selectExpr("cast(customer_id AS bigint) AS customer_id", *columns,
                          f"round({row_mean(list(columns))}, {DIGITS}) AS score")


def first_centres(points: DataFrame, n: int, max_k: int, columns: tuple[str, ...]) -> dict[int, list[Centre]]:
    places = {k: [(2 * i - 1) * n // (2 * k) + 1 for i in range(1, k + 1)] for k in range(1, max_k + 1)}
    wanted = sorted({p for at in places.values() for p in at})
    cuts = select_places(points, {"all": "true"}, "score", "customer_id", lambda *_: wanted)["all"]
    # Equal places share a row; rows equal in both are told apart by their coordinates.
    keys = F.expr(" OR ".join(f"(score = {number(c.score)} AND customer_id = {c.key}L)" for c in cuts))
    least = {(r["score"], r["customer_id"]): tuple(r["x"]) for r in points.where(keys).groupBy("score", "customer_id")
             .agg(F.min(F.struct(*columns)).alias("x")).collect()}
    at = {p: least[c.score, c.key] for p, c in zip(wanted, cuts)}
    return {k: [at[p] for p in ps] for k, ps in places.items()}


def _owned(points: DataFrame, centres: dict[int, list[Centre]], columns: tuple[str, ...]) -> DataFrame:
    """Adds d<k>, the squared distances to the centres of k, and own<k>, the nearest one (from 1)."""
    def distance(centre: Centre) -> str:
        return " + ".join(f"({c} - {number(x)}) * ({c} - {number(x)})" for c, x in zip(columns, centre))

    far = with_exprs(points, {f"d{k}": f"array({', '.join(map(distance, cs))})" for k, cs in centres.items()})
    return with_exprs(far, {f"own{k}": f"array_position(d{k}, array_min(d{k}))" for k in centres})


def _moved(points: DataFrame, centres: dict[int, list[Centre]], columns: tuple[str, ...]) -> dict[int, list[Centre]]:
    """Every centre at the mean of its rows."""
    sums = [F.expr(f"cast(sum(CASE WHEN own{k} = {j} THEN cast({c} AS decimal(20,{DIGITS})) END) AS double) "
                   f"/ nullif(count_if(own{k} = {j}), 0)") for k, cs in centres.items() for j in range(1, len(cs) + 1) for c in columns]
    found = iter(_owned(points, centres, columns).agg(*[x.alias(f"x{i}") for i, x in enumerate(sums)]).first())
    new = {k: [tuple(next(found) for _ in columns) for _ in cs] for k, cs in centres.items()}
    return {k: [old if None in c else c for old, c in zip(centres[k], cs)] for k, cs in new.items()}


def best_k(inertias: DataFrame) -> DataFrame:
    """Adds optimal_k to (k, inertia), k = 1, 2, ... without a gap.

    The gain of k is what its last cluster takes off the inertia. Best is the k
    whose gain is largest against the gain of k + 1, the smallest of equals. Where the next
    gain is nothing, the ratio is undefined if the gain is nothing as well, which
    decides for this k, and else counts as minus infinity (plus for a loss). At least 2, and 2 if no
    k has a next one.
    """
    by_k = Window.orderBy("k")    # a handful of rows
    gains = inertias.withColumn("gain", F.lag("inertia").over(by_k) - F.col("inertia"))
    ratios = gains.withColumn("next_gain", F.lead("gain").over(by_k)).where("gain IS NOT NULL AND next_gain IS NOT NULL").selectExpr(
        "k", "next_gain = 0 AND gain = 0 AS undefined",
        "CASE WHEN next_gain != 0 THEN gain / next_gain WHEN gain > 0 THEN double('-Infinity') ELSE double('Infinity') END AS ratio")
    best = ratios.agg(F.expr("max_by(k, struct(undefined, if(undefined, 0D, ratio), -k))"))
    return inertias.withColumn("optimal_k", F.coalesce(best.scalar(), F.lit(2)))


def elbow(scaled: DataFrame, columns=CLUSTER_FEATURES, max_k: int = 4, steps: int = STEPS) -> DataFrame:
    """(k, inertia, optimal_k) for k = 1..max_k; no rows if there are none to cluster."""
    columns = tuple(columns)
    stage = write_stage(_points(scaled, columns), "points")
    rows: list[tuple[int, float]] = []
    if stage.rows:
        centres = first_centres(stage.df, stage.rows, max_k, columns)
        for _ in range(steps):
            centres = _moved(stage.df, centres, columns)
        inertia = [F.expr(f"cast(sum(cast(array_min(d{k}) AS decimal(38,12))) AS double)").alias(f"k{k}") for k in centres]
        rows = list(zip(centres, _owned(stage.df, centres, columns).agg(*inertia).first()))
    return best_k(scaled.sparkSession.createDataFrame(rows, "k int, inertia double").coalesce(1))
