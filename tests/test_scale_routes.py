"""The routes for large data give the same numbers as the simple ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.functions.ranks import distributed_row_number, exact_quantiles
from cohortlens.operators import clustering, explore, sketches, subclusters
from cohortlens.operators.features import CLUSTER_FEATURES

PROBS = [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.999, 1.0]


@pytest.fixture(scope="module")
def numbers():
    rng = random.Random(11)
    rows = []
    for i in range(30_000):
        # A third of `tied` is one value; `money` is heavy-tailed; `gaps` has NULLs.
        rows.append((i, 7.0 if rng.random() < 0.34 else round(rng.gauss(7, 3), 1),
                     rng.lognormvariate(10, 2), None if rng.random() < 0.2 else rng.random(),
                     None))
    return rows


@pytest.fixture(scope="module")
def frame(spark, numbers):
    return spark.createDataFrame(
        numbers, "id bigint, tied double, money double, gaps double, empty double"
    ).repartition(8).cache()


def test_sketch_route_is_exact(frame, numbers):
    got = exact_quantiles(frame, ["tied", "money", "gaps", "empty"], PROBS, sketch=64)
    for i, c in enumerate(("tied", "money", "gaps"), start=1):
        values = [r[i] for r in numbers if r[i] is not None]
        np.testing.assert_allclose(got[c], np.quantile(values, PROBS), rtol=1e-12)
    assert got["empty"] == [None] * len(PROBS)


@pytest.mark.parametrize("sketch", [8, 50, 8192])
def test_the_sketch_does_not_change_the_numbers(frame, sketch):
    expected = exact_quantiles(frame, ["tied", "money"], PROBS, sketch=500)
    assert exact_quantiles(frame, ["tied", "money"], PROBS, sketch=sketch) == expected


def test_distributed_row_number(frame):
    numbered = distributed_row_number(
        frame.selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 7)) AS g", "money", "id"),
        "g", ["money", "id"], "rn").collect()
    groups = {}
    for r in numbered:
        groups.setdefault(r["g"], []).append((r["money"], r["id"], r["rn"]))
    assert sum(map(len, groups.values())) == 30_000
    for rows in groups.values():
        assert [rn for _, _, rn in sorted(rows)] == list(range(1, len(rows) + 1))


def cohorts(spark, n, tie_share):
    rng = random.Random(3)
    names = ["Low Risk - Low Value", "High Risk", "Medium Risk - Low Value"]
    rows = []
    for i in range(n):
        segment = names[0] if rng.random() < 0.6 else rng.choice(names)
        if i < 40:
            segment = "Low Risk - High Value"  # stays under the split size
        x = 0.0 if rng.random() < tie_share else rng.gauss(0, 1)
        rows.append((i * 7919 % 100_003, segment, x, x, x, x, x))
    schema = "customer_id bigint, segment string, " + ", ".join(
        f"{c} double" for c in CLUSTER_FEATURES)
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("tie_share", [0.0, 0.4, 1.0])
def test_equal_split_without_sorting_a_cohort(spark, tie_share):
    df = cohorts(spark, 3000, tie_share).cache()
    expected = {}
    by_segment = {}
    for r in subclusters.with_score(df).collect():
        by_segment.setdefault(r["segment"], []).append((r["cluster_score"], r["customer_id"]))
    for segment, rows in by_segment.items():
        for place, (_, i) in enumerate(sorted(rows)):
            expected[segment, i] = None if len(rows) < 100 else 1 if place < len(rows) // 2 else 2
    got = subclusters.equal_split(df).collect()
    assert {(r["segment"], r["customer_id"]): r["sub_cluster"] for r in got} == expected


def test_equal_split_with_repeated_ids_and_missing_scores(spark):
    columns = ", ".join(f"{c} double" for c in CLUSTER_FEATURES)
    x = lambda v: (v,) * len(CLUSTER_FEATURES)
    rows = [(50 if 40 <= i < 60 else i, "tied", *x(1.0)) for i in range(100)]
    rows += [(i, "gaps", *x(None if i < 30 else float(i))) for i in range(130)]
    df = spark.createDataFrame(rows, f"customer_id bigint, segment string, {columns}")
    split = subclusters.equal_split(df)
    sizes = {(r["segment"], r["sub_cluster"]): r["count"] for r in split.groupBy("segment", "sub_cluster").count().collect()}
    assert sizes == {("tied", 1): 50, ("tied", 2): 50, ("gaps", 1): 65, ("gaps", 2): 65}
    late = {r["customer_id"] for r in split.where("segment = 'gaps' AND sub_cluster = 2").collect()}
    assert late == set(range(30)) | set(range(95, 130))


@pytest.mark.parametrize("inertias, best", [
    ([100.0, 40.0, 30.0, 25.0], 2), ([100.0, 90.0, 30.0, 25.0], 3),
    ([100.0, 40.0, 0.0, 0.0], 2),    # minus infinity loses against a number
    ([10.0, 0.0, 0.0, 0.0], 3),      # no gain twice decides
    ([10.0, 5.0], 2)])
def test_best_k(spark, inertias, best):
    df = spark.createDataFrame(list(enumerate(inertias, start=1)), "k int, inertia double")
    assert {r["optimal_k"] for r in clustering.best_k(df).collect()} == {best}


def test_elbow_finds_the_clusters_and_repeats(spark):
    rng = random.Random(5)
    rows = [(i, *[rng.gauss(20 * (i % 3), 1) for _ in CLUSTER_FEATURES]) for i in range(3000)]
    rows += [(9000 + i, 0.0, 0.0, 0.0, 0.0, 0.0) for i in range(1000)] + [(9, None, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "customer_id bigint, " + ", ".join(f"{c} double" for c in CLUSTER_FEATURES))
    once = sorted(clustering.elbow(df.repartition(7)).collect())
    assert once == sorted(clustering.elbow(df.repartition(2, "customer_id")).collect())
    assert {r["optimal_k"] for r in once} == {3}
    x = np.array([r[1:] for r in rows if r[1] is not None])
    assert once[0]["inertia"] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())
    assert clustering.elbow(df.limit(0)).collect() == []


def test_zero_and_minus_zero_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (0.1,)], "x double")
    assert explore.column_profile(df).first()["distinct_values"] == 2


def test_sketches_of_runs_merge_within_their_bound(spark):
    ids = spark.range(200_000).selectExpr("id % 10 AS run", "id * 7919 % 60000 AS loan", "if(id % 3 = 0, 'hot', 'rest') AS state")
    kept = sketches.distinct_sketches(ids, ["run", "state"], "loan")
    exact = {r["state"]: r["n"] for r in ids.selectExpr("state", "loan").distinct().groupBy("state").agg(F.count("*").alias("n")).collect()}
    for r in sketches.merged_counts(kept, ["state"]).collect():
        assert abs(r["estimate"] - exact[r["state"]]) <= sketches.error_bound() * exact[r["state"]]
    small = sketches.distinct_sketches(ids.where("loan < 20"), [], "loan")
    assert sketches.merged_counts(small).first()["estimate"] == 20
    nothing = sketches.distinct_sketches(ids.limit(0), ["run"], "loan")
    assert sketches.merged_counts(nothing).first()["estimate"] == 0
