"""Mining against a plain enumeration, and the golden arithmetic of a known run."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlens.config import CohortConfig, SEGMENTS
from cohortlens.functions.columns import combination_text
from cohortlens.operators import profiles, subclusters

DEMOS = ("a", "b", "c", "d")


def random_rows(seed, n, widths=(3, 4, 2, 5), missing=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        segment = SEGMENTS[min(4, int(rng.expovariate(0.8)))]
        values = []
        for w in widths:
            shift = SEGMENTS.index(segment) if rng.random() < 0.4 else 0
            values.append(str((rng.randrange(w) * rng.randrange(2) + shift) % w))
        if missing and rng.random() < 0.1:
            values[-1] = None
        rows.append((i, segment, *values))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id bigint, segment string, " + ", ".join(f"{d} string" for d in DEMOS))


def qualifying(rows, segment, population_size, pop_counts, threshold=1.2):
    mine = [r for r in rows if r[1] == segment]
    out = {}
    for d in range(len(DEMOS)):
        counts = Counter(r[2 + d] for r in mine)
        ordered = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0] or ""))
        out[d] = [v for v, n in ordered
                  if (n / len(mine)) / (pop_counts[d].get(v, 0) / population_size + 1e-6)
                  >= threshold]
    return {d: vs for d, vs in out.items() if vs}


def enumerate_profiles(rows, population, pop_counts, coverage, keep, first_id=None):
    """Every row votes for the sets of qualifying items it holds; keys are sorted for ids."""
    result, running = [], first_id
    for segment in SEGMENTS:
        mine = [r for r in rows if r[1] == segment]
        cats = qualifying(rows, segment, len(population), pop_counts) if mine else {}
        if len(cats) < 2:
            continue
        rank = {(d, v): i for d, vs in cats.items() for i, v in enumerate(vs)}

        def votes(people):
            held = [[(d, r[2 + d]) for d in cats if r[2 + d] is not None and (d, r[2 + d]) in rank]
                    for r in people]
            return Counter(frozenset(s) for items in held for size in range(2, len(items) + 1)
                           for s in itertools.combinations(items, size))
        own, everyone = votes(mine), votes(population)
        keys = set(own)
        if coverage <= 0:   # combinations that nobody holds count too
            keys = {frozenset()}
            for d, vs in cats.items():
                keys = {k | {(d, v)} for k in keys for v in vs}
        keys = [sorted(k) if None not in dict(k).values() else sorted(k, key=lambda i: i[0])
                for k in keys if own[k] / len(mine) >= coverage]
        largest = max(map(len, keys), default=0)
        keys = sorted((k for k in keys if len(k) == largest),
                      key=lambda k: ([d for d, _ in k], [rank[i] for i in k]))
        start = 1 if running is None else running
        for at, k in enumerate(keys, start):
            text = " | ".join(f"{DEMOS[d]}: {'nan' if v is None else v}" for d, v in k)
            n, pop = own[frozenset(k)], everyone[frozenset(k)]
            result.append((segment, at, text, n, pop, n / len(mine), pop / len(population)))
        if running is not None:
            running = start + len(keys)
    return result


@pytest.mark.parametrize("seed,n", [(1, 400), (2, 900), (3, 60), (4, 1500)])
def test_matches_enumeration(spark, seed, n):
    rows = random_rows(seed, n)
    pop_counts = [Counter(r[2 + d] for r in rows) for d in range(len(DEMOS))]
    expected = enumerate_profiles(rows, rows, pop_counts, 0.02, 2)
    cells = profiles.demographic_cells(frame(spark, rows), DEMOS).cache()
    items = profiles.qualifying_items(profiles.item_counts(cells, DEMOS))
    winners = profiles.winning_combinations(profiles.combination_counts(
        cells, items, demographics=DEMOS))
    got = [(r["segment"], r["position"], r["combination"], r["n"], r["pop_n"])
           for r in winners.withColumn("combination", F.expr(combination_text("combo"))).collect()]
    assert sorted(got) == sorted(e[:5] for e in expected)

    best = []
    for segment in SEGMENTS:
        mine = [e for e in expected if e[0] == segment]
        mine.sort(key=lambda e: (-e[5], -(e[5] / (e[6] + 1e-6)), e[1]))
        best += [(segment, f"C{e[1]}", e[2], e[3]) for e in mine[:2]]
    top = profiles.segment_profiles(cells, demographics=DEMOS).collect()
    assert sorted((r["segment"], r["combination_id"], r["combination"], r["count"])
                  for r in top) == sorted(best)
    assert all(r["coverage"] == r["observed_proportion"] for r in top)


@pytest.mark.parametrize("seed,n", [(5, 300), (6, 25), (7, 12)])
def test_full_size_matches_enumeration(spark, seed, n):
    rows = random_rows(seed, n, missing=True)
    population = [r for r in rows if r[-1] is not None]
    pop_counts = [Counter(r[2 + d] for r in rows if r[2 + d] is not None)
                  for d in range(len(DEMOS))]
    expected = enumerate_profiles(rows, population, pop_counts, 0.0, 2, first_id=1)
    best = []
    for segment in SEGMENTS:
        mine = [(-round(e[5], 4), -round(e[5] / (e[6] + 1e-6), 3), e[1], e[2], e[3])
                for e in expected if e[0] == segment]
        best += [(segment, f"C{m[2]}", m[3], m[4]) for m in sorted(mine)[:2]]
    df = frame(spark, rows)
    got = profiles.full_size_combinations(
        df, df.where("d IS NOT NULL"), subclusters.population_counts(df, DEMOS),
        demographics=DEMOS).collect()
    assert sorted((r["segment"], r["combination_id"], r["combination"], r["count"])
                  for r in got) == sorted(best)


def test_full_size_with_more_products_than_a_double_counts(spark):
    names = [f"d{i}" for i in range(6)]
    # Every customer of the first cohort has values of its own: 3,000 per demographic.
    mine = [(i, SEGMENTS[0], *[f"v{i * by % 3000:04d}" for by in (7, 11, 13, 17, 19, 23)]) for i in range(3000)]
    rest = [(i, SEGMENTS[4], *["other"] * 6) for i in range(3000, 9000)]
    df = spark.createDataFrame(mine + rest, "customer_id int, segment string, " + ", ".join(f"{n} string" for n in names))
    got = sorted(profiles.full_size_combinations(df, df, subclusters.population_counts(df, names), demographics=names).collect())
    order = [sorted({r[2 + d] for r in mine}) for d in range(6)]      # all values are as frequent

    def place(row):
        index = 0
        for d in range(6):
            index = index * len(order[d]) + order[d].index(row[2 + d])
        return index + 1
    counts = Counter(r[2:] for r in mine)
    assert set(counts.values()) == {1} and 3000 ** 6 > 2 ** 53
    best = sorted(mine, key=place)[:2]
    found = {r["combination_id"]: r["combination"] for r in got if r["segment"] == SEGMENTS[0]}
    assert found == {f"C{place(r)}": " | ".join(f"{n}: {v}" for n, v in zip(names, r[2:])) for r in best}
    after = [r["combination_id"] for r in got if r["segment"] == SEGMENTS[4]]
    assert after == [f"C{3000 ** 6 + 1}"]


def test_too_many_products_fail_loudly(spark):
    names = [f"d{i}" for i in range(14)]
    mine = [(i, SEGMENTS[0], *[f"v{i}"] * 14) for i in range(600)]
    rest = [(i, SEGMENTS[4], *["other"] * 14) for i in range(600, 3000)]
    df = spark.createDataFrame(mine + rest, "customer_id int, segment string, " + ", ".join(f"{n} string" for n in names))
    with pytest.raises(OverflowError):
        profiles.full_size_combinations(df, df, subclusters.population_counts(df, names), demographics=names)


def test_one_qualifying_demographic_gives_no_profile(spark):
    rows = ([(i, SEGMENTS[0], "1", "0", "0", "0") for i in range(20)]
            + [(i, SEGMENTS[4], "0", "0", "0", "0") for i in range(20, 60)])
    cells = profiles.demographic_cells(frame(spark, rows), DEMOS)
    assert profiles.segment_profiles(cells, demographics=DEMOS).count() == 0


# Counts and full-precision results published for one known run.
GOLDEN = [
    (37, 766, 100, 9598, 4.635664729473677),
    (152, 5723, 153, 9598, 1.6660265323603425),
    (9, 224, 39, 9598, 9.885616574962619),
    (6, 224, 26, 9598, 9.884400586056183),
    (284, 1465, 1450, 9598, 1.2831888699500886),
    (50, 1420, 185, 9598, 1.8267038582445503),
]


def test_golden_lift(spark):
    df = spark.createDataFrame([g[:4] for g in GOLDEN],
                               "n bigint, segment_size bigint, pop_n bigint, pop_size bigint")
    got = [r["lift"] for r in df.selectExpr(*profiles.lift_columns()).collect()]
    assert got == [g[4] for g in GOLDEN]


def test_lift_of_empty_totals_is_zero(spark):
    df = spark.createDataFrame([(0, 0, 0, 0)],
                               "n bigint, segment_size bigint, pop_n bigint, pop_size bigint")
    assert tuple(df.selectExpr(*profiles.lift_columns()).first()) == (0.0, 0.0, 0.0)


def test_wide_profile_joins_in_place_order(spark):
    df = spark.createDataFrame(
        [(SEGMENTS[0], 2, "second"), (SEGMENTS[0], 1, "first"), (SEGMENTS[4], 1, "")],
        "segment string, place int, text string")
    row = profiles.wide_profile(df).first()
    assert row["low_risk_high_value"] == "first, second"
    assert row["high_risk"] == "" and row["medium_risk_low_value"] == ""


def test_zero_coverage_needs_the_other_search(spark):
    cells = profiles.demographic_cells(frame(spark, random_rows(1, 50)), DEMOS)
    items = profiles.qualifying_items(profiles.item_counts(cells, DEMOS))
    with pytest.raises(ValueError):
        profiles.combination_counts(cells, items, CohortConfig(coverage_threshold=0.0),
                                    DEMOS)
