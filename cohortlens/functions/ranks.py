"""Exact order statistics without one task ever holding all values.

At every size: (1) mergeable KLL sketches, of each task first and then of groups of tasks,
give a bracket around every wanted rank; (2) conditional counts say how many values lie
below and inside each bracket; (3) only values inside a bracket are counted one by one,
and a running sum over them finds the rank. A bracket that misses its rank is widened,
one that holds more than `INSIDE` values is sketched again from the inside. The size of
the sketch changes the cost, never the numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window, functions as F

from cohortlens.functions.columns import number
from cohortlens.functions.staging import write_stage

# A sketch of this size is some 100 KB; a bracket then holds a few in 1,000 values.
SKETCH = 8192
MERGED = 64           # groups of tasks whose sketches are merged before all are
INSIDE = 1 << 20      # a bracket with more values than this is narrowed


@dataclass(frozen=True)
class RankValue:
    value: float
    below: int   # rows with a smaller value
    equal: int   # rows with exactly this value


@dataclass
class _Probe:
    """Neighbouring ranks of one value, and a bracket as doubles with its counts."""
    name: str
    ranks: list[int]
    inside: int
    below: int = 0
    low: float = -math.inf
    high: float = math.inf

    def holds(self, x: str) -> str:
        return f"({x} >= {number(self.low)} AND {x} <= {number(self.high)})"

    @property
    def found(self) -> bool:
        return self.below < self.ranks[0] and self.ranks[-1] <= self.below + self.inside


def _sketch(df: DataFrame, probes: list[_Probe], x: dict[str, str], size: int, slack: float) -> None:
    """Narrows the brackets by a sketch of the values inside them."""
    inputs = [f"CASE WHEN {p.holds(x[p.name])} THEN {x[p.name]} END" for p in probes]
    names = {v: f"s{i}" for i, v in enumerate(dict.fromkeys(inputs))}
    per_group = (df.withColumn("_task", F.spark_partition_id() % MERGED).groupBy("_task")
                 .agg(*[F.kll_sketch_agg_double(F.expr(v), size).alias(c) for v, c in names.items()]))
    merged = per_group.agg(*[F.kll_merge_agg_double(c, size).alias(c) for c in names.values()])
    edges = []
    for i, (p, v) in enumerate(zip(probes, inputs)):
        at = [((p.ranks[0] - p.below - 0.5) / p.inside) - slack, ((p.ranks[-1] - p.below - 0.5) / p.inside) + slack]
        edges.append(F.kll_sketch_get_quantile_double(names[v], F.array(*[F.lit(min(max(a, 0.0), 1.0)) for a in at])).alias(f"e{i}"))
    row = merged.select(*edges).first()
    for i, p in enumerate(probes):
        p.low, p.high = row[f"e{i}"]


def _count(df: DataFrame, probes: list[_Probe], x: dict[str, str]) -> None:
    row = df.agg(*[F.expr(f"count_if({x[p.name]} < {number(p.low)})").alias(f"b{i}") for i, p in enumerate(probes)],
                 *[F.expr(f"count_if{p.holds(x[p.name])}").alias(f"i{i}") for i, p in enumerate(probes)]).first()
    for i, p in enumerate(probes):
        p.below, p.inside = row[f"b{i}"], row[f"i{i}"]


def _find(df: DataFrame, probes: list[_Probe], values: dict[str, str], x: dict[str, str]) -> list[list[RankValue]]:
    """The values at the ranks of every probe, from a histogram inside its bracket."""
    names = list(x)
    table = ", ".join(f"({i}, {names.index(p.name)}, {number(p.low)}, {number(p.high)})" for i, p in enumerate(probes))
    brackets = F.broadcast(df.sparkSession.sql(f"SELECT * FROM VALUES {table} AS t(probe, name, low, high)"))   # one row per probe
    narrow = df.selectExpr(*[f"{values[c]} AS v{i}" for i, c in enumerate(names)])
    long = narrow.select(F.inline(F.array(*[F.struct(F.lit(i).alias("name"), F.col(f"v{i}").alias("v")) for i in range(len(names))])))
    histogram = (long.where("v IS NOT NULL").join(brackets, "name").where("cast(v AS double) >= low AND cast(v AS double) <= high")
                 .groupBy("probe", "v").agg(F.count(F.lit(1)).alias("n")))
    walked = histogram.withColumn("upto", F.sum("n").over(Window.partitionBy("probe").orderBy("v")))
    table = ", ".join(f"({i}, {r - p.below}L)" for i, p in enumerate(probes) for r in p.ranks)
    wanted = F.broadcast(df.sparkSession.sql(f"SELECT * FROM VALUES {table} AS t(probe, place)"))   # one row per rank
    rows = {(r["probe"], r["place"]): r for r in walked.join(wanted, "probe").where("upto >= place AND upto - n < place").collect()}
    out = []
    for i, p in enumerate(probes):
        picked = [rows[i, r - p.below] for r in p.ranks]
        out.append([RankValue(r["v"], p.below + r["upto"] - r["n"], r["n"]) for r in picked])
    return out


def select_ranks(df: DataFrame, values: dict[str, str], wanted: Callable[[str, int], Iterable[list[int]]],
                 sketch: int = SKETCH) -> dict[str, tuple[int, list[list[RankValue]]]]:
    """How many rows have a value, and the values at given ranks, exactly.

    values: name -> SQL of a number, all of one type, null where a row does not count; NaN
    never counts. wanted(name, n): groups of neighbouring ranks (from 1) among n values. The
    names must be few: their bounds come to the driver, the rows never do.
    """
    if not values:
        return {}
    x = {name: f"nanvl(cast({sql} AS double), NULL)" for name, sql in values.items()}
    sizes = df.agg(*[F.expr(f"count({sql})").alias(f"n{i}") for i, sql in enumerate(x.values())]).first()
    n = dict(zip(x, sizes))
    probes = [_Probe(name, list(ranks), n[name]) for name in x if n[name] for ranks in wanted(name, n[name])]
    todo, slack = probes, 6 / sketch ** 0.9
    while todo:
        was = [replace(p) for p in todo]
        _sketch(df, todo, x, max(sketch, 8), slack)
        _count(df, todo, x)
        missed = [(p, w) for p, w in zip(todo, was) if not p.found]
        wide = [p for p, w in zip(todo, was) if p.found and INSIDE < p.inside < w.inside and p.low < p.high]
        for p, w in missed:
            p.low, p.high, p.below, p.inside = w.low, w.high, w.below, w.inside
        slack = slack * 8 if missed else slack   # the whole range at last
        todo = [p for p, _ in missed] + wide
    found = _find(df, probes, values, x) if probes else []
    out = {name: (n[name], []) for name in x}
    for p, picked in zip(probes, found):
        out[p.name][1].append(picked)
    return out


@dataclass(frozen=True)
class Cut:
    """A place in the order (score, key)."""
    score: float
    key: int
    before: int   # rows before the place's (score, key)
    equal: int    # rows with exactly this score and key


def select_places(df: DataFrame, groups: dict[str, str], score: str, key: str,
                  wanted: Callable[[str, int], Iterable[int]]) -> dict[str, list[Cut]]:
    """The rows at given places (from 1) in the order (score, key), by counting only.

    groups: name -> SQL condition of its rows; score and key are SQL of a double without
    nulls or NaN and a bigint without nulls. First the scores at the places are found, then the keys among
    the rows that tie with them.
    """
    near = select_ranks(df, {g: f"CASE WHEN {c} THEN {score} END" for g, c in groups.items()},
                        lambda g, n: [[r] for r in wanted(g, n)])
    ties, places = {}, {}
    for g, (n, picked) in near.items():
        for i, (r, (v,)) in enumerate(zip(wanted(g, n), picked)):
            ties[f"{g}/{i}"] = f"CASE WHEN {groups[g]} AND {score} = {number(v.value)} THEN {key} END"
            places[f"{g}/{i}"] = (g, v, r - v.below)
    keys = select_ranks(df, ties, lambda t, n: [[places[t][2]]])
    out: dict[str, list[Cut]] = {g: [] for g in groups}
    for t, (g, v, _) in places.items():
        found = keys[t][1][0][0]
        out[g].append(Cut(v.value, found.value, v.below + found.below, found.equal))
    return out


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    sketch: int = SKETCH) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column, as driver numbers."""
    def ranks(_: str, n: int) -> list[list[int]]:
        return [sorted({math.floor(p * (n - 1)) + 1, math.ceil(p * (n - 1)) + 1}) for p in probs]

    found = select_ranks(df, {c: f"nanvl(cast(`{c}` AS double), NULL)" for c in columns}, ranks, sketch)
    out: dict[str, list[float | None]] = {}
    for c, (n, picked) in found.items():
        values = []
        for p, near in zip(probs, picked):
            h = p * (n - 1)
            values.append(near[0].value if len(near) == 1 else
                          (math.ceil(h) - h) * near[0].value + (h - math.floor(h)) * near[1].value)
        out[c] = values if n else [None] * len(probs)
    return out


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5]).items()}


def distributed_row_number(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """row_number per group, for groups too large for one task.

    Rows are range partitioned by (group, order); each partition numbers its
    own rows and adds the row counts of the partitions before it. The order
    must be unique within a group.
    """
    parts = (df.repartitionByRange(group, *order)
             .withColumn("_part", F.spark_partition_id()))
    staged = write_stage(parts, "ranked").df
    sizes = staged.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "_part",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    here = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    return (staged.withColumn("_here", here).join(offsets, [group, "_part"])
            .withColumn(name, F.col("_here") + F.col("_offset"))
            .drop("_part", "_here", "_offset"))
