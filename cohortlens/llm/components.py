"""Connected components of an edge table, as smallest-id labels.

Each partition first runs union-find over its own edges and passes on one edge
per node to its local root (memory: the nodes of one partition). Then alternating
large-star and small-star rounds hang every node on ever smaller ids until the
forest is flat; each round is written out, so lineage stays short. A hub of any
size is one row per partition after the local step and is pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.common import keep


def union_find(pairs: Iterable[tuple[int, int]]) -> dict[int, int]:
    """Root (smallest member) of every node that the pairs name."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while up.setdefault(top, top) != top:
            top = up[top]
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def _local(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def pairs():
        for f in frames:
            yield from zip(f["a"].tolist(), f["b"].tolist())
    hung = [(x, r) for x, r in union_find(pairs()).items() if x != r]
    yield pd.DataFrame(hung, columns=["a", "b"], dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """node, component of every node of edges (a long, b long); loops are ignored."""
    forest = keep(edges.where("a <> b").select("a", "b").mapInPandas(_local, "a long, b long").distinct(), "links")
    last = None
    while True:
        # Large star: larger neighbours of a node go to the smallest neighbour.
        both = forest.unionAll(forest.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, "a").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: a node and its smaller neighbours go to the smallest one.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        forest = keep(small.select("a", F.col("m").alias("b"))
                      .unionAll(small.where("b <> m").select("b", "m")).distinct(), "links")
        state = forest.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == last:
            break
        last = state
    roots = forest.select(F.col("b").alias("node")).distinct().selectExpr("node", "node as component")
    return forest.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
