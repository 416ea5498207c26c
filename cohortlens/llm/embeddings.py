"""Near-duplicate vectors by an epsilon grid order join.

cos(x, y) >= c is |x - y|^2 <= 2 - 2c for unit vectors. Unit vectors are projected on
the leading principal dimensions (fitted on the sums of all vectors), which never
lengthens a distance, and laid on a grid of cell width epsilon. Rows are sorted by
label and lexicographic cell order and cut into intervals of at most `BLOCK` vectors,
each with the bounding box of its projections. Interval pairs of one label meet only
if their ranges on the first dimension are within epsilon and their boxes are, and are
then joined recursively: a pair whose boxes are further apart is skipped, a large one
halved, a small one compared by double-precision products. A task returns
link counts and local roots per vector, never its pairs.

Equal vectors of one label are collapsed first and carry their number.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component link with nothing, and so do rows without a label; vectors of different
lengths do not link. Rows equal in all three columns count as one vector. A null
vec_id is an ordinary vector but names no component: its own component_id is null
unless it links. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.common import keep
from cohortlens.llm.components import components, union_find

COSINE = 0.98
LEADING = 8     # principal dimensions of the grid and the boxes
BLOCK = 512     # vectors in an interval
LEAF = 64       # interval pairs up to this size are compared directly
SLACK = 1e-9    # rounding of projections; skips stay provable


def _unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _stack(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors, by length. No nulls inside."""
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, flat[starts[rows][:, None] + np.arange(n)]


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums for the covariance, by vector length: length^2 + length numbers a task."""
    sums: dict[int, list] = {}
    for batch in batches:
        for _, m in _stack(batch.column("embedding")):
            u = _unit(m)
            s = sums.setdefault(m.shape[1], [0, 0.0, 0.0])
            s[0], s[1], s[2] = s[0] + len(u), s[1] + u.sum(0), s[2] + u.T @ u
    for n, (count, one, two) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([n]), pa.array([count]), pa.array([one.tolist()]), pa.array([two.ravel().tolist()])],
            ["dim", "n", "one", "two"])


def principal_axes(vectors: DataFrame, leading: int = LEADING) -> dict[int, np.ndarray]:
    """Per vector length an orthonormal length x leading matrix."""
    parts = vectors.select("embedding").mapInArrow(_moments, "dim long, n long, one array<double>, two array<double>")
    sums: dict[int, list] = {}
    for r in parts.toLocalIterator():
        s = sums.setdefault(r["dim"], [0, 0.0, 0.0])
        s[0], s[1], s[2] = s[0] + r["n"], s[1] + np.array(r["one"]), s[2] + np.array(r["two"]).reshape(r["dim"], -1)
    axes = {}
    for dim, (n, one, two) in sums.items():
        cov = two / n - np.outer(one / n, one / n)
        values, basis = np.linalg.eigh((cov + cov.T) / 2)
        axes[dim] = basis[:, np.argsort(-values)[:leading]]
    return axes


def _project(axes: dict[int, np.ndarray], epsilon: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list = [None] * batch.num_rows
            for rows, m in _stack(batch.column("embedding")):
                grid = np.floor(_unit(m) @ axes[m.shape[1]] / epsilon).astype(np.int64)
                for r, g in zip(rows, grid):
                    cells[r] = g.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("class_id", "label", "dim", "copies", "embedding")]
                + [pa.array(cells, pa.list_(pa.int64()))],
                ["class_id", "label", "dim", "copies", "embedding", "cell"])
    return run


def _intervals(axes: dict[int, np.ndarray], block: int):
    """Cut a sorted partition into intervals; each becomes one row."""
    def pack(rows: list) -> pa.RecordBatch:
        ids, label, dim, copies, vectors = zip(*rows)
        m = np.array(vectors, np.float32)
        p = _unit(m) @ axes[dim[0]]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[0]]), pa.array([label[0]], pa.int32()), pa.array([dim[0]]),
             pa.array([np.array(ids, np.int64).tobytes()]), pa.array([np.array(copies, np.int64).tobytes()]),
             pa.array([m.tobytes()]), pa.array([p.min(0).tolist()]), pa.array([p.max(0).tolist()])],
            ["block", "label", "dim", "ids", "copies", "vectors", "low", "high"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            d = batch.to_pydict()
            for row in zip(d["class_id"], d["label"], d["dim"], d["copies"], d["embedding"]):
                if held and (len(held) == block or held[0][1:3] != row[1:3]):
                    yield pack(held)
                    held = []
                held.append(row)
        if held:
            yield pack(held)
    return run


def _join_pair(a: np.ndarray, b: np.ndarray, axes: np.ndarray, cosine: float, same: bool):
    """Index pairs (i, j) of linked rows; i < j where both sides are one interval."""
    reach = np.sqrt(2 - 2 * cosine) + SLACK
    pa_, pb = a @ axes, b @ axes
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        if same and i0 >= j1:
            continue
        gap = np.maximum(0, np.maximum(pb[j0:j1].min(0) - pa_[i0:i1].max(0), pa_[i0:i1].min(0) - pb[j0:j1].max(0)))
        if gap @ gap > reach * reach:
            continue
        if max(i1 - i0, j1 - j0) > LEAF:
            im, jm = (i0 + i1) // 2, (j0 + j1) // 2
            todo += [(x0, x1, y0, y1) for x0, x1 in ((i0, im), (im, i1)) for y0, y1 in ((j0, jm), (jm, j1))
                     if x0 < x1 and y0 < y1]
            continue
        i, j = np.nonzero(a[i0:i1] @ b[j0:j1].T >= cosine)
        i, j = i + i0, j + j0
        if same:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield i, j


def _compare(axes: dict[int, np.ndarray], cosine: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dim, same = r["dim"], r["a"] == r["b"]
                side = []
                for s in "ab":
                    m = np.frombuffer(r[f"vectors_{s}"], np.float32).reshape(-1, dim)
                    side.append((np.frombuffer(r[f"ids_{s}"], np.int64), np.frombuffer(r[f"copies_{s}"], np.int64), _unit(m)))
                (ia, ca, ua), (ib, cb, ub) = side
                n_a, n_b, edges = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64), []
                for i, j in _join_pair(ua, ub, axes[dim], cosine, same):
                    np.add.at(n_a, i, cb[j])
                    np.add.at(n_b, j, ca[i])
                    edges += zip(ia[i].tolist(), ib[j].tolist())
                    if len(edges) > 1 << 16:
                        edges = list(union_find(edges).items())
                root = union_find(edges)
                got = [(k, n, root[k]) for k, n in [*zip(ia.tolist(), n_a.tolist()), *zip(ib.tolist(), n_b.tolist())] if n]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got)], ["class_id", "n", "root"])
    return run


def near_vectors(embeddings: DataFrame, cosine: float = COSINE, leading: int = LEADING,
                 block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every distinct row."""
    epsilon = float(np.sqrt(2 - 2 * cosine))
    rows = embeddings.select("vec_id", "embedding", "label").distinct()
    usable = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("embedding", lambda x: x != 0))
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    # Adding 0.0 makes -0.0 and 0.0 one value.
    key = F.when(F.col("ok"), F.xxhash64("label", F.transform("embedding", lambda x: x + F.lit(0.0).cast("float"))))
    rows = keep(rows.withColumn("class_id", key), "vectors")
    classes = keep(rows.where("ok").groupBy("class_id", "label", "embedding")
                   .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("rep"))
                   .withColumn("dim", F.size("embedding").cast("long")), "classes")

    axes = principal_axes(classes, leading)
    cells = classes.select("class_id", "label", "dim", "copies", "embedding").mapInArrow(
        _project(axes, epsilon),
        "class_id long, label int, dim long, copies long, embedding array<float>, cell array<long>")
    order = ["label", "dim", "cell", "class_id"]
    blocks = keep(keep(cells, "cells").repartitionByRange(*order).sortWithinPartitions(*order)
                  .select("class_id", "label", "dim", "copies", "embedding").mapInArrow(
                      _intervals(axes, block),
                      "block long, label int, dim long, ids binary, copies binary, vectors binary,"
                      " low array<double>, high array<double>"), "intervals")

    # Candidate interval pairs: first dimension by equal or neighbouring cells, then boxes.
    slim = blocks.select("block", "label", "dim", "low", "high")
    first = lambda c: F.floor(F.get(F.col(c), F.lit(0)) / epsilon)
    at = slim.withColumn("c", F.explode(F.sequence(first("low"), first("high"))))
    near = slim.withColumn("c", F.explode(F.sequence(first("low") - 1, first("high") + 1)))
    gap = F.aggregate(F.zip_with(F.zip_with("low", "other_high", lambda x, y: x - y),
                                 F.zip_with("other_low", "high", lambda x, y: x - y),
                                 lambda x, y: F.greatest(x, y, F.lit(0.0))),
                      F.lit(0.0), lambda s, g: s + g * g)
    pairs = (at.join(near.select(F.col("block").alias("b"), "label", "dim", "c", F.col("low").alias("other_low"),
                                 F.col("high").alias("other_high")), ["label", "dim", "c"])
             .where(F.col("block") <= F.col("b")).where(gap <= (epsilon + SLACK) ** 2)
             .select(F.col("block").alias("a"), "b").distinct())
    side = lambda s: blocks.select(F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "vectors")],
                                   *(["dim"] if s == "a" else []))
    found = keep(pairs.join(side("a"), "a").join(side("b"), "b")
                 .mapInArrow(_compare(axes, cosine), "class_id long, n long, root long"), "vector-links")

    counts = found.groupBy("class_id").agg(F.sum("n").alias("others"))
    comp = components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    # A component is named by its smallest vec_id.
    named = (classes.select("class_id", "copies", "rep").join(counts, "class_id", "left")
             .join(comp.withColumnRenamed("node", "class_id"), "class_id", "left")
             .withColumn("component", F.coalesce("component", "class_id")))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select(
        F.col("class_id").alias("k"), "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return (rows.join(named, F.col("class_id") == F.col("k"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def embeddings_digest(embeddings: DataFrame) -> DataFrame:
    return near_vectors(embeddings)
