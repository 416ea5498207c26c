"""Conversation prefix trie in double arrays, one per prefix shard.

A node of the trie is a distinct sequence of first turns; its members are the
conversations that start with it. Conversations are cut into segments of `SEGMENT`
turns; a segment hangs on the node that its conversation has reached before it, so a
conversation of any length is many small rows. A node is known by its depth and a
128-bit hash of its turns: the xor of one hash per (place, turn), which a running xor
over segments and a walk inside them can continue.

Equal segments are counted first. The distinct ones are range partitioned by node and
turns, so a shard is a run of neighbouring prefixes, at most `SHARD` turns. In a shard
turns get dense ids in level order, and every trie node a state: the child by turn id t
of state s is BASE[s] + t if CHECK there is s. All segments then walk down the arrays
level by level and leave what they carry at each state. Nodes on a shard's edge are
shared with its neighbours; their aggregates are merged by node key over all shards.

A conversation is the smallest member of a run of nodes at the end of its path, its own
branch, from depth r on. So sums over a subtree are sums over a node's members: of the
leaves that end own branches, and of the words before own branches (what a member
shares with smaller ones). The first walk finds the branches, the second adds them up.

Defined results: null roles and texts are empty; turns that tie are ordered by role,
then the MD5 of the text, and all stay; equal rows are turns of their own. Rows
without a conv_id belong to no conversation and make no node. Other columns are not
read. Empty tables give empty tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.llm.common import keep
from cohortlens.llm.scan import running

SEGMENT = 64          # turns of a segment
SHARD = 1 << 20       # turns of the distinct segments packed into one double array
TRIES = 64            # free places tried for a node with several children
CHUNK = 1 << 13       # conversation ids of a node hashed as one piece of text
SHARED_TURNS, FAMILY = 4, 20

NODE = ["depth", "h1", "h2"]


def n_words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), t1, t2, words: the turns in order, without their texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.md5(text).alias("digest"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), text, role).alias("t2"), n_words(text).alias("words"))
    return running(rows, ["conv_id"], ["turn", "role", "digest"], count="pos").select("conv_id", "pos", "t1", "t2", "words")


def rebuild(ordered: DataFrame, ids: DataFrame) -> DataFrame:
    """Every conversation c starts with the first h turns of conversation c - c % 20 and goes
    on with its own after its first h, h = crc32(c) % 4.

    ordered as from `turns`; ids: conv_id of all conversations. A conversation without
    any turn is one row without pos. n is the number of turns of the whole.
    """
    # At most three turns of a conversation go to at most twenty.
    heads = ordered.where(f"pos < {SHARED_TURNS}").withColumnRenamed("conv_id", "head")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS
    family = ids.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("head"))
    given = family.join(heads, "head").where("pos <= h").select("conv_id", "pos", "t1", "t2", "words")
    n_given = given.groupBy("conv_id").agg(F.count(F.lit(1)).alias("m"))
    own = (ordered.withColumn("h", h).where("pos > h").drop("h"))
    n_own = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("k"))
    sizes = (family.select("conv_id", "h").join(n_given, "conv_id", "left").join(n_own, "conv_id", "left")
             .select("conv_id", "h", F.coalesce("m", F.lit(0)).alias("m"), F.coalesce("k", F.lit(0)).alias("k")))
    sizes = keep(sizes.withColumn("n", F.col("m") + F.col("k")), "trie-sizes")
    moved = own.join(sizes, "conv_id").select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "t1", "t2", "words", "n")
    placed = given.join(sizes.select("conv_id", "n"), "conv_id").select("conv_id", "pos", "t1", "t2", "words", "n")
    none = sizes.where("n = 0").selectExpr("conv_id", "cast(null as long) as pos", "0L as t1", "0L as t2", "0L as words", "n")
    return moved.unionByName(placed).unionByName(none)


def segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """rows (conv_id, pos, t1, t2, words, n) as segments: conv_id, block, the node before it
    (depth, h1, h2), before (words up to there), n and the turns in order."""
    z = [F.xxhash64(F.lit(k), "pos", "t1", "t2") for k in (3, 4)]
    block = F.floor((F.coalesce("pos", F.lit(1)) - 1) / size).cast("long")
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "t1", "t2", "z1", "z2", "words"))
    cut = (rows.withColumns({"z1": z[0], "z2": z[1], "block": block, "turn": turn}).groupBy("conv_id", "block")
           .agg(F.max("n").alias("n"), F.array_sort(F.collect_list("turn")).alias("turns"), F.sum("words").alias("w"),
                F.coalesce(F.bit_xor(F.when(F.col("pos").isNotNull(), F.col("z1"))), F.lit(0)).alias("x1"),
                F.coalesce(F.bit_xor(F.when(F.col("pos").isNotNull(), F.col("z2"))), F.lit(0)).alias("x2")))
    out = running(cut, ["conv_id"], ["block"], sums={"before": "w"}, xors={"h1": "x1", "h2": "x2"})
    return out.withColumn("depth", F.col("block") * size)


class DoubleArray:
    """BASE and CHECK of the trie over id sequences that hang on numbered roots.

    ids, level, seq: turn id, place in its sequence (from 0) and sequence of every turn,
    in order of (level, seq); root: root of every sequence.
    """

    def __init__(self, ids: np.ndarray, level: np.ndarray, seq: np.ndarray, root: np.ndarray, n_ids: int):
        self.n_roots = int(root.max()) + 1 if len(root) else 0
        size = self.n_roots + 2 * n_ids + len(ids) + 2
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.check[:self.n_roots] = np.arange(self.n_roots)
        self.low = self.n_roots
        at = root.astype(np.int64).copy()
        edges = np.searchsorted(level, np.arange(int(level[-1]) + 2)) if len(level) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            rows, turn = seq[a:b], ids[a:b]
            self._children(np.unique(at[rows] * n_ids + turn), n_ids)
            at[rows] = self.step(at[rows], turn)

    def _children(self, pairs: np.ndarray, n_ids: int) -> None:
        """A base for every state in pairs (state * n_ids + id, sorted), and its children."""
        state, turn = pairs // n_ids, pairs % n_ids
        first = np.flatnonzero(np.r_[True, state[1:] != state[:-1]])
        ends = np.r_[first[1:], len(state)]
        many = ends - first > 1
        for i, j in zip(first[many], ends[many]):
            base = self._fit(turn[i:j])
            self.base[state[i]] = base
            self.check[base + turn[i:j]] = state[i]
        # One child: any free place will do.
        one = first[~many]
        free = self._free(len(one))
        self.base[state[one]] = free - turn[one]
        self.check[free] = state[one]
        while self.low < len(self.check) and self.check[self.low] >= 0:
            self.low += 1

    def _room(self, upto: int) -> None:
        if upto > len(self.check):
            more = max(upto, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, np.int64)]
            self.check = np.r_[self.check, np.full(more, -1, np.int64)]

    def _free(self, n: int) -> np.ndarray:
        if not n:
            return np.zeros(0, np.int64)
        span = 2 * n + 64
        while True:
            self._room(self.low + n)
            found = np.flatnonzero(self.check[self.low:self.low + span] < 0)
            if len(found) >= n:
                return found[:n] + self.low
            if self.low + span >= len(self.check):
                self._room(len(self.check) + n)
            span *= 2

    def _fit(self, turn: np.ndarray) -> int:
        rel = turn - turn[0]
        for place in self._free(TRIES):
            self._room(int(place + rel[-1]) + 1)
            if (self.check[place + rel] < 0).all():
                return int(place - turn[0])
        used = np.flatnonzero(self.check >= 0)
        place = int(used[-1]) + 1 if len(used) else self.low
        self._room(place + int(rel[-1]) + 1)
        return place - int(turn[0])

    def step(self, state: np.ndarray, turn: np.ndarray) -> np.ndarray:
        to = self.base[state] + turn
        if not (self.check[to] == state).all():
            raise ValueError("a turn that the trie does not hold")
        return to


_SUMS = ("n", "shared", "leaves")
_NODE_SCHEMA = ("depth long, h1 long, h2 long, p1 long, p2 long, before long, first long, r long, p long, first_shared long,"
                " n long, shared long, leaves long")
_NAMES = [f.split(" ")[0] for f in _NODE_SCHEMA.split(", ")]


def _shard(rows: pa.Table) -> pa.RecordBatch:
    """Nodes of the trie of distinct segments, with the sums of what the segments carry."""
    col = {c: rows.column(c).combine_chunks() for c in rows.column_names}
    get = {c: col[c].to_numpy(zero_copy_only=False) for c in col if c != "turns"}
    lists = col["turns"]
    offsets = np.asarray(lists.offsets, np.int64)
    flat = lists.values
    field = {f: flat.field(f).to_numpy(zero_copy_only=False) for f in ("t1", "t2", "z1", "z2", "words")}
    length = np.diff(offsets)
    seq = np.repeat(np.arange(len(length)), length)
    level = np.arange(offsets[-1] - offsets[0]) - np.repeat(offsets[:-1] - offsets[0], length)
    order = np.lexsort((seq, level))
    seq, level = seq[order], level[order]
    field = {f: v[offsets[0]:offsets[-1]][order] for f, v in field.items()}
    # Dense ids in the order in which turns are met level by level.
    turn = np.rec.fromarrays([field["t1"], field["t2"]])
    _, met, inverse = np.unique(turn, return_index=True, return_inverse=True)
    rank = np.empty(len(met), np.int64)
    rank[np.argsort(met)] = np.arange(len(met))
    ids = rank[inverse.reshape(-1)] if len(met) else np.zeros(0, np.int64)
    roots = np.rec.fromarrays([get["depth"], get["h1"], get["h2"]])
    _, root_row, root = np.unique(roots, return_index=True, return_inverse=True)
    root = root.reshape(-1)
    trie = DoubleArray(ids, level, seq, root, max(len(met), 1))

    size = len(trie.check)
    node = {c: np.zeros(size, np.int64) for c in _NAMES}
    node["first"][:] = np.iinfo(np.int64).max
    carrier = np.zeros(size, np.int64)

    def leave(state, rows):
        for c in _SUMS:
            np.add.at(node[c], state, get[c][rows])
        np.minimum.at(node["first"], state, get["first"][rows])
        least = get["first"][rows] == node["first"][state]
        carrier[state[least]] = rows[least]

    everyone = np.arange(len(length))
    leave(root, everyone)
    for c in ("depth", "h1", "h2"):
        node[c][:trie.n_roots] = get[c][root_row]
    at, words = root.copy(), get["before"].copy()
    edges = np.searchsorted(level, np.arange(int(level[-1]) + 2)) if len(level) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        rows = seq[a:b]
        to = trie.step(at[rows], ids[a:b])
        up = trie.check[to]
        node["depth"][to] = node["depth"][up] + 1
        node["p1"][to], node["p2"][to] = node["h1"][up], node["h2"][up]
        node["h1"][to], node["h2"][to] = node["h1"][up] ^ field["z1"][a:b], node["h2"][up] ^ field["z2"][a:b]
        node["before"][to] = words[rows]
        words[rows] += field["words"][a:b]
        leave(to, rows)
        at[rows] = to
    for c in ("r", "p", "first_shared"):
        node[c] = get[c][carrier]
    # A root deeper than 0 is a node of the block above, which counts it.
    real = (trie.check >= 0) & ((np.arange(size) >= trie.n_roots) | (node["depth"] == 0))
    return pa.RecordBatch.from_arrays([pa.array(node[c][real]) for c in _NAMES], _NAMES)


def walk(shard: int):
    """Packs and walks one shard after the other of at least `shard` turns."""
    step = max(1, min(4096, shard // SEGMENT))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                held.append(part)
                size += part.num_rows + len(part.column("turns").flatten())
                if size >= shard:
                    yield _shard(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield _shard(pa.Table.from_batches(held))
    return run


def traverse(cut: DataFrame, carried: DataFrame, shard: int = SHARD) -> DataFrame:
    """Nodes of all shards, partial: cut as from `segments`, carried: conv_id with r, p,
    shared and leaves, the values that its conversation leaves at each of its nodes."""
    # Equal segments of one node become one row before they are sorted into shards.
    path = F.transform("turns", lambda t: F.struct(t["t1"], t["t2"], t["z1"], t["z2"], t["words"]))
    least = F.min(F.struct("conv_id", "r", "p", "shared"))
    distinct = (cut.join(carried, "conv_id").withColumn("turns", path).groupBy("depth", "h1", "h2", "before", "turns")
                .agg(least.alias("least"), F.count(F.lit(1)).alias("n"), F.sum("shared").alias("shared"), F.sum("leaves").alias("leaves"))
                .select("depth", "h1", "h2", "before", "turns", F.col("least.conv_id").alias("first"), F.col("least.r").alias("r"),
                        F.col("least.p").alias("p"), F.col("least.shared").alias("first_shared"), "n", "shared", "leaves"))
    return distinct.repartitionByRange("depth", "h1", "h2", "turns").sortWithinPartitions("depth", "h1", "h2", "turns").mapInArrow(walk(shard), _NODE_SCHEMA)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined decimal ids of neighbouring rows of one node, at most CHUNK a piece."""
    names, types = [*NODE, "start", "ids"], [pa.int64()] * 4 + [pa.binary()]
    out, held, key = [], [], None

    def done():
        out.append((*key, held[0], ",".join(map(str, held)).encode()))

    for batch in batches:
        for *node, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
            if node != key or len(held) == CHUNK:
                if held:
                    done()
                held, key = [], node
            held.append(conv)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out = []
    if held:
        done()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, hashed = None, None
    for batch in batches:
        out = []
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if node != key:
                if key:
                    out.append((*key, hashed.hexdigest()))
                key, hashed = node, hashlib.sha256(ids)
            else:
                hashed.update(b"," + ids)
        if out:
            yield _digest_batch(out)
    if key:
        yield _digest_batch([(*key, hashed.hexdigest())])


def _digest_batch(rows: list) -> pa.RecordBatch:
    types = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [*NODE, "ends_sha256"])


def ends(cut: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Digest of the ids that end at a node. A hot node's ids are joined into pieces where
    they are sorted, so the task that hashes them in order streams a few long texts."""
    last = cut.where(f"n <= depth + {size}").select(
        F.col("n").cast("long").alias("depth"), F.col("h1").bitwiseXOR(F.col("x1")).alias("h1"),
        F.col("h2").bitwiseXOR(F.col("x2")).alias("h2"), "conv_id")
    order = ["h1", "h2", "depth", "conv_id"]
    pieces = last.repartitionByRange(*order).sortWithinPartitions(*order).select(*NODE, "conv_id").mapInArrow(
        _pieces, "depth long, h1 long, h2 long, start long, ids binary")
    return (pieces.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "depth", "start").select(*NODE, "ids")
            .mapInArrow(_digests, "depth long, h1 long, h2 long, ends_sha256 string"))


def prefix_trie(rows: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie of conversations given as rows (conv_id, pos, t1, t2,
    words, n): depth, h1, h2, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    cut = keep(segments(rows, segment), "trie-segments")
    zero = F.lit(0).cast("long")
    conv = cut.groupBy("conv_id").agg(F.sum("w").alias("words"))
    blank = conv.select("conv_id", *[zero.alias(c) for c in ("r", "p", "shared", "leaves")])
    # First walk: who owns a node, and which nodes have children.
    partial = traverse(cut, blank, shard)
    met = keep(partial.groupBy(*NODE).agg(F.min("first").alias("first"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
                                          F.first("before").alias("before")), "trie-nodes")
    child = met.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"),
                                          *[F.lit(None).cast("long").alias(c) for c in ("first", "p1", "p2", "before")], F.lit(1).alias("c"))
    # A parent and one row per task and parent of its children: sums, no join.
    nodes = keep(met.withColumn("c", F.lit(0)).unionByName(child).groupBy(*NODE)
                 .agg(*[F.max(c).alias(c) for c in ("first", "p1", "p2", "before")], F.sum("c").alias("n_children")), "trie-nodes")
    top = nodes.groupBy("first").agg(F.min(F.struct("depth", "p1", "p2", "before")).alias("t"),
                                     F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).cast("long").alias("leaves"))
    above = nodes.select((F.col("depth") + 1).alias("r"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("first").alias("p"))
    branch = (top.select(F.col("first").alias("conv_id"), F.col("t.depth").alias("r"), "t.p1", "t.p2",
                         F.col("t.before").alias("shared"), "leaves")
              .join(above, ["r", "p1", "p2"], "left").drop("p1", "p2"))
    # A conversation without a branch of its own shares all its words.
    carried = keep(conv.join(branch, "conv_id", "left")
                   .select("conv_id", *[F.coalesce(c, d).alias(c) for c, d in (("r", zero), ("p", zero), ("shared", F.col("words")), ("leaves", zero))]), "trie-branches")
    # Second walk: what the members of a node share and end.
    whole = F.min(F.struct("first", "r", "p", "first_shared"))
    merged = (traverse(cut, carried, shard).groupBy(*NODE)
              .agg(whole.alias("f"), F.sum("n").alias("n"), F.sum("shared").alias("shared"), F.sum("leaves").alias("n_leaves"), F.first("before").alias("before"))
              .select(*NODE, "f", "n", "shared", "n_leaves", "before", F.lit(None).cast("long").alias("n_children"), F.lit(None).cast("string").alias("ends_sha256")))
    # Children and digests join by the same merge.
    extra = [F.lit(None).cast(t).alias(c) for c, t in merged.dtypes if c not in (*NODE, "n_children", "ends_sha256")]
    kids = nodes.select(*NODE, *extra, "n_children", F.lit(None).cast("string").alias("ends_sha256"))
    closed = ends(cut, segment).select(*NODE, *extra, F.lit(None).cast("long").alias("n_children"), "ends_sha256")
    values = ["f", "n", "shared", "n_leaves", "before", "n_children", "ends_sha256"]
    out = merged.unionByName(kids).unionByName(closed).groupBy(*NODE).agg(*[F.max(c).alias(c) for c in values])
    n = F.col("n")
    return out.select(
        *NODE, F.col("f.first").alias("conv_id"),
        F.when(F.col("depth") > 0, F.when(F.col("f.r") < F.col("depth"), F.col("f.first")).otherwise(F.col("f.p"))).alias("parent_conv_id"),
        n.alias("n_convs"), F.col("n_children").cast("long"), "n_leaves",
        (F.col("shared") - F.col("f.first_shared") - (n - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def trie_digest(conversations: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    ids = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    rows = rebuild(keep(turns(conversations), "trie-turns"), ids)
    return prefix_trie(rows, segment, shard).drop("h1", "h2").select(
        "conv_id", F.col("depth").cast("long"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
