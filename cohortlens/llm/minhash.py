"""Near-duplicate documents by SuperMinHash, banding, verification, union-find.

A document is its set of distinct k-word shingles (64-bit hashes). SuperMinHash
walks one pseudo-random permutation of the signature's places per shingle: step j
offers the value j + r to place p[j]. Values of step j lie in [j, j + 1), so a
document is done as soon as every place holds less than j; long documents need two
or three steps. `BANDS` bands of `ROWS` values give bucket keys: at a similarity
of 0.8 the chance that two documents share no bucket is 5e-8.

Equal sets are collapsed first. Then neighbours are compared: with the documents sorted by
their band keys, in `ORDERS` rotations, each set is held against the `WINDOW` sets before
it, which joins most members of a group at one row each. Only buckets that still hold
more than one component go on, and in these not all pairs are compared. A bucket's most central member is the pivot and is compared with the others; a link merges
components. With pivot P, a member X is known by its difference D(X) from P, and
the difference of two members is |D(X)| + |D(Y)| - 2 |D(X) & D(Y)|. So two members
that are not both linked to P can be linked only if their differences share enough
elements, and such pairs are found by joining on the first elements of the
differences (those that the fewest differences hold first, by a table of `SLOTS` hashed
counts; prefix and position filter), then verified. By the triangle inequality of the Jaccard distance a member within 2 (1 - t)
of P has all its partners within 3 (1 - t); it is done and leaves the bucket.

Members further from their pivots share a passage with them, not a text. They are joined
on their own rarest elements: of n elements, ordered by the same hashed counts, a link needs one in
common among the first n - ceil(t n) + 1 of both, and what follows it in the shorter rest
must suffice. An element's members are first held against one of them; then only pairs of
different components are made, one side outside the element's largest component.
All links between members of a bucket are found, and a group of copies costs rows in
proportion to its members.

Defined results: a null, empty or blank text has no shingles and links with
nothing; with fewer than k words the whole word sequence is the one shingle.
Rows without doc_id link with nothing, are kept, and have no component. Rows of one
doc_id with different sets are documents of their own with the same id; equal rows are one.
Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.llm import kernel
from cohortlens.llm.common import keep, text_id, unused
from cohortlens.llm.components import components

BANDS, ROWS = 32, 4
PLACES = BANDS * ROWS
PERCENT = 80     # links need 100 * intersection >= PERCENT * union
SHINGLE = 5
ORDERS = 3       # rotations of the band keys that documents are sorted by
WINDOW = 4       # earlier neighbours that a set is held against
SLOTS = 1 << 20  # hashed counts of elements, in CHUNKS parts
CHUNKS = 64


def shingle_sets(words: kernel.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after another, and first[]."""
    h, first = words.hashes(), words.first
    grams, to = kernel.grams(h, first, k)
    n = np.diff(first)
    sets = []
    for i in range(len(n)):
        if n[i] >= k:
            sets.append(np.unique(grams[to[i]:to[i + 1]]))
        elif n[i]:  # all words as one shingle; its length is part of the hash
            short, _ = kernel.grams(h[first[i]:first[i + 1]], np.array([0, n[i]]), int(n[i]))
            sets.append(short)
        else:
            sets.append(np.zeros(0, np.uint64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def super_minhash(elements: np.ndarray, first: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Signatures (row per set) as integers step * 2^32 + random part."""
    n = len(first) - 1
    sig = np.full(n * places, np.iinfo(np.uint64).max, np.uint64)
    row = np.repeat(np.arange(n), np.diff(first))
    live, picks = elements, []
    for step in range(places):
        rnd = kernel.mix(live, 100 + step)
        pick = step + ((rnd & kernel.U(0xFFFFFFFF)) % kernel.U(places - step)).astype(np.int16)
        # The place now at `pick`: follow the swaps of the earlier steps back.
        place = pick.copy()
        for i in range(step - 1, -1, -1):
            place[place == picks[i]] = i
        picks.append(pick)
        np.minimum.at(sig, row * places + place, (kernel.U(step) << kernel.U(32)) | (rnd >> kernel.U(32)))
        open_sets = sig.reshape(n, places).max(axis=1) >= (step + 1) << 32
        stay = open_sets[row]
        if not stay.any():
            break
        if not stay.all():
            live, row, picks = live[stay], row[stay], [p[stay] for p in picks]
    return sig.reshape(n, places)


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    parts = sig.reshape(len(sig), bands, -1)
    key = np.broadcast_to(kernel.mix(np.arange(bands, dtype=np.uint64), 5), parts.shape[:2]).copy()
    for r in range(parts.shape[2]):
        key = kernel.mix(key ^ parts[:, :, r], 6)
    return key.view(np.int64)


def _fingerprints(sets: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Order-free 128-bit fingerprints of the sets, as two longs each."""
    sums = []
    for salt in (11, 12):
        run_sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(kernel.mix(sets, salt))])
        sums.append((run_sum[first[1:]] - run_sum[first[:-1]]).view(np.int64))
    return sums


def _signatures(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = kernel.text_bytes(batch.column("text"))
            for i, j in kernel.pieces(at, 1 << 20):
                sets, first = shingle_sets(kernel.Words(data, at[i:j + 1], lower=True), k)
                sizes = np.diff(first)
                sums = _fingerprints(sets, first)
                keys = band_keys(super_minhash(sets, first))
                keys = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)),
                                                pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("t").slice(i, j - i), pa.array(sizes),
                     pa.array(sums[0]), pa.array(sums[1]), keys],
                    ["doc_id", "t", "n_shingles", "set_a", "set_b", "bands"])
    return run


def _packed_sets(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = kernel.text_bytes(batch.column("text"))
            for i, j in kernel.pieces(at):
                sets, first = shingle_sets(kernel.Words(data, at[i:j + 1], lower=True), k)
                packed = [sets[first[x]:first[x + 1]].tobytes() for x in range(j - i)]
                a, b = _fingerprints(sets, first)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(packed, pa.binary())], ["set_a", "set_b", "shingles"])
    return run


def _company(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that share a key with a neighbour, from rows (key, doc) in order. The rows at a
    task's ends may have their neighbour in another task and count, too."""
    last, found = None, []
    for batch in batches:
        key, doc = batch.column("key").to_numpy(), batch.column("doc").to_numpy()
        if not len(key):
            continue
        if last is None:
            found.append(doc[:1])
        else:
            key, doc = np.r_[last[0], key], np.r_[last[1], doc]
        same = key[1:] == key[:-1]
        found.append(np.unique(doc[np.r_[same, False] | np.r_[False, same]]))
        last = key[-1], doc[-1]
        if sum(map(len, found)) > 1 << 20:
            found = [np.unique(np.concatenate(found))]
            if len(found[0]) > 1 << 19:
                yield pa.RecordBatch.from_arrays([pa.array(found.pop())], ["doc"])
    if last is not None:
        found.append(np.array([last[1]]))
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], ["doc"])


def _neighbours(percent: int, window: int):
    """Links between each set and the `window` sets before it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list[tuple[int, np.ndarray]] = []
        for batch in batches:
            links = []
            for doc, packed in zip(batch.column("doc").to_pylist(), batch.column("shingles")):
                x = np.frombuffer(packed.as_buffer(), np.uint64).copy()
                for other, y in before:
                    if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                        common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                        if common and 100 * common >= percent * (len(x) + len(y) - common):
                            links.append((other, doc))
                before = [*before[1 - window:], (doc, x)] if window > 1 else [(doc, x)]
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in links], pa.int64()) for i in (0, 1)], ["a", "b"])
    return run


def _compare(left: pa.Scalar, right: pa.Scalar) -> tuple[np.ndarray, np.ndarray, int]:
    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
    return x, y, len(x) + len(y) - len(np.unique(np.concatenate([x, y])))


def _verify(percent: int):
    """Linked pairs among (a, b, left, right)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (left, right) in enumerate(zip(batch.column("left"), batch.column("right"))):
                x, y, common = _compare(left, right)
                ok[i] = common and 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).append_column("linked", pa.array(ok))
    return run


def _slots(x: np.ndarray) -> np.ndarray:
    return (kernel.mix(x, 31) & kernel.U(SLOTS - 1)).astype(np.int64)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a task's sets hold elements of each slot."""
    counts = np.zeros(SLOTS, np.uint32)
    for batch in batches:
        for packed in batch.column("shingles"):
            np.add.at(counts, _slots(np.frombuffer(packed.as_buffer(), np.uint64)), 1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(CHUNKS)), pa.array([c.tobytes() for c in counts.reshape(CHUNKS, -1)], pa.binary())],
                                     ["chunk", "counts"])


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            more = np.frombuffer(counts.as_buffer(), np.uint32)
            total[chunk] = total[chunk] + more if chunk in total else more.copy()
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([c.tobytes() for c in total.values()], pa.binary())],
                                     ["chunk", "counts"])


def _rarity(sets: DataFrame) -> np.ndarray:
    """Hashed element counts over all sets, SLOTS numbers whatever the input."""
    parts = sets.select("shingles").mapInArrow(_counted, "chunk long, counts binary")
    rows = parts.repartition("chunk").mapInArrow(_summed, "chunk long, counts binary").collect()
    out = np.zeros((CHUNKS, SLOTS // CHUNKS), np.uint32)
    for chunk, counts in rows:
        out[chunk] = np.frombuffer(counts, np.uint32)
    return out.reshape(-1)


def _differences(percent: int, rarity):
    """Members b within 3 (1 - t) of their pivot a, with the elements to join on."""
    t = percent / 100
    c = (1 - t) / (1 + t)   # linked: |difference| <= c * (sum of the sizes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = rarity.value
        for batch in batches:
            rows = []
            for a, b, left, right in zip(*(batch.column(n) for n in ("a", "b", "left", "right"))):
                p, x, common = _compare(left, right)
                union = len(p) + len(x) - common
                if union - common > (3 * (1 - t) + 1e-9) * union:
                    continue
                linked = bool(common) and 100 * common >= percent * union
                near = union - common <= (2 * (1 - t) + 1e-9) * union
                added = x[~np.isin(x, p, assume_unique=True)]
                lacking = p[~np.isin(p, x, assume_unique=True)]
                # How many differences from p hold an element: those that have it, or of
                # p's own, those that do not. Both estimates depend on p and the element only.
                most = int(counts[_slots(p)].max())
                often = np.concatenate([counts[_slots(added)].astype(np.int64), most - counts[_slots(lacking)].astype(np.int64)])
                d = np.concatenate([added, lacking])
                d = d[np.lexsort((d, often))]
                # Elements that the differences of a linked pair share, at least.
                least = ((len(d) + c * (len(p) - len(x))) / 2 if linked
                         else (len(d) - c * (len(p) + len(x))) / (1 + c))
                first = len(d) - max(1, int(np.ceil(least - 1e-9))) + 1
                rows.append((a.as_py(), b.as_py(), len(x), linked, near, len(d), d[:first].view(np.int64).tolist()))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.list_(pa.int64())]
            names = ["a", "b", "n", "linked", "near", "d", "elements"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t_) for x, t_ in zip(zip(*rows) if rows else [[]] * 7, types)], names)
    return run


def _prefixes(percent: int, rarity):
    """The rarest elements e of every set, with their place pos: linked sets share one of them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = rarity.value
        for batch in batches:
            for doc, packed in zip(batch.column("doc").to_pylist(), batch.column("shingles")):
                x = np.frombuffer(packed.as_buffer(), np.uint64)
                x = x[np.lexsort((x, counts[_slots(x)]))][:len(x) - -(-percent * len(x) // 100) + 1].view(np.int64)
                for i in range(0, len(x), 1 << 16):
                    e = x[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(e), v)) for v in (doc, packed.as_buffer().size // 8)]
                        + [pa.array(np.arange(i, i + len(e))), pa.array(e)], ["doc", "n", "pos", "e"])
    return run


def _split_buckets(classes: DataFrame, comp: DataFrame | None) -> DataFrame:
    """key, doc, n and centrality of all members of buckets with more than one component."""
    labelled = _labelled(classes.select("doc", F.col("n_shingles").alias("n"), "bands"), "doc", comp)
    rows = labelled.select("doc", "n", "comp", F.explode("bands").alias("key"))
    split = (rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("mates"))
             .where("lo <> hi").select("key", "mates"))
    met = keep(rows.drop("comp").join(split, "key"), "buckets")
    central = met.groupBy("doc").agg(F.sum("mates").alias("centrality"))
    return keep(met.join(central, "doc").select("key", "doc", "n", "centrality"), "buckets")


def _pivots(members: DataFrame) -> DataFrame:
    """key, pivot, pivot_n: the most central member of every bucket."""
    ranked = F.struct("centrality", (-F.col("doc")).alias("minus"), "n")
    return (members.groupBy("key").agg(F.max(ranked).alias("p"))
            .select("key", (-F.col("p.minus")).alias("pivot"), F.col("p.n").alias("pivot_n")))


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")


def _labelled(rows: DataFrame, doc: str, comp: DataFrame | None) -> DataFrame:
    """rows with `comp`, the component of the document in column `doc` so far."""
    if comp is None:
        return rows.withColumn("comp", F.col(doc))
    return (rows.join(comp.withColumnRenamed("node", doc), doc, "left")
            .withColumn("comp", F.coalesce("component", doc)).drop("component"))


def _split_only(rows: DataFrame, group: str) -> DataFrame:
    """Rows of groups that hold more than one component."""
    split = rows.groupBy(group).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return rows.join(split.select(group), group, "left_semi")


def _difference_pairs(seen: DataFrame, percent: int) -> DataFrame:
    """Pairs a < b of one pivot whose differences can share enough. seen: with comp."""
    c = (100 - percent) / (100 + percent)
    rows = _split_only(seen, "a").select(
        F.col("a").alias("pivot"), F.col("b").alias("x"), "n", "d", "comp", F.posexplode("elements").alias("pos", "e"))
    x = rows.select("pivot", "e", *[F.col(k).alias(f"{k}_x") for k in ("x", "n", "d", "comp", "pos")])
    y = rows.select("pivot", "e", *[F.col(k).alias(f"{k}_y") for k in ("x", "n", "d", "comp", "pos")])
    can = 2 * F.least(F.col("d_x") - F.col("pos_x"), F.col("d_y") - F.col("pos_y")) + 1e-6 >= (
        F.col("d_x") + F.col("d_y") - c * (F.col("n_x") + F.col("n_y")))
    on = (x.pivot == y.pivot) & (x.e == y.e) & (F.col("x_x") < F.col("x_y")) & (F.col("comp_x") != F.col("comp_y")) & can
    return x.join(y, on).select(F.col("x_x").alias("a"), F.col("x_y").alias("b")).distinct()


def _shared_elements(prefixes: DataFrame, comp: DataFrame | None) -> DataFrame:
    """Prefix rows of elements held by more than one component, with comp and big, the
    element's most frequent component."""
    rows = _labelled(prefixes, "doc", comp)
    big = (rows.groupBy("e", "comp").agg(F.count(F.lit(1)).alias("size"))
           .groupBy("e").agg(F.max(F.struct("size", "comp")).alias("most"), F.count(F.lit(1)).alias("comps"))
           .where("comps > 1").select("e", F.col("most.comp").alias("big")))
    return rows.join(big, "e")


def _prefix_pairs(x: DataFrame, y: DataFrame, percent: int, which: Column) -> DataFrame:
    """Pairs of x and y in different components that hold an element early enough to be linked."""
    x = x.select("e", *[F.col(k).alias(f"{k}_x") for k in ("doc", "n", "pos", "comp")])
    y = y.select("e", "big", *[F.col(k).alias(f"{k}_y") for k in ("doc", "n", "pos", "comp")])
    rest = F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))
    can = (100 + percent) * rest >= percent * (F.col("n_x") + F.col("n_y"))
    return (x.join(y, (x.e == y.e) & (F.col("comp_x") != F.col("comp_y")) & can & which)
            .select(F.least("doc_x", "doc_y").alias("a"), F.greatest("doc_x", "doc_y").alias("b")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, t (hash of the text), n_shingles, component_id and kept of every row of docs."""
    texts = docs.select("doc_id", "text", text_id().alias("t"))
    sigs = keep(texts.mapInArrow(_signatures(shingle),
                                 "doc_id long, t long, n_shingles long, set_a long, set_b long, bands array<long>"),
                "signatures")
    known = sigs.where("n_shingles > 0 and doc_id is not null")
    classes = keep(known.groupBy("set_a", "set_b")
                   .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
                   .withColumn("doc", F.monotonically_increasing_id()), "classes")

    company = (classes.select(F.explode("bands").alias("key"), "doc").repartitionByRange("key", "doc")
               .sortWithinPartitions("key", "doc").mapInArrow(_company, "doc long").distinct())
    wanted = keep(classes.join(company, "doc", "left_semi"), "wanted")
    packed = (texts.join(wanted.select("rep").distinct(), F.col("doc_id") == F.col("rep"), "left_semi")
              .mapInArrow(_packed_sets(shingle), "set_a long, set_b long, shingles binary"))
    sets = keep(packed.join(wanted.select("set_a", "set_b", "doc"), ["set_a", "set_b"])
                .dropDuplicates(["doc"]).select("doc", "shingles"), "sets")

    comp = None

    def merge(fresh: DataFrame) -> None:
        """Take fresh links into comp; only components that they join are worked on."""
        nonlocal comp
        ends = _labelled(_labelled(fresh, "a", comp).withColumnRenamed("comp", "comp_a"), "b", comp)
        bridges = keep(ends.where("comp_a <> comp").select(F.col("comp_a").alias("a"), F.col("comp").alias("b"))
                       .distinct(), "bridges")
        if bridges.isEmpty():
            return
        known = bridges.select(F.explode(F.array("a", "b")).alias("node")).distinct().selectExpr("node", "node as comp")
        if comp is not None:
            known = comp.selectExpr("node", "component as comp").unionAll(known.join(comp, "node", "left_anti"))
        joined = components(bridges).select(F.col("node").alias("comp"), "component")
        comp = keep(known.join(joined, "comp", "left").select("node", F.coalesce("component", "comp").alias("component")),
                    "near-components")

    ordered = sets.join(wanted.select("doc", "bands"), "doc")
    near = []
    for turn in range(ORDERS):
        shift = turn * BANDS // ORDERS
        order = F.concat(F.slice("bands", shift + 1, BANDS), F.slice("bands", 1, shift)) if shift else F.col("bands")
        row = ordered.select("doc", "shingles", order.alias("o")).repartitionByRange("o").sortWithinPartitions("o")
        near.append(row.select("doc", "shingles").mapInArrow(_neighbours(percent, WINDOW), "a long, b long"))
    merge(keep(reduce(DataFrame.unionAll, near), "neighbours"))
    members = _split_buckets(classes, comp)

    if not members.isEmpty():
        # Only documents of open buckets are compared.
        sets = keep(sets.join(members.select("doc").distinct(), "doc", "left_semi"), "sets")
        rarity = docs.sparkSession.sparkContext.broadcast(_rarity(sets))
        pivots = keep(_pivots(members), "pivots")
        met = members.join(pivots, "key").where(F.col("doc") != F.col("pivot"))
        # Sizes further apart than 3 (1 - t) allows need no look at the sets.
        close = 100 * F.least("n", "pivot_n") >= (100 - 3 * (100 - percent)) * F.greatest("n", "pivot_n")
        pairs = met.where(close).select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
        seen = keep(_with_sets(pairs, sets).mapInArrow(
            _differences(percent, rarity), "a long, b long, n long, linked boolean, near boolean, d long, elements array<long>"), "seen")
        merge(seen.where("linked").select("a", "b"))

        def verify(more: DataFrame) -> None:
            found = keep(_with_sets(more, sets).mapInArrow(_verify(percent), "a long, b long, linked boolean"), "verified")
            merge(found.where("linked").select("a", "b"))

        verify(_difference_pairs(_labelled(seen, "b", comp), percent))

        done = (met.join(seen.where("near").select(F.col("a").alias("pivot"), F.col("b").alias("doc")), ["pivot", "doc"], "left_semi")
                .select("key", "doc").unionAll(pivots.select("key", F.col("pivot").alias("doc"))).distinct())
        rest = _split_only(_labelled(members.join(done, ["key", "doc"], "left_anti"), "doc", comp), "key")
        prefixes = keep(sets.join(rest.select("doc").distinct(), "doc", "left_semi")
                        .mapInArrow(_prefixes(percent, rarity), "doc long, n long, pos long, e long"), "prefixes")
        shared = _shared_elements(prefixes, comp)
        first = shared.groupBy("e").agg(F.min(F.struct("pos", "doc", "n", "comp")).alias("s")).select("e", "s.*")
        verify(_prefix_pairs(first, shared, percent, F.lit(True)))
        shared = _shared_elements(prefixes, comp)
        verify(_prefix_pairs(shared.where("comp <> big"), shared, percent,
                             (F.col("comp_y") == F.col("big")) | (F.col("doc_x") < F.col("doc_y"))))

    found = _labelled(classes.select("set_a", "set_b", "rep", "doc"), "doc", comp)
    least = found.groupBy("comp").agg(F.min("rep").alias("component"))
    out = sigs.join(keep(found.join(least, "comp").select("set_a", "set_b", "component"), "groups"), ["set_a", "set_b"], "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    out = out.select("doc_id", "t", "n_shingles",
                     F.when(F.col("doc_id").isNotNull(), F.when(alone, F.col("doc_id")).otherwise(
                         F.col("component"))).alias("component_id"))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """docs with one document of each group: the one with the smallest doc_id."""
    rows = near_duplicates(docs, **settings)
    mine, text = unused(docs, "_doc"), unused(docs, "_text")
    gone = rows.where("not kept").select(F.col("doc_id").alias(mine), F.col("t").alias(text)).distinct()
    return docs.join(gone, (F.col("doc_id") == F.col(mine)) & (text_id() == F.col(text)), "left_anti")


def minhash_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, shingle=4).drop("t")
