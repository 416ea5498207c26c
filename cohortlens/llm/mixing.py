"""Mixing sources to target weights by a low-discrepancy source schedule.

The mix is a row of slots of `block` words, of which every source gets as many as its
target fills; its last slot is cut to the words still missing, so no source is too
small for a slot. Slot i stands at the golden-ratio point i * A mod 2^31 (A: the odd
integer nearest to 2^31 / phi); in the order of the points the slots are dealt to the
sources one after the other, so every stretch of the schedule is close to the targets.
A slot's rank among its source's slots names the block of the source's stream that
fills it: the source's documents in hash order, laid end to end and repeated up to
`EPOCHS` times, cut into equal blocks of words.

Targets are the source's share of all words by weight, at most EPOCHS times what the
source has; what is cut off is shared out again by weight. A source gives its target, rounded
up to whole words.

Ranks and word positions are running sums over chunks and hash buckets, so a source
of any size is spread over many tasks. The schedule depends on the data and
parameters only: reruns agree.

Defined results: a null or blank text has no words and nothing is taken; rows
without a source are a source of their own, last in order; repeated rows are
documents of their own (`mixed_documents` gives equal rows equal shares). Empty
tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortlens.llm import kernel
from cohortlens.llm.common import keep, text_id

WEIGHTS = (1, 2, 3)
EPOCHS = 3
BLOCK = 2048           # words in a slot, at most
MIN_SLOTS = 1 << 16    # small mixes take shorter slots, for enough of them
RING = 1 << 31
STEP = 1327217885      # odd integer nearest to RING / golden ratio
CELL = 1 << 19         # width of the cells that slots are put in order in
RUN = 1 << 10          # slots of a source listed together
CHUNK = 1 << 16        # slots ranked together
BUCKET_BITS = 12       # hash buckets of a source


def _sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = kernel.text_bytes(batch.column("text"))
        n = np.zeros(len(at) - 1, np.int64)
        for i, j in kernel.pieces(at):
            n[i:j] = np.diff(kernel.Words(data, at[i:j + 1]).first)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), batch.column("t"), pa.array(n)],
                                         ["doc_id", "source", "t", "size"])


def targets(sources: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """sources (source, source_size) with idx, weight and target."""
    # One row per source: the only ordering that one task sees.
    ranked = keep(sources.withColumn("idx", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn(
        "weight", F.get(F.array(*map(F.lit, weights)), F.col("idx") % len(weights)).cast("double")), "sources")
    total, free = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(1.0))).first()
    each, cap, capped = total / free, epochs * F.col("source_size"), -1
    while True:
        above = F.lit(each) * F.col("weight") > cap
        n, fixed, rest = ranked.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
                                    F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        if n == capped:
            break
        capped, each = n, (total - fixed) / rest if rest else each
    return ranked.withColumn("target", F.least(F.lit(each) * F.col("weight"), cap.cast("double")))


def schedule(wanted: DataFrame, block: int) -> DataFrame:
    """slot, idx, rank (from 0, within the source) and words of every slot."""
    upto = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    spans = (wanted.select("idx", F.ceil("target").alias("wanted"))
             .withColumn("n", F.ceil(F.col("wanted") / block)).where("n > 0")
             .withColumn("hi", F.sum("n").over(upto)).withColumn("lo", F.col("hi") - F.col("n")))
    spans = keep(spans, "spans")
    n = spans.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    run = F.explode(F.sequence(F.floor(F.col("lo") / RUN), F.floor((F.col("hi") - 1) / RUN)))
    first, last = F.greatest("lo", F.col("run") * RUN), F.least(F.col("hi"), (F.col("run") + 1) * RUN) - 1
    owners = spans.withColumn("run", run).select("idx", "wanted", F.explode(F.sequence(first, last)).alias("place"))

    slots = wanted.sparkSession.range(n).select(
        F.col("id").alias("slot"), (F.col("id") % RING * STEP % RING).alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") / CELL))
    lower = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    below = (slots.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
             .select("cell", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("below")))
    within = F.row_number().over(Window.partitionBy("cell").orderBy("u", "slot"))
    places = (slots.withColumn("within", within).join(below, "cell")
              .select("slot", (F.col("within") + F.col("below") - 1).alias("place")))
    slots = keep(places.join(owners, "place")
                 .select("slot", "idx", "wanted", F.floor(F.col("slot") / CHUNK).alias("chunk")), "slots")
    chunks = slots.groupBy("idx", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("idx").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shift = chunks.select("idx", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    here = F.row_number().over(Window.partitionBy("idx", "chunk").orderBy("slot"))
    rank = F.col("here") + F.col("shift") - 1
    return (slots.withColumn("here", here).join(shift, ["idx", "chunk"]).withColumn("rank", rank)
            .select("slot", "idx", "rank", F.least(F.lit(block), F.col("wanted") - F.col("rank") * block).alias("words")))


def _positions(rows: DataFrame) -> DataFrame:
    """First word of every document in its source's stream (hash order)."""
    rows = rows.withColumn("bucket", F.shiftright("h", 64 - BUCKET_BITS))
    sums = rows.groupBy("idx", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("idx").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("idx", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("shift"))
    within = Window.partitionBy("idx", "bucket").orderBy("h", "rid").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(shift, ["idx", "bucket"])
            .withColumn("start", F.col("within") + F.col("shift")).drop("bucket", "within", "shift"))


def mix(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, block: int = BLOCK,
        min_slots: int = MIN_SLOTS) -> DataFrame:
    """doc_id, t (hash of the text), size, source_size, target, taken of every row."""
    narrow = docs.select("doc_id", "source", text_id().alias("t"), "text").mapInArrow(
        _sizes, "doc_id long, source string, t long, size long")
    rows = keep(narrow.withColumn("h", F.xxhash64("doc_id", "t")).withColumn("rid", F.monotonically_increasing_id()), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = keep(targets(sources, weights, epochs), "targets")
    total = wanted.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    block = max(1, min(block, total // min_slots))
    slots = keep(schedule(wanted, block), "schedule")

    rows = rows.join(wanted.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "weight")
    placed = _positions(rows)
    ends = slots.groupBy("idx").agg(F.sum("words").alias("reach"))
    epoch = F.sequence(F.lit(0), F.least(F.lit(epochs - 1), F.floor((F.col("reach") - 1) / F.col("source_size")).cast("int")))
    copies = (placed.where("size > 0").join(ends, "idx").withColumn("epoch", F.explode(epoch))
              .withColumn("p", F.col("start") + F.col("epoch") * F.col("source_size")).where("p < reach"))
    fragments = copies.withColumn("rank", F.explode(F.sequence(
        F.floor(F.col("p") / block), F.floor((F.col("p") + F.col("size") - 1) / block))))
    begin = F.col("rank") * block
    words = F.least(F.col("p") + F.col("size"), begin + F.col("words")) - F.greatest(F.col("p"), begin)
    taken = (fragments.join(slots.select("idx", "rank", "words"), ["idx", "rank"])
             .groupBy("rid").agg(F.sum(F.greatest(words, F.lit(0))).cast("long").alias("taken")))
    return (rows.join(taken, "rid", "left")
            .select("doc_id", "t", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


def _copies(schema_names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, taken = (batch.column(c).to_numpy() for c in ("_size", "_taken"))
            whole = np.where(size > 0, taken // np.maximum(size, 1), 0)
            part = np.where(size > 0, taken % np.maximum(size, 1), 0)
            table = pa.Table.from_batches([batch]).select(schema_names)
            yield from table.take(np.repeat(np.arange(len(size)), whole)).to_batches()
            cut = np.flatnonzero(part)
            if len(cut):
                rest = table.take(cut)
                texts = []
                for text, n in zip(rest.column("text").to_pylist(), part[cut]):
                    raw = text.encode()
                    words = kernel.Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                    texts.append(raw[:words.ends[n - 1]].decode())
                rest = rest.set_column(schema_names.index("text"), "text", pa.array(texts, pa.string()))
                if "n_chars" in schema_names:
                    rest = rest.set_column(schema_names.index("n_chars"), "n_chars", pa.array([len(t) for t in texts], pa.int64()))
                yield from rest.combine_chunks().to_batches()
    return run


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as rows: whole copies, and the first words of a document taken in part."""
    got = (mix(docs, **settings).groupBy(F.col("doc_id").alias("_d"), F.col("t").alias("_g"))
           .agg(F.max("size").alias("_size"), F.floor(F.avg("taken")).alias("_taken")).where("_taken > 0"))
    rows = docs.withColumn("_t", text_id())
    joined = rows.join(got, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_g")))
    return joined.select(*docs.columns, "_size", "_taken").mapInArrow(_copies(docs.columns), docs.schema)


def mixing_digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
