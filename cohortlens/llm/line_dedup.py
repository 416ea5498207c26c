"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

A run is a table sorted by a 128-bit line hash: how many documents of its
batches hold the line, and the document that keeps it. Batches arrive newest
first (largest doc_id first). Each batch is merge-anti-joined with the runs:
a hash not in them is new and its largest doc_id becomes its keeper; a known
hash only adds its count. The batch's own run goes to level 0; when a level has
`fanout` runs they are compacted into one run of the next level, so a hash is
rewritten once per level.

Defined results: a null or empty text is one empty line. Rows without doc_id
count as documents older than all others; a line that only they hold is kept in
all of them. Every row counts as one document, repeated rows too. Keys shorter
than `min_chars` are never dropped. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.llm.common import BLANKS, ascii_lower, keep, text_id

MIN_CHARS = 20   # shorter keys are never dropped
MIN_DOCS = 3     # a line in at least so many documents is boilerplate
BATCHES = 4
FANOUT = 3
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(key: str) -> list[Column]:
    return [F.xxhash64(F.col(key)).alias("h1"), F.xxhash64(F.lit(7), F.col(key)).alias("h2")]


class LineRuns:
    """The levels. `add` takes batches newest first."""

    def __init__(self, fanout: int = FANOUT, min_chars: int = MIN_CHARS):
        self.fanout, self.min_chars = fanout, min_chars
        self.levels: list[list[DataFrame]] = []

    def _all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def batch_run(self, docs: DataFrame) -> DataFrame:
        """One row per line hash of a batch: documents and largest doc_id."""
        keys = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), line_key),
                                         lambda k: F.length(k) >= self.min_chars))
        return (docs.select("doc_id", F.explode(keys).alias("key"))
                .select("doc_id", *_hashes("key"))
                .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"),
                                   F.max("doc_id").alias("keeper")))

    def add(self, docs: DataFrame) -> DataFrame:
        """Merge-anti-join a batch with the runs, add its run; returns that run."""
        own, held = self.batch_run(docs), self._all()
        if held:
            known = held[0].select(*KEY)
            for run in held[1:]:
                known = known.unionAll(run.select(*KEY))
            known = known.hint("merge")
            new = own.join(known, KEY, "left_anti")
            seen = own.join(known, KEY, "left_semi").withColumn("keeper", F.lit(None).cast("long"))
            own = new.unionByName(seen)
        run = keep(own.sortWithinPartitions(*KEY), "line-run")
        self._push(run, 0)
        return run

    def _push(self, run: DataFrame, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = keep(self._merge(self.levels[level]).sortWithinPartitions(*KEY), "line-run")
            self.levels[level] = []
            self._push(merged, level + 1)

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        every = runs[0]
        for run in runs[1:]:
            every = every.unionByName(run)
        return every.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"),
                                       F.max("keeper").alias("keeper"))

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """Hashes of lines in at least `min_docs` documents, with their keeper."""
        return (self._merge(self._all())
                .where((F.col("n_docs") >= min_docs) & F.col("keeper").isNotNull())
                .select(*KEY, "keeper"))


def newest_first(docs: DataFrame, batches: int) -> list[DataFrame]:
    """Cut a table into doc_id ranges of about equal size, largest ids first."""
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)
                      if batches > 1 else []))
    edges = [None, *[int(c) for c in cuts], None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        rule = F.lit(True) if high is None else F.col("doc_id") <= high
        rule = rule if low is None else rule & (F.col("doc_id") > low)
        if low is None:
            rule = F.col("doc_id").isNull() | rule
        parts.append(docs.where(rule))
    return parts[::-1]


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT,
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of docs, with text as it stays, plus `_n_lines`, `_n_dropped`."""
    runs = LineRuns(fanout, min_chars)
    for batch in newest_first(docs.select("doc_id", "text"), batches):
        runs.add(batch)
    repeated = keep(runs.repeated(min_docs), "line-repeated")

    keyed = (docs.select("doc_id", text_id().alias("_t"),
                         F.posexplode(F.transform(_lines(F.col("text")), line_key)))
             .where(F.length("col") >= min_chars)
             .select("doc_id", "_t", "pos", *_hashes("col")))
    dropped = (keyed.join(repeated, KEY)
               .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
               .groupBy(F.col("doc_id").alias("_d"), "_t")
               .agg(F.collect_set("pos").alias("_gone"))
               .withColumnRenamed("_t", "_g"))
    # The split text goes through the join, so that it is split once per row.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_row"),
                       F.col("doc_id").alias("_i"), text_id().alias("_t"),
                       _lines(F.col("text")).alias("_lines"))
    joined = rows.join(dropped, F.col("_i").eqNullSafe(F.col("_d"))
                       & (F.col("_t") == F.col("_g")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    text = F.array_join(F.when(F.col("_gone").isNull(), F.col("_lines"))
                        .otherwise(F.transform(stay, lambda i: F.get(F.col("_lines"), i))), "\n")
    out = joined.select("_row", text.alias("text"), F.size("_lines").cast("long").alias("_n_lines"),
                        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("_n_dropped"))
    return out.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns],
                      "_n_lines", "_n_dropped")


def line_dedup_digest(docs: DataFrame, **settings) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"), **settings)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"),
                      F.col("_n_dropped").alias("n_dropped"),
                      F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
