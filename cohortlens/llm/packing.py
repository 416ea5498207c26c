"""Best-fit packing of tokenised documents, bulk-synchronous.

A document is its token ids and one end id. Longer ones than `CAPACITY` are cut into
full pieces, the first piece takes what is left over. Pieces and gaps are sorted by
size; pieces of one length are interchangeable, and so are gaps of one size. So the
sorted ranges are runs: (length, how many) from one distributed count, at most
CAPACITY rows, and (gap, first sequence, how many).

Rounds go down the lengths. In a round all pieces of a length look for their successor
among the gaps (the smallest that holds them); where more pieces than gaps meet, the
lower ranks win and the others go to the next larger gap, or open new sequences. Then
the gaps shrink, and the sweep repeats until the length is placed. A round's result is
a list of rank ranges: ranks r to r + n of a length go to sequences s to s + n at one
offset. Tasks then place their own pieces by rank. Pieces never leave the executors;
the driver holds runs only, whose number is bounded by CAPACITY and the number of
openings, not by the documents.

Defined results: a null or empty text is one end id. Repeated rows are packed each.
Empty tables give empty tables.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortlens.llm.common import keep

CAPACITY = 2048
END_ID = 0
SALTS = 256             # groups that the pieces of one length are ranked in
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

# Letters, digits and blanks of these code points are the same in every Unicode
# version, so both libraries cut them alike.
_PLAIN = re.compile("[^\x00-\u024f\u2010-\u201f]")


class Encoder:
    """Ids as little-endian uint32 bytes: those of the tokenizer file at `path`.

    `ranks` is the same byte-level vocabulary as ranks, for a library that is four
    times as fast; a test holds its ids against the tokenizer's. Texts with other code
    points than `_PLAIN` knows, or that it fails on, go to the tokenizer itself.
    """

    _of: dict[tuple, "Encoder"] = {}

    def __init__(self, path: str, ranks: str, pattern: str, plain: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.other = re.compile("|".join([_PLAIN.pattern, *map(re.escape, added)]))
        with open(ranks, "rb") as file:
            pairs = [line.split() for line in file]
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                                      mergeable_ranks={base64.b64decode(t): int(r) for t, r in pairs})

    @classmethod
    def of(cls, *files: str, plain: bool = False) -> "Encoder":
        if (*files, plain) not in cls._of:
            cls._of[*files, plain] = cls(*files, plain=plain)
        return cls._of[*files, plain]

    def encode(self, text: str) -> bytes:
        if not self.other.search(text):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
            except BaseException as e:  # a panic of its regex engine on extreme runs
                if type(e).__name__ != "PanicException":
                    raise
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _pieces(files: tuple[str, str, str], capacity: int, with_ids: bool):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(*files)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = encoder.encode(text or "") + end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    for k, start in enumerate([0, *range(first, n, capacity)]):
                        size = capacity if k else first
                        raw = ids[4 * start:4 * (start + size)]
                        rows.append((doc, k, start, size, zlib.crc32(raw)) + ((raw,) if with_ids else ()))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names[:len(cols)])
    return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rank ranges (length, first rank, number, first sequence, offset)."""
    gaps: dict[int, list[tuple[int, int]]] = {}   # free space -> runs (first sequence, number)
    sizes: list[int] = []                         # its keys, ascending
    placed, sequences = [], 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                bisect.insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
                took = min(n, left)
                if took < n:
                    leave(gap, first + took, n - took)
            else:
                gap, first = capacity, sequences
                took = -(-left // (capacity // length))
                sequences += took
            placed.append((length, rank, took, first, capacity - gap))
            leave(gap - length, first, took)
            left, rank = left - took, rank + took
    return placed


def _place(ranges: np.ndarray):
    """ranges: rows (length, first rank, number, sequence, offset), sorted."""
    key = ranges[:, 0].astype(np.int64)
    first_of = {int(k): (int(a), int(b)) for k, a, b in zip(
        np.unique(key), np.searchsorted(key, np.unique(key)), np.searchsorted(key, np.unique(key), "right"))}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.empty(len(length), np.int64)
            for n in np.unique(length):
                a, b = first_of[int(n)]
                here = length == n
                at[here] = a + np.searchsorted(ranges[a:b, 1], rank[here], "right") - 1
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(ranges[at, 3] + rank - ranges[at, 1]), pa.array(ranges[at, 4])],
                names + ["sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: tuple[str, str, str], capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset.

    tokenizer: paths of the tokenizer and of its ranks, and its word pattern.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    pieces = keep(docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, capacity, with_ids), schema), "pieces")
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)))
    groups = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    groups = keep(groups, "piece-counts")
    counts = dict(groups.groupBy("length").agg(F.sum("n")).collect())
    ranges = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 5)

    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = groups.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    here = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (salted.withColumn("here", here).join(shift, ["length", "salt"])
              .select(*pieces.columns, (F.col("here") + F.col("shift") - 1).alias("rank")))
    return ranked.mapInArrow(_place(ranges), schema + ", sequence_id long, offset long")


def public_tokenizer() -> tuple[str, str, str]:
    """The public byte-level tokenizer of this machine; executors have it too."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def packing_digest(docs: DataFrame) -> DataFrame:
    return pack(docs, public_tokenizer())
