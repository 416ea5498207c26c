"""Alignment of two tokenizers' tokens, in Arrow.

Tokens of both vocabularies stand for bytes of the same text. A batch of documents is
two list columns of ids. They are flattened with their parent indices; byte lengths taken
from the vocabulary and summed up within each document give every token's end; a hash join
on (document, end) finds the ends that both share. These cut the tokens into groups,
and the two tokens that end there are linked.

Links are written once, as codes of their id pair, in pieces of `PIECE`. A task
counts its own pairs with Table.group_by and Spark adds the partial counts up. What a
document's links count for is then looked up: the most frequent pairs, `COMMON` at most
and so of bounded size, are sent to every task, all others are joined by Spark; a pair
outside the common ones has few links, so no join key is hot.

Defined results: a text that is null or empty, or that either tokenizer does not give
back byte by byte with a space before it, has no tokens: zeros and ''. Repeated rows
are documents of their own, and so are rows without a doc_id. Other columns are not
read. Empty tables give empty tables.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm import kernel
from cohortlens.llm.common import keep
from cohortlens.llm.packing import Encoder

PIECES = "piece_bpe_32k.model"
PIECE = 1 << 16          # links of a document written as one row
COMMON = 1 << 17         # pairs sent to every task, at most
COUNTED = 1 << 20        # links counted or looked up together in a task
TEXT_BYTES = 1 << 19     # text aligned together; a longer text stands alone
END_BITS = 40


@dataclass(frozen=True)
class Files:
    """The byte-level tokenizer (file, ranks, word pattern) and the piece model."""
    tokenizer: str
    ranks: str
    pattern: str
    pieces: str


class Vocabularies:
    """Both tokenizers and the bytes of their entries."""

    _of: dict[Files, "Vocabularies"] = {}

    def __init__(self, files: Files):
        import sentencepiece

        self.a = Encoder.of(files.tokenizer, files.ranks, files.pattern, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        with open(files.ranks, "rb") as file:
            ranks = dict((int(r), base64.b64decode(t)) for t, r in (line.split() for line in file))
        self.bytes_a = _table([ranks.get(i, b"") for i in range(max(ranks) + 2)])
        self.bytes_b = _table([self._entry(i) for i in range(self.b.vocab_size())])
        self.size_a, self.size_b = (pc.binary_length(x).cast(pa.int64()) for x in (self.bytes_a, self.bytes_b))
        n = [len(self.bytes_a), len(self.bytes_b)]
        # Decimal ids as they stand in the digest: inside a group and at its end.
        self.written = _table([f"{i}{end}".encode() for k, last in ((0, "|"), (1, ";")) for i in range(n[k]) for end in (",", last)])

    def _entry(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    @classmethod
    def of(cls, files: Files) -> "Vocabularies":
        if files not in cls._of:
            cls._of[files] = cls(files)
        return cls._of[files]

    def encode(self, texts: list[str]) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        raw = [self.a.encode(" " + t) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])])
        ids = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
        return (pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids)),
                pa.array(self.b.encode(texts, num_threads=1) if texts else [], pa.large_list(pa.int32())))


def _table(entries: list[bytes]) -> pa.Array:
    return pa.array(entries, pa.large_binary())


def _data(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column made by take."""
    _, offsets, data = x.buffers()
    at = np.frombuffer(offsets, np.int64)[x.offset:x.offset + len(x) + 1] if len(x) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def _faithful(ids: pa.LargeListArray, entries: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Which documents' tokens joined are the text."""
    data, at = _data(entries.take(ids.values))
    ends = at[np.asarray(ids.offsets, np.int64)]
    size = np.array([len(t) for t in texts], np.int64)
    same = np.diff(ends) == size
    return np.array([ok and data[i:j].tobytes() == t for ok, i, j, t in zip(same, ends[:-1], ends[1:], texts)], bool)


def _ends(ids: pa.LargeListArray, sizes: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Flat ids, their documents, and one key per token: document and byte end in it."""
    flat, parent = ids.flatten(), pc.list_parent_indices(ids).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], pc.cumulative_sum(sizes.take(flat)).to_numpy(zero_copy_only=False)])
    first = np.asarray(ids.offsets, np.int64)[:-1]
    return flat, parent, (parent << END_BITS) + total[1:] - total[first][parent]


def _shared(key_a: np.ndarray, key_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the tokens whose keys are equal, in order."""
    a = pa.table({"key": key_a, "i": np.arange(len(key_a))})
    b = pa.table({"key": key_b, "j": np.arange(len(key_b))})
    both = a.join(b, "key", join_type="inner", use_threads=False)
    i, j = both.column("i").to_numpy(), both.column("j").to_numpy()
    order = np.lexsort((j, i))
    return i[order], j[order]


@dataclass
class Aligned:
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    sha: list[str]
    codes: np.ndarray       # of all links, document by document


def align(words: Vocabularies, texts: list[str]) -> Aligned:
    """Tokens, groups and links of non-empty texts; none where bytes differ."""
    a, b = words.encode(texts)
    spaced = [b" " + t.encode() for t in texts]
    good = _faithful(a, words.bytes_a, spaced) & _faithful(b, words.bytes_b, spaced)
    if not good.all():
        a, b = (pa.array([x if ok else [] for x, ok in zip(ids.to_pylist(), good)], ids.type) for ids in (a, b))
    n = len(texts)
    flat_a, doc_a, key_a = _ends(a, words.size_a)
    flat_b, doc_b, key_b = _ends(b, words.size_b)
    i, j = _shared(key_a, key_b)
    ids_a, ids_b = flat_a.to_numpy(zero_copy_only=False).astype(np.int64), flat_b.to_numpy(zero_copy_only=False).astype(np.int64)
    # The last token of each side at a shared end closes a group.
    close_a, close_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    close_a[i], close_b[j] = True, True
    close_a[:-1] &= key_a[:-1] != key_a[1:]
    close_b[:-1] &= key_b[:-1] != key_b[1:]
    upto_a, upto_b = np.flatnonzero(close_a) + 1, np.concatenate([[0], np.flatnonzero(close_b) + 1])
    group_a, group_b = np.cumsum(close_a) - close_a, np.cumsum(close_b) - close_b
    # The tokens of a group, first side first, in their place among all tokens.
    written = np.empty(len(ids_a) + len(ids_b), np.int64)
    written[np.arange(len(ids_a)) + upto_b[group_a]] = 2 * ids_a + close_a
    if len(ids_b):
        written[np.arange(len(ids_b)) + upto_a[group_b]] = 2 * (len(words.bytes_a) + ids_b) + close_b
    data, at = _data(words.written.take(pa.array(written)))
    cuts = at[np.asarray(a.offsets, np.int64) + np.asarray(b.offsets, np.int64)]
    sha = [hashlib.sha256(data[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    count = lambda x: np.bincount(x, minlength=n).astype(np.int64)
    return Aligned(count(doc_a), count(doc_b), count(doc_a[close_a]), count(doc_a[i]), sha, ids_a[i] * len(words.bytes_b) + ids_b[j])


_DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _aligned(files: Files, pair: str):
    """Rows of documents and their links: row (number of the document), the digest's columns
    in its first piece, links."""
    names = ["row", *[f.split(" ")[0] for f in _DIGEST.split(", ")], "links"]
    types = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.int32() if pair == "int" else pa.int64())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = Vocabularies.of(files), TaskContext.get().partitionId() << 40
        for batch in batches:
            _, ends = kernel.text_bytes(batch.column("text"))
            for lo, hi in kernel.pieces(ends, TEXT_BYTES):
                ids = batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                texts = [t or "" for t in batch.column("text").slice(lo, hi - lo).to_pylist()]
                full = [k for k, t in enumerate(texts) if t]
                out = align(words, [texts[k] for k in full])
                place = dict(zip(full, range(len(full))))
                cut = np.concatenate([[0], np.cumsum(out.n_links)])
                rows, spans = [], [0]
                for k, doc in enumerate(ids):
                    x = place.get(k)
                    told = (0, 0, 0, 0, "") if x is None else (int(out.n_a[x]), int(out.n_b[x]), int(out.n_groups[x]), int(out.n_links[x]), out.sha[x])
                    a, b = (spans[-1],) * 2 if x is None else (int(cut[x]), int(cut[x + 1]))
                    for at in range(a, max(b, a + 1), PIECE):
                        rows.append((row, doc, *(told if at == a else (None,) * 5)))
                        spans.append(min(b, at + PIECE))
                    row += 1
                links = pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pa.array(out.codes, types[-1].value_type))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] + [links], names)
    return run


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about COUNTED links; one row has PIECE at most."""
    ends = np.asarray(batch.column("links").offsets, np.int64)
    for lo, hi in kernel.pieces(ends, COUNTED):
        yield batch.slice(lo, hi - lo)


def _partial_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each pair occurs in some of the task's links."""
    held, size = [], 0

    def counted():
        links = pa.table({"pair": pa.chunked_array(held)})
        done = links.group_by("pair", use_threads=False).aggregate([("pair", "count")]).rename_columns(["pair", "n"])
        return done.cast(pa.schema([("pair", pa.int64()), ("n", pa.int64())])).combine_chunks().to_batches()

    for batch in batches:
        for part in _slices(batch):
            held.append(part.column("links").flatten())
            size += len(held[-1])
            if size >= COUNTED:
                yield from counted()
                held, size = [], 0
    if size:
        yield from counted()


def _looked_up(common):
    """Sums over the links among the common pairs (sorted pairs, counts, best); the rest as a list."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = common.value
        for batch in (part for whole in batches for part in _slices(whole)):
            links = batch.column("links")
            code = links.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = pc.list_parent_indices(links).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(pairs, code), max(len(pairs) - 1, 0))
            hit = pairs[at] == code if len(pairs) else np.zeros(len(code), bool)
            total, top = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
            np.add.at(total, row[hit], counts[at[hit]])
            np.add.at(top, row[hit], best[at[hit]])
            rest = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=len(links)))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(total), pa.array(top), pa.ListArray.from_arrays(pa.array(rest, pa.int32()), pa.array(code[~hit]))],
                ["row", "count_sum", "n_best", "rest"])
    return run


def _common(pairs: DataFrame, limit: int) -> tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The least power of two from which at most `limit` pairs count, and those pairs."""
    held = {r["k"]: r["n"] for r in pairs.groupBy(F.floor(F.log2("n")).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    k, total = 63, 0
    while k > 0 and total + held.get(k - 1, 0) <= limit:
        k -= 1
        total += held.get(k, 0)
    found = pairs.where(F.floor(F.log2("n")) >= k).toArrow()
    code = found.column("pair").to_numpy()
    order = np.argsort(code)
    return k, (code[order], found.column("n").to_numpy()[order], found.column("top").to_numpy().astype(np.int64)[order])


def aligned(docs: DataFrame, files: Files, common: int = COMMON) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    words = Vocabularies.of(files)
    n_b = len(words.bytes_b)
    pair = "int" if len(words.bytes_a) * n_b < 1 << 31 else "long"
    table = keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .mapInArrow(_aligned(files, pair), f"row long, {_DIGEST}, links array<{pair}>"), "alignment", "zstd")
    links = table.where(F.size("links") > 0)
    counts = keep(links.select("links").mapInArrow(_partial_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    # One row per id of the second vocabulary.
    best = F.broadcast(counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("best")))
    pairs = keep(counts.withColumn("b", F.col("pair") % n_b).join(best, "b").select("pair", "n", F.expr("cast(n = best as long)").alias("top")), "pairs")
    least, frequent = _common(pairs, common)
    looked = keep(links.select("row", "links").mapInArrow(_looked_up(spark.sparkContext.broadcast(frequent)),
                                                          "row long, count_sum long, n_best long, rest array<long>"), "looked-up", "zstd")
    rare = (looked.where(F.size("rest") > 0).select("row", F.explode("rest").alias("pair"))
            .join(pairs.where(F.floor(F.log2("n")) < least), "pair").select("row", F.col("n").alias("count_sum"), F.col("top").alias("n_best")))
    names = [f.split(" ")[0] for f in _DIGEST.split(", ")]
    blank = [F.lit(None).cast(t).alias(c) for c, t in table.dtypes if c in names]
    told = table.where("n_a is not null").select("row", *names, F.lit(0).cast("long").alias("count_sum"), F.lit(0).cast("long").alias("n_best"))
    sums = looked.select("row", "count_sum", "n_best").unionByName(rare).select("row", *blank, "count_sum", "n_best")
    return (told.unionByName(sums).groupBy("row")
            .agg(*[F.max(c).alias(c) for c in names], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def public_files() -> Files:
    """The public vocabularies of this machine; executors have them too."""
    import public_tokenizers as p

    from cohortlens.llm.packing import public_tokenizer

    return Files(*public_tokenizer(), p.path(PIECES))


def alignment_digest(docs: DataFrame) -> DataFrame:
    return aligned(docs, public_files())
