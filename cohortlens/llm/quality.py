"""Quality rules: hashed n-gram log-likelihood ratio against a trusted corpus.

Words and word pairs of every document are hashed into `BUCKETS` buckets. One
multinomial is counted over all documents (raw corpus), one over trusted
documents; both are smoothed. A document's score is the sum of
log(trusted / raw) over its n-grams divided by their number. Every document with
a score of at least the threshold stays, if the base rules do not reject it;
nothing is drawn at random.

The trusted side is fitted on at most `TRUSTED_DOCS` labelled documents, taken
in the order of a hash of their id; that bound makes it safe to send the ids and the
two count vectors to every task. Half of them are counted, the others only scored:
the threshold is `MARGIN` below the `LOWEST` quantile of their scores, so a small or
uneven trusted set, which lowers the scores of good documents too, lowers it as well.
The raw side counts every document.

Defined results: a null or empty text has no words, fails the base rules and is
rejected. Documents without an n-gram, or a corpus without trusted documents,
score 0; without held-out trusted documents the threshold is `MARGIN` below 0. Repeated rows are counted and judged each. Equal 8-word windows are
found by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm import kernel

BUCKETS = 1 << 16
TRUSTED_DOCS = 20_000
SMOOTHING = 1.0
LOWEST, MARGIN = 0.001, 0.05
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
BASE = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
        " n_repeat_words long, score double")


def _features(words: kernel.Words, h: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Row and buckets of its words and word pairs."""
    pairs, to = kernel.grams(h, words.first, 2)
    one, two = (h % kernel.U(BUCKETS)).astype(np.int64), (pairs % kernel.U(BUCKETS)).astype(np.int64)
    for k in range(len(words.first) - 1):
        yield k, np.concatenate([one[words.first[k]:words.first[k + 1]], two[to[k]:to[k + 1]]])


def _among(batch: pa.RecordBatch, ids: np.ndarray) -> np.ndarray:
    doc = batch.column("doc_id")
    return np.isin(doc.fill_null(0).to_numpy(zero_copy_only=False), ids) & doc.is_valid().to_numpy(zero_copy_only=False)


def _count(trusted: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, at = kernel.text_bytes(batch.column("text"))
            is_good = _among(batch, trusted)
            for i, j in kernel.pieces(at):
                words = kernel.Words(data, at[i:j + 1])
                for k, f in _features(words, words.hashes()):
                    if is_good[i + k]:
                        good += np.bincount(f, minlength=BUCKETS)
                    else:
                        np.add.at(raw, f, 1)
        raw += good
        b = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(raw[b]), pa.array(good[b])],
                                         ["bucket", "raw", "good"])
    return run


def _repeats(words: kernel.Words, h: np.ndarray) -> np.ndarray:
    """Per text: words inside windows that the text holds at least twice."""
    w, to = kernel.grams(h, words.first, WINDOW)
    n = len(words.first) - 1
    cover = np.zeros(len(h) + 1, np.int64)
    if len(w):
        row = np.repeat(np.arange(n, dtype=np.uint64), np.diff(to))
        key = kernel.mix(w ^ kernel.mix(row, 3))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(w), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = np.flatnonzero(twice)
        at = at + (words.first[:-1] - to[:-1])[row[at].astype(np.int64)]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + WINDOW, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return inside[words.first[1:]] - inside[words.first[:-1]]


def _dup_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.strip():  # bytes.strip() takes exactly the six ASCII blanks
            n += line in seen
            seen.add(line)
    return n


def _judge(ratio: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = kernel.text_bytes(batch.column("text"))
            n = len(at) - 1
            out = np.zeros((5, n), np.int64)
            score = np.zeros(n)
            for i, j in kernel.pieces(at):
                words = kernel.Words(data, at[i:j + 1])
                h = words.hashes()
                out[0, i:j], out[4, i:j] = np.diff(words.first), _repeats(words, h)
                letter = words.solid & ((words.data & 0xC0) != 0x80)
                symbol = _SYMBOL[words.data]
                for k in range(j - i):
                    a, b = words.at[k], words.at[k + 1]
                    out[1, i + k] = np.count_nonzero(letter[a:b])
                    out[2, i + k] = np.count_nonzero(symbol[a:b])
                    out[3, i + k] = _dup_lines(words.data[a:b].tobytes())
                for k, f in _features(words, h):
                    score[i + k] = ratio[f].sum() / len(f) if len(f) else 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x) for x in out], pa.array(score)],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"])
    return run


def _held_out(ids: np.ndarray, ratio: np.ndarray):
    judging = _judge(ratio)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from judging([batch.filter(pa.array(_among(batch, ids)))])
    return run


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def fit(docs: DataFrame, trusted: DataFrame, trusted_docs: int = TRUSTED_DOCS) -> tuple[np.ndarray, float]:
    """log(trusted / raw) of every bucket, and the threshold. trusted: doc_id."""
    rows = (trusted.where("doc_id is not null").select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_docs).collect())
    ids = np.array([r[0] for r in rows], np.int64)
    counted, held = np.sort(ids[::2]), np.sort(ids[1::2])
    texts = docs.select("doc_id", "text")
    counts = (texts.mapInArrow(_count(counted), "bucket long, raw long, good long")
              .groupBy("bucket").agg(F.sum("raw"), F.sum("good")).collect())
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for b, r, g in counts:
        raw[b], good[b] = r, g
    if not good.sum():
        return np.zeros(BUCKETS), -MARGIN
    p, q = good + SMOOTHING, raw + SMOOTHING
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    lowest = (texts.mapInArrow(_held_out(held, ratio), BASE).where(~_base_failed())
              .agg(F.percentile("score", LOWEST)).first()[0])
    return ratio, (lowest or 0.0) - MARGIN


def judge(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, counts, score, base_failed and kept of every row of docs."""
    ratio, threshold = fit(docs, trusted)
    return (docs.select("doc_id", "text").mapInArrow(_judge(ratio), BASE)
            .withColumn("base_failed", _base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Labelled as good and not as toxic."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")


def filter_documents(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows of docs that stay, all columns. The text is judged where it is read."""
    ratio, threshold = fit(docs, trusted)
    judging, schema = _judge(ratio), docs.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in judging([batch]):
                n = found.column("n_words").to_numpy()
                ok = (n >= MIN_WORDS) & (100 * found.column("n_repeat_words").to_numpy() <= MAX_REPEAT_PERCENT * n)
                yield batch.filter(pa.array(ok & (found.column("score").to_numpy() >= threshold)))
    return docs.mapInArrow(run, schema)


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, trusted_ids(labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("score", 6).alias("score"))
