"""WARC archives: written by Spark's text writer, read back in splits of any place.

Writing: every page becomes one record whose block is an HTTP response. Of records with
equal payloads of `SHARED_BYTES` or more, those with the smallest page_id are responses
and the others revisits, which hold the HTTP head only and name the response.

Reading: a split task cuts its bytes at every occurrence of the magic line, also at
those inside payloads, and emits a candidate for each that has a record's header: its
offset and, from Content-Length, the offset of its successor. Offsets of a split
start at 0; the bytes of the splits before it place them in the file.

Verification: a split's candidates are chained inside the split, so each knows where its
chain leaves the split (its exit). Exits and the starts of files are the ports; pointer
jumping over ports, twice as far in each round, finds those that the start of a file
reaches. Every split is entered at most once; from there its chain is walked, and only
candidates on it are records. Magic inside a payload is never on the chain. A payload
that holds magic lies in several pieces, which are put together again.

Defined results: a null html is an empty payload; a null url is left out of the header,
line ends in it are percent-encoded; rows of one page_id are records of their own, and all
rows with the smallest page_id of a payload are responses. A null page_id counts as
larger than any other. Other columns are not read. Empty tables give empty archives.
A file that does not begin with the magic, or whose chain breaks, yields the records
up to the break.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortlens.functions.staging import new_path
from cohortlens.llm.common import keep

# Fixed values of the format.
MAGIC, BREAK, CLOSE = "WARC/1.1\r\n", "\r\n\r\n", "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SHARED_BYTES = 100
GRID = 1 << 20          # bytes of a cell in which pieces look for their record


def records(pages: DataFrame, shared: int = SHARED_BYTES) -> DataFrame:
    """page_id, record: the text of a WARC record without its closing line ends."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html")).withColumns(
        {"size": F.octet_length("html"), "digest": F.sha2(F.col("html").cast("binary"), 256)})
    # Written before it is joined, so that a short list never makes the pages move.
    first = keep(rows.where(f"size >= {shared}").groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1 and first is not null").drop("n"), "warc-first")
    rows = rows.join(first, "digest", "left").withColumn("refers", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    kind = F.when(F.col("refers").isNull(), "response").otherwise("revisit")
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit(BREAK))
    body = F.when(F.col("refers").isNull(), F.col("html")).otherwise("")
    lines = F.concat(
        F.lit(MAGIC + "WARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), name("page_id"), F.lit(f"\r\nWARC-Date: {DATE}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.when(F.col("refers").isNull(), "").otherwise(F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name("refers"))),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"), F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.length(head) + F.octet_length(body)).cast("string"), F.lit(BREAK))
    return rows.select("page_id", F.concat(lines, head, body).alias("record"))


def write_archives(pages: DataFrame, path: str, shared: int = SHARED_BYTES) -> None:
    """Plain WARC files, as many as there are tasks; the text writer's line end closes a record."""
    records(pages, shared).select("record").write.option("lineSep", CLOSE).text(path)


_PIECE = ("file string, split long, at long, size long, length long, body long, kind string, page_id long, refers_to long,"
          " payload_bytes long, payload_digest string")
_PIECE_NAMES = [f.split(" ")[0] for f in _PIECE.replace(", ", ",").split(",")]
_HEADER = re.compile(rb"(?:[!-9;-~]+:[^\r\n]*\r\n)+\r\n")
_FIELD = re.compile(rb"(?:^|\r\n)([!-9;-~]+):[ \t]*([^\r\n]*)")


def _id(raw: bytes | None) -> int | None:
    m = re.fullmatch(rb"<urn:page:(-?\d+)>", raw or b"")
    return int(m[1]) if m else None


def parse(piece: bytes, magic: bytes) -> dict | None:
    """What the record starting with this piece (magic, then text up to the next magic) says;
    None if it has no header. Digest and size of the payload only if the piece holds it."""
    found = _HEADER.match(piece)
    if not found:
        return None
    field = {k.lower(): v for k, v in _FIELD.findall(found[0])}
    if not re.fullmatch(rb"\d{1,18}", field.get(b"content-length", b"")):
        return None
    head, block = found.end(), int(field[b"content-length"])
    http = piece.find(BREAK.encode(), head, head + block) if field.get(b"content-type", b"").startswith(b"application/http") else -1
    start = head if http < 0 else http + len(BREAK)
    out = {"length": len(magic) + head + block + len(CLOSE), "body": len(magic) + start, "kind": field.get(b"warc-type", b"").decode(errors="replace"),
           "page_id": _id(field.get(b"warc-record-id")), "refers_to": _id(field.get(b"warc-refers-to"))}
    if out["kind"] == "revisit":
        claimed = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d{1,18})\r\n", piece[head:start])
        out["payload_bytes"] = int(claimed[1]) if claimed else None
        out["payload_digest"] = field.get(b"warc-payload-digest", b"").decode(errors="replace").removeprefix("sha256:")
    elif len(piece) >= head + block:
        payload = memoryview(piece)[start:head + block]
        out["payload_bytes"], out["payload_digest"] = len(payload), hashlib.sha256(payload).hexdigest()
    return out


def _pieces(magic: bytes, content: bool):
    """Pieces of the splits in a task, read in order: file, split, at (offset in the split's
    own bytes), size; with what their header says, or with their content."""
    names = ["file", "split", "at", "size", "content"] if content else _PIECE_NAMES
    types = ([pa.string()] + [pa.int64()] * 3 + [pa.binary()] if content else
             [pa.string()] + [pa.int64()] * 5 + [pa.string()] + [pa.int64()] * 3 + [pa.string()])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = None, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = []
                part = batch.slice(lo, 256)
                for file, split, value in zip(*(part.column(c).to_pylist() for c in ("file", "split", "value"))):
                    if here != (file, split):
                        here, at = (file, split), 0
                        if split == 0:
                            # What stands before the first magic of a file; nothing in a proper one.
                            at = len(value)
                            if value:
                                rows.append({"file": file, "split": split, "at": 0, "size": at, "content": value})
                            continue
                    size = len(magic) + len(value)
                    row = {"file": file, "split": split, "at": at, "size": size}
                    rows.append(row | ({"content": magic + value} if content else parse(value, magic) or {}))
                    at += size
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(names, types)], names)
    return run


def _cut(spark: SparkSession, path: str, magic: str, content: bool = False) -> DataFrame:
    lines = spark.read.option("lineSep", magic).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(_pieces(magic.encode(), content), "file string, split long, at long, size long, content binary" if content else _PIECE)


def _exits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the chain of every candidate leaves its split. Rows come by split, last first."""
    here, exits = None, {}
    for batch in batches:
        left = []
        for file, split, offset, after in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "offset", "after"))):
            if here != (file, split):
                here, exits = (file, split), {}
            exits[offset] = exits.get(after, after)
            left.append(exits[offset])
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("offset"), pa.array(left, pa.int64())], ["file", "offset", "exit"])


def _on_chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates on the chain that enters their split at `entry`. Rows come by split, first first."""
    here, want = None, None
    for batch in batches:
        keep_row = []
        for file, split, offset, after, entry in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "offset", "after", "entry"))):
            if here != (file, split):
                here, want = (file, split), entry
            on = offset == want
            want = after if on else want
            keep_row.append(on)
        yield batch.filter(pa.array(keep_row, pa.bool_()))


def _reached(steps: DataFrame) -> DataFrame:
    """(file, offset) of the ports that offset 0 of a file reaches, by pointer jumping over
    steps (file, offset, exit): reached after 2^k steps, and jumps of 2^k steps."""
    seen, jump = keep(steps.where("offset = 0").select("file", "offset").distinct(), "warc-seen"), steps
    while not jump.isEmpty():
        further = seen.join(jump, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
        seen = keep(seen.unionByName(further).distinct(), "warc-seen")
        then = jump.select("file", F.col("offset").alias("exit"), F.col("exit").alias("then"))
        jump = keep(jump.join(then, ["file", "exit"]).select("file", "offset", F.col("then").alias("exit")), "warc-jump")
    return seen


def read_archives(spark: SparkSession, path: str, magic: str = MAGIC) -> DataFrame:
    """Records of the archives in path: file, offset, length, kind, page_id, refers_to,
    payload_bytes, payload_digest."""
    cut = keep(_cut(spark, path, magic), "warc-pieces")
    # Splits of one file are few: a file over the size of a split.
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = cut.groupBy("file", "split").agg(F.sum("size").alias("bytes")).select(
        "file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    found = (cut.where("length is not null").join(base, ["file", "split"])
             .withColumns({"offset": F.col("base") + F.col("at"), "after": F.col("base") + F.col("at") + F.col("length")}).drop("base"))
    found = keep(found, "warc-candidates")
    exits = keep(found.select("file", "split", "offset", "after").repartition("file", "split")
                 .sortWithinPartitions("file", "split", F.desc("offset")).mapInArrow(_exits, "file string, offset long, exit long"), "warc-exits")
    ports = exits.select("file", F.col("exit").alias("offset")).distinct()
    steps = keep(exits.join(ports, ["file", "offset"], "left_semi").unionByName(exits.where("offset = 0")).distinct(), "warc-ports")
    entries = found.select("file", "split", "offset").join(_reached(steps), ["file", "offset"]).groupBy("file", "split").agg(F.min("offset").alias("entry"))
    true = keep(_chained(found, entries), "warc-records")
    broken = true.where("payload_digest is null")
    names = ["file", "offset", "length", "kind", "page_id", "refers_to", "payload_bytes", "payload_digest"]
    if broken.isEmpty():
        return true.select(*names)
    return true.where("payload_digest is not null").select(*names).unionByName(_together(_cut(spark, path, magic, True), base, broken).select(*names))


def _chained(found: DataFrame, entries: DataFrame) -> DataFrame:
    rows = found.join(entries, ["file", "split"])
    return rows.repartition("file", "split").sortWithinPartitions("file", "split", "offset").mapInArrow(_on_chain, rows.schema).drop("entry")


def _together(pieces: DataFrame, base: DataFrame, broken: DataFrame) -> DataFrame:
    """Records whose payload holds magic, with the digest of their pieces put together."""
    placed = pieces.join(base, ["file", "split"]).withColumn("offset", F.col("base") + F.col("at"))
    cells = broken.select("file", F.col("offset").alias("start"), "after", "body", "length", F.explode(F.sequence(
        F.floor(F.col("offset") / GRID), F.floor((F.col("after") - 1) / GRID))).alias("cell"))
    mine = (placed.withColumn("cell", F.floor(F.col("offset") / GRID)).join(cells, ["file", "cell"])
            .where("offset >= start and offset < after").groupBy("file", "start", "body", "length")
            # A record's pieces are one payload, which is one value anyway.
            .agg(F.array_sort(F.collect_list(F.struct("offset", "content"))).alias("parts")))
    told = (mine.select("file", F.col("start").alias("offset"), "body", "length", F.col("parts.content").alias("parts"))
            .mapInArrow(_joined, "file string, offset long, payload_bytes long, payload_digest string"))
    return broken.drop("payload_bytes", "payload_digest").join(told, ["file", "offset"])


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests = [], []
        for body, length, parts in zip(*(batch.column(c) for c in ("body", "length", "parts"))):
            payload = memoryview(b"".join(parts.as_py()))[body.as_py():length.as_py() - len(CLOSE)]
            sizes.append(len(payload))
            digests.append(hashlib.sha256(payload).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("offset"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                         ["file", "offset", "payload_bytes", "payload_digest"])


def warc_digest(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")
