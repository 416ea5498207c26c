"""Archives written and read back, in splits that cut records anywhere."""

import hashlib
import random

import pytest

from cohortlens.llm import warc

SCHEMA = "page_id long, url string, html string, size int, file string"
FAKE = (warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Type: application/http\r\n"
        "Content-Length: 30\r\n\r\nHTTP/1.1 200 OK\r\n\r\n0123456789a\r\n\r\n")


def make_rows():
    r = random.Random(3)
    rows = []
    for i in range(60):
        html = [None, "", "x" * r.randrange(60, 200), "é" * r.randrange(200, 900), FAKE * r.randrange(1, 4),
                warc.MAGIC * r.randrange(1, 50), "a" * 120 + warc.MAGIC, "WARC/1.1\r" + "b" * r.randrange(99)][r.randrange(8)]
        rows.append((i, r.choice([None, "http://a/b", "http://a/\r\n" + warc.MAGIC + "x: y"]), html))
    # Equal payloads, an equal row, rows without an id, a long page.
    return rows + [(7, "u", "same" * 50), (7, "u", "same" * 50), (9, "u", "same" * 50), (None, "u", "same" * 50),
                   (None, None, "solo" * 40), (500, "u", "w" * 300000 + warc.MAGIC + "z" * 5000)]


ROWS = make_rows()


def expected():
    payloads = [(p, (h or "").encode()) for p, _, h in ROWS]
    first = {}
    for p, b in payloads:
        if len(b) >= 100 and p is not None:
            first[b] = min(first.get(b, p), p)
    out = []
    for p, b in payloads:
        again = b in first and first[b] != p
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "a")
    warc.write_archives(spark.createDataFrame([(*x, 1, "f") for x in ROWS], SCHEMA).repartition(3), path)
    return path


@pytest.mark.parametrize("split", [700, 5000, 128 << 20])
def test_round_trip_in_splits(spark, archives, split):
    names = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        rows = warc.read_archives(spark, archives).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted([(x.page_id, x.payload_bytes, x.payload_digest, x.kind, x.refers_to) for x in rows], key=str) == expected()


def test_records_are_plain_warc(spark):
    text = warc.records(spark.createDataFrame([(4, "http://h/p", "é<p>", 1, "f")], SCHEMA)).first().record
    head, http, payload = text.split("\r\n\r\n")
    assert head.startswith("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:4>\r\n")
    assert int(head.rsplit(" ", 1)[1]) == len((http + "\r\n\r\n" + payload).encode())
    assert payload == "é<p>" and http.endswith("Content-Length: 5")


def test_no_pages(spark):
    assert warc.warc_digest(spark.createDataFrame([], SCHEMA)).count() == 0
