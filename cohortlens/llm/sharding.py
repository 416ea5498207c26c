"""Sharding by histogram sort (DataFrame functions only): law `bytes`.

Rows are ordered by (hash of the text, doc_id), so equal texts stand together and
a large group of them can still be cut between two ids. Rounds count the exact
bytes below candidate key boundaries in all partitions; each round puts new
probes into the bracket of every splitter that has not met the tolerance. When
all have, the rows are exchanged once, range partitioned by that order, and
numbered within their shard from per-partition counts.

Defined results: a null text has no bytes (size 1) and the checksum of an empty
text; a null doc_id sorts before all others. Rows equal in text and doc_id have
one key and stay in one shard. An empty table gives an empty table.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.llm.common import keep

SHARDS = 8
TOLERANCE = 0.001   # of a shard's share of the bytes
PROBES = 8          # per open splitter and round
WIDE = 1 << 64      # ids below one hash
LOW = -(1 << 63)


def _point(h: int, d: int) -> int:
    return (h - LOW) * WIDE + (d - LOW)


def _pair(p: int) -> tuple[int, int]:
    return p // WIDE + LOW, p % WIDE + LOW


def _reached(points: list[int]) -> Column:
    """How many of the ascending points are at or below the row's key."""
    out = F.lit(0)
    for p in points:
        h, d = _pair(p)
        out = out + F.when((F.col("h") > h) | ((F.col("h") == h) & (F.col("d") >= d)), 1).otherwise(0)
    return out


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                       F.xxhash64(text).alias("h"), F.coalesce("doc_id", F.lit(LOW)).alias("d"))


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
              probes: int = PROBES) -> list[int]:
    """Key points that cut the bytes into equal shares. rows: h, d, size.

    Only counts per probe come to the driver: about (shards - 1) * (probes + 2) a
    round. A splitter that a single row or key holds back ends at its better side.
    """
    sums = [F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n"),
            *[f(c).alias(f.__name__ + c) for f in (F.min, F.max) for c in ("h", "d")]]

    def interval(left: int, below: int, r) -> dict:
        """Keys from `left` on: their bytes, rows, and bounds of the keys that occur."""
        lo, hi = (_point(r["minh"], r["mind"]), _point(r["maxh"], r["maxd"])) if r["n"] else (left, left)
        return {"left": left, "below": below, "bytes": r["bytes"], "n": r["n"], "lo": max(lo, left), "hi": hi}

    parts = [interval(0, 0, rows.agg(*sums).first())]
    total = parts[0]["bytes"]
    targets = [total * i / shards for i in range(1, shards)]
    while True:
        starts = [x["below"] for x in parts]
        chosen, open_parts = [], {}
        for t in targets:
            i = max(bisect.bisect_left(starts, t) - 1, 0)
            x = parts[i]
            after = parts[i + 1]["left"] if i + 1 < len(parts) else x["hi"] + 1
            back, ahead = t - x["below"], x["below"] + x["bytes"] - t
            chosen.append(x["left"] if back <= ahead else after)
            if min(back, ahead) > tolerance * total / shards and x["n"] > 1 and x["hi"] > x["lo"]:
                open_parts[i] = (x, after)
        if not open_parts:
            return chosen
        points, begins = set(), {}
        for x, after in open_parts.values():
            inner = {x["lo"] - (x["lo"] - x["hi"]) * k // (probes + 1) for k in range(1, probes + 1)}
            begins |= {p: x for p in [x["left"], *(inner - {x["left"]})]}
            points |= {after}
        points = sorted(points | set(begins))
        counts = {r["b"]: r for r in rows.groupBy(_reached(points).alias("b")).agg(*sums).collect()}
        none = {"bytes": 0, "n": 0}
        fresh, below = [], {}
        for b, p in enumerate(points, 1):
            if p in begins:
                x = begins[p]
                at = below.setdefault(x["left"], x["below"])
                fresh.append(interval(p, at, counts.get(b, none)))
                below[x["left"]] += fresh[-1]["bytes"]
        parts = sorted([x for i, x in enumerate(parts) if i not in open_parts] + fresh, key=lambda x: x["left"])


def assign(docs: DataFrame, shards: int = SHARDS, **settings) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (from 0, gapless) of every row."""
    rows = keep(keyed(docs), "shard-keys")
    cuts = splitters(rows, shards, **settings)
    sent = (rows.withColumn("shard", _reached(cuts).cast("int"))
            .repartitionByRange("shard", "h", "d").sortWithinPartitions("shard", "h", "d")
            .withColumn("part", F.spark_partition_id())
            .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sent = keep(sent, "shard-rows")
    # One row per partition and shard: partitions before it, and its first row.
    counts = sent.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    starts = counts.selectExpr(
        "shard", "part",
        "coalesce(sum(n) over (partition by shard order by part"
        " rows between unbounded preceding and 1 preceding), 0) - first as shift")
    return (sent.join(starts, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("shift")).alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, **settings) -> None:
    """The documents themselves, one folder per shard, moved by one exchange."""
    cuts = splitters(keep(keyed(docs).select("h", "d", "size"), "shard-keys"), shards, **settings)
    text = F.coalesce(F.col("text"), F.lit(""))
    (docs.withColumns({"h": F.xxhash64(text), "d": F.coalesce("doc_id", F.lit(LOW))})
     .withColumn("shard", _reached(cuts).cast("int"))
     .repartitionByRange("shard", "h", "d").sortWithinPartitions("shard", "h", "d")
     .drop("h", "d").write.partitionBy("shard").parquet(path))


def sharding_digest(docs: DataFrame, **settings) -> DataFrame:
    return assign(docs.select("doc_id", "text"), **settings).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
