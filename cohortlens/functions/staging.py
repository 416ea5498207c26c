"""Stage tables: results that several later steps read are written once.

A stage is a Parquet table in the folder the cluster names in
`spark.checkpoint.dir`, so a lost executor costs a re-read, never a rebuild of
the fact aggregate, and later scans still get column pruning and pushdown.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# Largest side, in bytes of its values, that may be shipped to every executor.
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Stage:
    df: DataFrame
    rows: int
    path: str


def stage_root(spark: SparkSession) -> str:
    """Shared scratch folder of this cluster; a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlens-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/") + "/cohortlens"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, name: str) -> Stage:
    """Write once, read many. The row count comes from the Parquet footers."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    return Stage(table, table.count(), path)


def _bytes(df: DataFrame) -> str:
    """SQL: what the rows' values take, with some bytes per value and row."""
    values = [f"coalesce(octet_length(`{c}`), 0) + 16" if kind in ("string", "binary") else "16" for c, kind in df.dtypes]
    return f"coalesce(sum({' + '.join(values)} + 32L), 0L)"


def small_sides(df: DataFrame, group: str, limit: int = BROADCAST_BYTES) -> Callable[[DataFrame, str], DataFrame]:
    """Measures the groups of df; the result adds a broadcast hint to a join side made of one
    group if its bytes fit. The groups must be few (columns)."""
    sizes = dict(df.groupBy(group).agg(F.expr(f"{_bytes(df)} AS bytes")).collect())
    return lambda side, of: F.broadcast(side) if sizes.get(of, 0) <= limit else side


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a side whose bytes were measured; no hint beyond the limit.

    Without the hint the join is planned by size: AQE picks the strategy and
    splits skewed partitions.
    """
    return F.broadcast(df) if df.agg(F.expr(f"{_bytes(df)} AS bytes")).first()["bytes"] <= limit else df


def unpivot_text(df: DataFrame, ids: Iterable[str], columns: Iterable[str],
                 name: str = "demo", value: str = "value") -> DataFrame:
    columns = list(columns)
    typed = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in columns])
    return typed.unpivot(list(ids), columns, name, value)


def unpivot_numbers(df: DataFrame, ids: Iterable[str], columns: Iterable[str],
                    name: str = "column_name", value: str = "x") -> DataFrame:
    columns = list(columns)
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(ids), columns, name, value)
