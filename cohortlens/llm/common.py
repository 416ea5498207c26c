"""Helpers shared by the operators: kept tables and SQL snippets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.functions.staging import new_path

# The white space and letters that the word and key rules name.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def keep(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write once to the shared checkpoint folder and read from there.

    Cuts lineage: a lost executor costs a re-read. Nothing is cached locally.
    """
    spark = df.sparkSession
    path = new_path(spark, f"llm-{name}")
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else. `lower` is faster and equal on pure ASCII."""
    return (F.when(F.length(c) == F.octet_length(c), F.lower(c))
            .otherwise(F.translate(c, UPPER, UPPER.lower())))


def text_id() -> Column:
    """Hash of the text: with doc_id it tells rows apart; equal rows share it."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def unused(df: DataFrame, name: str) -> str:
    """`name`, or with underscores before it where df has such a column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
