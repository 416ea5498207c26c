"""Training-data pipeline: quality, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of docs. Between stages the rows are written and read again.
Rows, nulls and ties are treated as the operators in cohortlens/llm define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.llm import line_dedup, minhash, mixing, packing, quality
from cohortlens.llm.common import keep


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.filter_documents(docs, quality.trusted_ids(labels))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs).drop("_n_lines", "_n_dropped")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.public_tokenizer())


STAGES = [("quality rules", quality_rules), ("line dedup", dedup_lines), ("near-dedup", near_dedup),
          ("mixing", mix_sources), ("packing", pack_sequences)]

# Hashed scores, signatures and the packing order have no SQL form; tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = keep(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
