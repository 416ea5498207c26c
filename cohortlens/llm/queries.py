"""One registered query per operator, over its whole table, and the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import alignment, chat, embeddings, line_dedup, minhash, mixing, packing, pii, quality, sharding, trie, urls, warc


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": lambda s, d: line_dedup.line_dedup_digest(table(s, d, "documents")),
    "op2_quality": lambda s, d: quality.quality_digest(table(s, d, "documents"), table(s, d, "labels")),
    "op3_chat": lambda s, d: chat.chat_digest(table(s, d, "conversations")),
    "op4_minhash": lambda s, d: minhash.minhash_digest(table(s, d, "documents")),
    "op5_pii": lambda s, d: pii.pii_digest(table(s, d, "documents")),
    "op6_sharding": lambda s, d: sharding.sharding_digest(table(s, d, "documents")),
    "op7_urls": lambda s, d: urls.urls_digest(table(s, d, "pages"), table(s, d, "labels")),
    "op8_embeddings": lambda s, d: embeddings.embeddings_digest(table(s, d, "embeddings")),
    "op9_mixing": lambda s, d: mixing.mixing_digest(table(s, d, "documents")),
    "op10_packing": lambda s, d: packing.packing_digest(table(s, d, "documents")),
    "op11_trie": lambda s, d: trie.trie_digest(table(s, d, "conversations")),
    "op12_warc": lambda s, d: warc.warc_digest(table(s, d, "pages")),
    "op13_alignment": lambda s, d: alignment.alignment_digest(table(s, d, "documents")),
}
