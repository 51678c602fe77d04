"""Registered queries: near duplicates of texts and of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmflow.llm.line_dedup import dedup_lines
from crmflow.llm.parity_join import near_duplicates
from crmflow.llm.registry import query, table


@query("op5_ngram_jaccard_join")
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("bigint").alias("n_lines"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )
