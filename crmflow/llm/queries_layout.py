"""Registered queries: sharding and mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmflow.llm.mixing import mixture
from crmflow.llm.registry import query, table
from crmflow.llm.sharding import assign_shards


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_mixing")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
