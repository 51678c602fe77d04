"""From raw documents to a mixed, sharded training set, one operator per stage.

Every stage works on all rows that the one before kept and is written before the next reads
it. All stages but the last return the columns of their input; the last adds the shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crmflow.llm.decontaminate import drop_contaminated
from crmflow.llm.mixing import mix_sources
from crmflow.llm.parity_join import drop_near_duplicates
from crmflow.llm.quality import drop_repetitive
from crmflow.llm.registry import prepare_session, table
from crmflow.llm.sharding import add_shard
from crmflow.storage import materialize

SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the rules on length and repetition."""
    prepare_session(spark)
    return drop_repetitive(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near duplicates."""
    prepare_session(spark)
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a phrase of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and thins out documents so that the sources come near their targets."""
    prepare_session(spark)
    return mix_sources(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each document; equal texts share one."""
    prepare_session(spark)
    return add_shard(docs, SHARDS)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: Hashes choose copies and shards, which SQL on another engine cannot repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
