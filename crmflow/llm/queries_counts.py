"""Registered queries: token counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmflow.llm.registry import query, table
from crmflow.llm.token_counts import TokenRollup, change, count_tokens
from crmflow.storage import materialize, scratch_path

TOKENIZERS = {
    "byte_bpe_50k": "file:///opt/tokenizers/byte_bpe_50k.tiktoken",
    "byte_bpe_multi_50k": "file:///opt/tokenizers/byte_bpe_multi_50k.tiktoken",
}


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str, tokenizers: dict[str, str] = TOKENIZERS) -> DataFrame:
    """Totals after four commits: all documents; a new tokenizer for languages other than
    English; that commit again; and the removal of texts that equal one of a smaller id."""
    docs = table(spark, sf_dir, "documents").withColumn("text_key", F.xxhash64("text"))
    old, new = tokenizers
    keep = ("doc_id", "source", "lang", "text_key")
    english = F.col("lang").eqNullSafe("en")
    first = count_tokens(docs.filter(english), {old: tokenizers[old]}, keep=keep)
    both = count_tokens(docs.filter(~english), tokenizers, keep=keep)
    counted = materialize(
        first.withColumn(new, F.lit(None).cast("bigint")).unionByName(both), "token-counts"
    )
    moved = counted.filter(~english)
    copied = counted.groupBy(F.col("text_key").alias("copied")).agg(F.min("doc_id").alias("first"))
    gone = counted.join(copied, F.col("text_key") == F.col("copied")).filter("doc_id > first")

    rollup = TokenRollup(spark, scratch_path(spark, "token-rollup"))
    revision = change(moved, -1, old, F.col(old)).unionAll(change(moved, 1, new, F.col(new)))
    rollup.commit(1, change(counted, 1, old, F.col(old)))
    rollup.commit(2, revision)
    rollup.commit(2, revision)
    removal = change(gone.filter(english), -1, old, F.col(old))
    rollup.commit(3, removal.unionAll(change(gone.filter(~english), -1, new, F.col(new))))
    return rollup.totals()
