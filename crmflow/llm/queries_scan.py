"""Registered queries: secret scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmflow.llm.registry import query, table
from crmflow.llm.secrets import BASE_KINDS, MARKOV, find_secrets, listed, train, training_samples


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, train(training_samples(docs)))
    return found.select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(listed(BASE_KINDS), 256).alias("base_sha256"),
        listed((*BASE_KINDS, MARKOV)).alias("spans"),
    )
