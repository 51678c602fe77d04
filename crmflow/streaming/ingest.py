"""Ingest CSV files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from crmflow.sources.tables import add_lineage


def csv_stream(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Stream of the rows of new CSV files below ``path``, with lineage columns."""
    raw = (
        spark.readStream.option("header", True)
        .option("recursiveFileLookup", True)
        .schema(schema)
        .csv(path)
    )
    return add_lineage(raw, F.col("_metadata.file_path"))


def append_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to a Parquet table, then stop.

    A restart with the same checkpoint goes on behind the last finished batch, so
    each file is written once.
    """
    return (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("_ingestion_date")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
