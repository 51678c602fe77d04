"""Registered queries: quality rules and benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmflow.llm.decontaminate import benchmark_hits
from crmflow.llm.quality import repetition_report
from crmflow.llm.registry import query, table


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_report(table(spark, sf_dir, "documents"))


_OP9_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
lengths AS (SELECT DISTINCT len(p) AS n FROM phrases),
doc_windows AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths WHERE len(w) >= n)),
hits AS (SELECT DISTINCT d.doc_id, d.i, d.n, b.item_id FROM doc_windows d JOIN phrases b ON d.p = b.p),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op9_decontamination", _OP9_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["word_end"] - s["word"])
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
