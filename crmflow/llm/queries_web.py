"""Registered queries over web pages: archives, URL filters and main text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmflow.llm.content import extract_content, train_scores
from crmflow.llm.registry import query, table
from crmflow.llm.url_filter import judge_urls
from crmflow.llm.warc import CHUNKS, read_records, write_archive
from crmflow.storage import scratch_path

_OP7_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
           FROM pages),
r AS (SELECT payload_digest, max(page_id) AS response FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < response THEN response END AS refers_to
FROM p LEFT JOIN r USING (payload_digest)
"""


@query("op7_warc", _OP7_SQL)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    write_archive(pages, path)
    kind = pages.schema["page_id"].dataType
    return read_records(spark.read.schema(CHUNKS).parquet(path)).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


_OP10_SQL = r"""
WITH p AS (SELECT page_id, url, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
                  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM pages),
rules(rule_verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM (SELECT DISTINCT host, path FROM p)
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY 1, 2),
listed AS (SELECT DISTINCT host, path, 'block' AS listed_verdict FROM p WHERE contains(url, 'utm_source='))
SELECT page_id, p.host, p.path, rule, coalesce(rule_verdict, listed_verdict, 'allow') AS verdict
FROM p LEFT JOIN fits ON p.host = fits.host AND p.path = fits.path
       LEFT JOIN listed ON p.host = listed.host AND p.path = listed.path
"""


@query("op10_url_filter", _OP10_SQL)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds every host and path that some page reaches with a campaign tag in its url."""
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, pages["url"].contains("utm_source="))


@query("op11_html_extraction")
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extract_content(pages, train_scores(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
