"""Running a layer: each table on its own, with a status row per table."""

from __future__ import annotations

import traceback
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from crmflow.operators.quality import drop_exact_duplicates
from crmflow.plans import conform
from crmflow.plans.campaigns import build_campaign_performance
from crmflow.plans.daily import build_daily_metrics
from crmflow.plans.dates import AsOf
from crmflow.plans.lifetime import build_lifetime_value
from crmflow.plans.profile import build_profile
from crmflow.plans.segments import build_segments
from crmflow.sources.files import CORRUPT, discover_csv, file_name, read_csv, table_name
from crmflow.sources.tables import LayerTables, add_lineage

REPORT_SCHEMA = "table_name string, source string, status string, row_count bigint, message string, bad_rows bigint, lost_values map<string, bigint>"


def _run(
    spark: SparkSession, steps: Mapping[str, tuple[str, Callable[[], int | dict[str, int] | None]]]
) -> DataFrame:
    """Run steps one by one; a failed step becomes an ERROR row, a step without input SKIPPED.

    A step returns its rows, or these and ``bad_rows``: rows of the source that did not fit, or
    rows with values that a conversion lost. Counts ``lost_<column>`` go into ``lost_values``.
    """
    report = []
    for name, (source, step) in steps.items():
        try:
            done = step()
            counts = done if isinstance(done, dict) else {"rows": done}
            status = "SUCCESS" if done is not None else "SKIPPED"
            lost = {c.removeprefix("lost_"): n for c, n in counts.items() if c.startswith("lost_") and n}
            lost = lost if "bad_rows" in counts else None
            report.append((name, source, status, counts["rows"], None, counts.get("bad_rows"), lost))
        except Exception as error:  # reported as a row
            text = str(error).splitlines() or traceback.format_exception_only(error)
            report.append((name, source, "ERROR", None, text[0], None, None))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def ingest_files(
    tables: LayerTables,
    files: Mapping[str, str | Sequence[str]],
    mode: str = "overwrite",
    ingested_at: datetime | None = None,
    ingested_on: date | None = None,
    schemas: Mapping[str, T.StructType | str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read the CSV files of each table (``table -> path or paths``) into the raw layer; returns the report.

    Each row carries the file it came from. Files of a table may differ in the order and number
    of their columns. Types come from ``schemas`` (``table -> schema``) or are inferred over all
    files of a table. Rows that do not fit keep their text in ``_corrupt_record`` and are
    counted in the report.
    """
    tables.create("bronze")

    def step(table: str, paths: str | Sequence[str]) -> Callable[[], dict[str, int]]:
        def run() -> dict[str, int]:
            schema = (schemas or {}).get(table)
            raw = read_csv(
                tables.spark, paths, schema, multi_line=multi_line, keep_bad_rows=True, file_column="_file"
            )
            stamped = add_lineage(raw, F.col("_file"), ingested_at, ingested_on).drop("_file")
            bad = F.count(CORRUPT).alias("bad_rows")
            # One ingest has one date, so there is nothing to gather by it.
            return tables.write(stamped, table, "bronze", mode, ["_ingestion_date"], [bad], one_partition=True)

        return run

    def source(paths: str | Sequence[str]) -> str:
        return paths if isinstance(paths, str) else ", ".join(paths)

    return _run(tables.spark, {t: (source(paths), step(t, paths)) for t, paths in files.items()})


def ingest_folder(tables: LayerTables, base_path: str, **options) -> DataFrame:
    """Ingest every CSV file below a folder; files of the same table name go into one table."""
    found = discover_csv(tables.spark, base_path).select(
        table_name(file_name(F.col("path"))).alias("table"), "path"
    )
    by_table = found.groupBy("table").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    # Paths only: the reader keeps the list of its files on the driver in any case.
    files = {row["table"]: row["paths"] for row in by_table.collect()}
    return ingest_files(tables, files, **options)


def conform_layer(
    tables: LayerTables,
    as_of: AsOf,
    key_type: str = "bigint",
    deduplicate_transactions: bool = False,
    partition_transactions_by: Sequence[str] = ("transaction_year", "transaction_month"),
) -> DataFrame:
    """Build every cleaned table whose raw table exists; returns the report.

    Exact duplicates are removed first, except in the transactions, where that is a
    switch. Transactions are stored by month, so that reports on a period read only it. Values
    that do not fit their type become NULL and are counted per column while the table is written.
    """
    tables.create("silver")

    def raw(table: str, deduplicate: bool = True) -> DataFrame:
        df = tables.read(table, "bronze")
        return conform.mark_losses(drop_exact_duplicates(df) if deduplicate else df, table, key_type)

    def transactions() -> DataFrame:
        return conform.conform_transactions(
            raw("online_transactions", deduplicate_transactions),
            raw("instore_transactions", deduplicate_transactions),
            key_type,
        )

    builders: dict[str, tuple[list[str], Callable[[], DataFrame]]] = {
        "customers": (["customers"], lambda: conform.conform_customers(raw("customers"), key_type)),
        "transactions": (["online_transactions", "instore_transactions"], transactions),
        "loyalty": (
            ["loyalty_accounts"],
            lambda: conform.conform_loyalty(raw("loyalty_accounts"), as_of, key_type),
        ),
        "service_interactions": (
            ["service_interactions"],
            lambda: conform.conform_service(raw("service_interactions"), key_type),
        ),
        "customer_insights": (
            ["customer_insights"],
            lambda: conform.conform_insights(raw("customer_insights"), key_type),
        ),
        "products": (["products"], lambda: conform.conform_products(raw("products"), key_type)),
        "stores": (["stores"], lambda: conform.conform_stores(raw("stores"), key_type)),
    }

    def step(table: str, sources: list[str], build: Callable[[], DataFrame]):
        def run() -> dict[str, int] | None:
            if not all(tables.exists(s, "bronze") for s in sources):
                return None
            stamped = conform.stamp(build(), "_silver_timestamp")
            partitions = partition_transactions_by if table == "transactions" else ()
            counts = conform.loss_counts(sources, key_type)
            return tables.write(
                stamped, table, "silver", partition_by=partitions, observed=counts, hidden=[conform.LOST]
            )

        return run

    return _run(
        tables.spark,
        {t: (", ".join(s), step(t, s, build)) for t, (s, build) in builders.items()},
    )


def business_layer(tables: LayerTables, as_of: AsOf) -> DataFrame:
    """Build the five business tables from the cleaned layer; returns the report.

    The profile is written once and read back by the tables that rest on it.
    """
    tables.create("gold")

    def write(df: DataFrame | None, table: str) -> int | None:
        if df is None:
            return None
        return tables.write(conform.stamp(df, "_gold_timestamp"), table, "gold")

    def profile() -> DataFrame | None:
        customers = tables.read_if_exists("customers", "silver")
        insights = tables.read_if_exists("customer_insights", "silver")
        if customers is None and insights is not None:
            customers = conform.customers_from_insights(insights)
        if customers is None:
            return None
        rollup_inputs = {
            "transactions": tables.read_if_exists("transactions", "silver"),
            "loyalty": tables.read_if_exists("loyalty", "silver"),
            "service": tables.read_if_exists("service_interactions", "silver"),
        }
        return build_profile(customers.drop("_silver_timestamp"), as_of, **rollup_inputs)

    def from_table(table: str, layer: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
        source = tables.read_if_exists(table, layer)
        return None if source is None else build(source)

    return _run(
        tables.spark,
        {
            "customer_360": ("silver", lambda: write(profile(), "customer_360")),
            "customer_segments": (
                "customer_360",
                lambda: write(
                    from_table("customer_360", "gold", build_segments), "customer_segments"
                ),
            ),
            "customer_clv": (
                "customer_360",
                lambda: write(
                    from_table("customer_360", "gold", build_lifetime_value), "customer_clv"
                ),
            ),
            "campaign_performance": (
                "customer_insights",
                lambda: write(
                    from_table("customer_insights", "silver", build_campaign_performance),
                    "campaign_performance",
                ),
            ),
            "daily_metrics": (
                "transactions",
                lambda: write(
                    from_table("transactions", "silver", build_daily_metrics), "daily_metrics"
                ),
            ),
        },
    )
