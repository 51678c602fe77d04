"""Daily metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crmflow.operators.project import percent_of
from crmflow.plans.bands import is_weekend
from crmflow.plans.money import from_units, mean_of_units, units


#: Two to this power registers of a sketch.
SKETCH_BITS = 14


def daily_totals() -> list[Column]:
    """The additive aggregates of the table."""
    amount = units(F.col("amount"))
    online, instore = F.col("channel") == "online", F.col("channel") == "instore"
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        F.count(amount).alias("_amounts"),
        F.sum(amount).alias("_revenue"),
        F.count_if(online).alias("online_transactions"),
        F.count_if(instore).alias("instore_transactions"),
        F.sum(F.when(online, amount).otherwise(0)).alias("_online"),
        F.sum(F.when(instore, amount).otherwise(0)).alias("_instore"),
        F.count_if(F.col("status") == "Completed").alias("completed_orders"),
        F.count_if(F.col("status") == "Failed").alias("failed_orders"),
    ]


def daily_parts(transactions: DataFrame) -> DataFrame:
    """Totals per day and customer, which add up over any split of the transactions."""
    return transactions.groupBy("transaction_date", "customer_id").agg(*daily_totals())


_PART_KEYS = ["transaction_date", "customer_id"]


def _part_sums(parts: DataFrame) -> list[Column]:
    return [F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in parts.columns if c not in _PART_KEYS]


def add_daily_parts(parts: DataFrame) -> DataFrame:
    """One part per day and customer from parts in which these may occur several times."""
    return parts.groupBy(*_PART_KEYS).agg(*_part_sums(parts))


def merge_daily_parts(parts: DataFrame) -> DataFrame:
    """The daily table from parts in which a day and customer may occur several times."""
    totals = (
        add_daily_parts(parts)
        .groupBy("transaction_date")
        .agg(*_part_sums(parts), F.count("customer_id").alias("unique_customers"))
    )
    return daily_columns(totals, "transaction_date")


def customer_sketches(transactions: DataFrame, day: str = "transaction_date") -> DataFrame:
    """A sketch of the customers of each day, to be stored: ``customers`` of some kilobytes at most.

    Sketches of any days merge, which exact counts do not; the error of an estimate is about
    0.8 percent (one standard deviation), however many are merged.
    """
    return transactions.groupBy(day).agg(
        F.hll_sketch_agg(F.col("customer_id").cast("string"), SKETCH_BITS).alias("customers")
    )


def customers_over(sketches: DataFrame, *span: Column) -> DataFrame:
    """Estimated number of distinct customers (``customers``) over the days of each span."""
    merged = sketches.groupBy(*span).agg(F.hll_union_agg("customers").alias("_merged"))
    return merged.withColumn("customers", F.hll_sketch_estimate("_merged")).drop("_merged")


def daily_columns(totals: DataFrame, day: str) -> DataFrame:
    """The table's columns from the aggregates above."""
    revenue, online = from_units(F.col("_revenue")), from_units(F.col("_online"))
    day_of_week = F.dayofweek(day)
    return totals.select(
        day,
        "total_transactions",
        revenue.alias("total_revenue"),
        mean_of_units(F.col("_revenue"), F.col("_amounts")).alias("avg_transaction_value"),
        "unique_customers",
        "online_transactions",
        "instore_transactions",
        online.alias("online_revenue"),
        from_units(F.col("_instore")).alias("instore_revenue"),
        "completed_orders",
        "failed_orders",
        percent_of(online, revenue).alias("online_revenue_pct"),
        percent_of(F.col("completed_orders"), F.col("total_transactions")).alias("completion_rate"),
        day_of_week.alias("day_of_week"),
        is_weekend(day_of_week).alias("is_weekend"),
    )


def build_daily_metrics(
    transactions: DataFrame,
    status_filter: Sequence[str] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Volume, revenue, customers, channel and status shares per day with transactions.

    All statuses count towards revenue unless ``status_filter`` names some. Customers
    are counted exactly unless ``approximate``.
    """
    if status_filter is not None:
        transactions = transactions.where(F.col("status").isin(*status_filter))
    customers = (
        F.approx_count_distinct("customer_id") if approximate else F.count_distinct("customer_id")
    )
    totals = transactions.groupBy("transaction_date").agg(*daily_totals(), customers.alias("unique_customers"))
    return daily_columns(totals, "transaction_date")
