"""Campaign performance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crmflow.operators.project import percent_of
from crmflow.operators.ranking import dense_rank_small
from crmflow.plans.money import from_units, mean_of_units, units


def build_campaign_performance(insights: DataFrame) -> DataFrame:
    """Sessions, conversions, revenue, returns and rates per campaign, ranked by revenue.

    Returns count whether or not the order was confirmed, so their rate can pass 100.
    """
    confirmed = F.coalesce(F.col("order_confirmed"), F.lit(False))
    value, profit = units(F.col("order_value")), units(F.col("total_profit"))
    income = units(F.col("monthly_income"))
    totals = insights.groupBy("campaign_source").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_if(confirmed).alias("conversions"),
        F.sum(F.when(confirmed, value).otherwise(0)).alias("_revenue"),
        F.count(F.when(confirmed, value)).alias("_valued"),
        F.sum(F.when(confirmed, value)).alias("_confirmed_value"),
        F.sum(F.when(confirmed, profit).otherwise(0)).alias("_profit"),
        F.count_if("order_returned").alias("returns"),
        F.avg("age").alias("avg_customer_age"),
        F.sum(income).alias("_income"),
        F.count(income).alias("_incomes"),
    )
    sessions, conversions = F.col("total_sessions"), F.col("conversions")
    revenue, earned = from_units(F.col("_revenue")), from_units(F.col("_profit"))
    metrics = totals.select(
        "campaign_source",
        "total_sessions",
        "unique_customers",
        "conversions",
        revenue.alias("total_revenue"),
        mean_of_units(F.col("_confirmed_value"), F.col("_valued")).alias("avg_order_value"),
        earned.alias("total_profit"),
        "returns",
        "avg_customer_age",
        mean_of_units(F.col("_income"), F.col("_incomes")).alias("avg_customer_income"),
        percent_of(conversions, sessions).alias("conversion_rate"),
        percent_of(F.col("returns"), conversions).alias("return_rate"),
        F.round(revenue / sessions, 2).alias("revenue_per_session"),
        percent_of(earned, revenue).alias("profit_margin_pct"),
    )
    return dense_rank_small(metrics, [("total_revenue", "desc")], "campaign_rank")


def campaign_ranking(performance: DataFrame) -> DataFrame:
    """The columns of the ranking report, best campaign first."""
    return performance.select(
        "campaign_rank",
        "campaign_source",
        "total_sessions",
        "conversions",
        "conversion_rate",
        F.round("total_revenue", 2).alias("total_revenue"),
    ).orderBy("campaign_rank", "campaign_source")
