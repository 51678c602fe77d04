"""Customer lifetime value."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crmflow.operators.ranking import percent_rank
from crmflow.operators.skew import DEFAULT_POLICY, SkewPolicy
from crmflow.plans import bands
from crmflow.plans.bands import label
from crmflow.storage import materialize

OUTPUT_COLUMNS = [
    "customer_id",
    "historical_clv",
    "avg_purchase_value",
    "purchase_frequency_annual",
    "predicted_annual_value",
    "predicted_clv_1yr",
    "predicted_clv_3yr",
    "predicted_clv_5yr",
    "clv_tier",
    "clv_percentile",
    "is_high_value",
]


def lifetime_inputs(profile: DataFrame) -> DataFrame:
    """Historical value, mean purchase and yearly frequency (0 if the first purchase is today)."""
    tenure = F.col("customer_tenure_days")
    return profile.select(
        "customer_id",
        F.coalesce("total_spend", F.lit(0.0)).alias("historical_clv"),
        F.coalesce("avg_transaction_value", F.lit(0.0)).alias("avg_purchase_value"),
        F.when(tenure > 0, F.col("total_transactions") / tenure * 365)
        .otherwise(F.lit(0.0))
        .alias("purchase_frequency_annual"),
    )


def build_lifetime_value(
    profile: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Historical and projected value, tier, percentile and high-value flag per customer.

    The percentile reads its rows more than once, so the four columns it rests on
    are stored first: the profile itself is computed once.
    """
    base = materialize(lifetime_inputs(profile), "lifetime")
    ranked = percent_rank(base, ["historical_clv"], "clv_percentile", policy)
    yearly = F.col("avg_purchase_value") * F.col("purchase_frequency_annual")
    return ranked.select(
        "*",
        yearly.alias("predicted_annual_value"),
        yearly.alias("predicted_clv_1yr"),
        (yearly * 3).alias("predicted_clv_3yr"),
        (yearly * 5).alias("predicted_clv_5yr"),
        label(F.col("historical_clv"), bands.CLV_TIER).alias("clv_tier"),
        (F.col("clv_percentile") >= 0.8).alias("is_high_value"),
    ).select(*OUTPUT_COLUMNS)
