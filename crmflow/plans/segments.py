"""Recency, frequency and monetary scores, segments and churn risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crmflow.operators.project import percent_of
from crmflow.plans import bands
from crmflow.plans.bands import label
from crmflow.plans.money import mean_of_units, units

# Fixed value: recency of a customer who never bought.
NEVER_BOUGHT_DAYS = 999

SCORE_COLUMNS = [
    "customer_id",
    "recency_days",
    "frequency",
    "monetary",
    "r_score",
    "f_score",
    "m_score",
    "rfm_score",
    "rfm_string",
]
RISK_COLUMNS = ["customer_segment", "churn_risk", "churn_risk_score"]


def with_scores(profile: DataFrame) -> DataFrame:
    """The profile plus the three measures, their scores from 1 to 5, the sum and the digits."""
    measured = profile.withColumns(
        {
            "recency_days": F.coalesce("days_since_last_transaction", F.lit(NEVER_BOUGHT_DAYS)),
            "frequency": F.coalesce("total_transactions", F.lit(0)),
            "monetary": F.coalesce("total_spend", F.lit(0.0)),
        }
    )
    scored = measured.withColumns(
        {
            "r_score": label(F.col("recency_days"), bands.R_SCORE),
            "f_score": label(F.col("frequency"), bands.F_SCORE),
            "m_score": label(F.col("monetary"), bands.M_SCORE),
        }
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumns({"rfm_score": r + f + m, "rfm_string": F.concat(r, f, m)})


def rfm_scores(profile: DataFrame) -> DataFrame:
    """Per customer only the measures and scores."""
    return with_scores(profile).select(*SCORE_COLUMNS)


def segment(fix_unreachable: bool = False) -> Column:
    """Segment from the three scores; the first rule that holds decides.

    As the rules stand, ``At Risk`` covers every ``Can't Lose Them`` customer;
    ``fix_unreachable`` tests the latter first.
    """
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    slipping = [
        ("At Risk", (r <= 2) & (f >= 3) & (m >= 3)),
        ("Can't Lose Them", (r <= 2) & (f >= 4) & (m >= 4)),
    ]
    rules = [
        ("Champions", (r >= 4) & (f >= 4) & (m >= 4)),
        ("Loyal Customers", (r >= 3) & (f >= 3) & (m >= 4)),
        ("New Customers", (r >= 4) & (f <= 2)),
        ("Potential Loyalists", (r >= 3) & (f >= 3)),
        *(reversed(slipping) if fix_unreachable else slipping),
        ("Hibernating", (r <= 2) & (f <= 2)),
        ("Lost", (r <= 2) & (m <= 2)),
    ]
    chain = F
    for name, test in rules:
        chain = chain.when(test, F.lit(name))
    return chain.otherwise(F.lit("Needs Attention"))


def with_segments(profile: DataFrame, fix_unreachable: bool = False) -> DataFrame:
    """The profile plus scores, segment and churn risk: a projection, with no join."""
    return (
        with_scores(profile)
        .withColumn("customer_segment", segment(fix_unreachable))
        .withColumn("churn_risk", label(F.col("customer_segment"), bands.CHURN_RISK))
        .withColumn("churn_risk_score", label(F.col("churn_risk"), bands.CHURN_RISK_SCORE))
    )


def build_segments(profile: DataFrame, fix_unreachable: bool = False) -> DataFrame:
    """Scores, segment and churn risk per customer."""
    return with_segments(profile, fix_unreachable).select(*SCORE_COLUMNS, *RISK_COLUMNS)


def segment_distribution(segments: DataFrame) -> DataFrame:
    """Customers, mean spend and mean number of transactions per segment and risk."""
    rows = F.col("customer_count")
    return (
        segments.groupBy("customer_segment", "churn_risk")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum(units(F.col("monetary"))).alias("_spend"),
            F.avg("frequency").alias("avg_frequency"),
        )
        .select(
            "customer_segment",
            "churn_risk",
            "customer_count",
            F.round(mean_of_units(F.col("_spend"), rows), 2).alias("avg_spend"),
            "avg_frequency",
        )
    )


def profile_with_risk(profile: DataFrame) -> DataFrame:
    """The profile with each customer's segment and churn risk beside it."""
    return with_segments(profile).select(*profile.columns, *RISK_COLUMNS)


def support_impact(profile: DataFrame) -> DataFrame:
    """Support load and resolution next to churn risk: one row per risk level."""
    tickets, resolved = F.col("total_support_tickets"), F.col("resolved_tickets")
    totals = (
        with_segments(profile)
        .groupBy("churn_risk", "churn_risk_score")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.count_if(tickets > 0).alias("customers_with_tickets"),
            F.sum(tickets).alias("total_tickets"),
            F.avg(tickets).alias("avg_tickets"),
            F.sum(resolved).alias("resolved_tickets"),
            F.sum("escalated_tickets").alias("escalated_tickets"),
        )
    )
    return totals.withColumn(
        "resolution_rate", percent_of(F.col("resolved_tickets"), F.col("total_tickets"), None)
    )
