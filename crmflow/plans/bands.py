"""Labels from thresholds. Every ``otherwise`` label also catches NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crmflow.operators.project import band

# Thresholds and labels of the business rules.
TIER_RANK = ([("=", "Platinum", 4), ("=", "Gold", 3), ("=", "Silver", 2), ("=", "Bronze", 1)], 0)
ISSUE_CATEGORY = (
    [
        ("in", ["Technical Issue", "Billing"], "Technical"),
        ("=", "Complaint", "Complaint"),
        ("=", "Product Inquiry", "Inquiry"),
    ],
    "Other",
)
AGE_GROUP = (
    [("<", 25, "18-24"), ("<", 35, "25-34"), ("<", 45, "35-44"), ("<", 55, "45-54"), ("<", 65, "55-64")],
    "65+",
)
INCOME_BRACKET = (
    [("<", 3000, "Low (<3K)"), ("<", 5000, "Medium (3K-5K)"), ("<", 7500, "High (5K-7.5K)")],
    "Premium (7.5K+)",
)
CREDIT_TIER = ([(">=", 750, "Excellent"), (">=", 700, "Good"), (">=", 650, "Fair")], "Poor")
PRICE_TIER = ([("<", 100, "Budget"), ("<", 250, "Mid-Range"), ("<", 400, "Premium")], "Luxury")
ENGAGEMENT_LEVEL = ([(">=", 10, "High"), (">=", 5, "Medium"), (">=", 1, "Low")], "None")
R_SCORE = ([("<=", 30, 5), ("<=", 60, 4), ("<=", 90, 3), ("<=", 180, 2)], 1)
F_SCORE = ([(">=", 10, 5), (">=", 5, 4), (">=", 3, 3), (">=", 1, 2)], 1)
M_SCORE = ([(">=", 1000, 5), (">=", 500, 4), (">=", 200, 3), (">=", 50, 2)], 1)
CLV_TIER = ([(">=", 1000, "Platinum"), (">=", 500, "Gold"), (">=", 200, "Silver")], "Bronze")
CHURN_RISK = (
    [
        ("in", ["Hibernating", "Lost"], "Critical"),
        ("in", ["At Risk", "Can't Lose Them"], "High"),
        ("=", "Needs Attention", "Medium"),
    ],
    "Low",
)
CHURN_RISK_SCORE = ([("=", "Critical", 4), ("=", "High", 3), ("=", "Medium", 2)], 1)


def label(column: Column, rules) -> Column:
    """Apply one of the band definitions above."""
    return band(column, *rules)


def is_weekend(day_of_week: Column) -> Column:
    """Saturday or Sunday with Sunday = 1; NULL counts as a working day."""
    return F.coalesce(day_of_week.isin(1, 7), F.lit(False))
