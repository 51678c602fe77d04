"""Cleaned tables: snake_case names, fixed types, derived columns.

``key_type`` is the type of id columns. A value that does not fit its type becomes
NULL. Each function is a single projection, so it runs inside the scan's stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from crmflow.plans import bands
from crmflow.plans.bands import is_weekend, label
from crmflow.plans.dates import AsOf, as_date

# Lineage columns of the raw layer and the accepted email form.
LINEAGE = ["_source_file", "_ingestion_timestamp", "_ingestion_date"]
EMAIL_PATTERN = r"^[\w.-]+@[\w.-]+\.\w+$"

# Source column to conformed column.
CUSTOMER_NAMES = {
    "CustomerID": "customer_id",
    "Name": "customer_name",
    "Email": "email",
    "Address": "full_address",
}
ONLINE_NAMES = {
    "OrderID": "transaction_id",
    "CustomerID": "customer_id",
    "ProductID": "product_id",
    "DateTime": "transaction_datetime",
    "PaymentMethod": "payment_method",
    "Amount": "amount",
    "Status": "status",
}
INSTORE_NAMES = {
    "TransactionID": "transaction_id",
    "CustomerID": "customer_id",
    "StoreID": "store_id",
    "DateTime": "transaction_datetime",
    "PaymentMethod": "payment_method",
    "Amount": "amount",
}
LOYALTY_NAMES = {
    "LoyaltyID": "loyalty_id",
    "CustomerID": "customer_id",
    "PointsEarned": "total_points",
    "TierLevel": "tier_level",
    "JoinDate": "join_date",
}
SERVICE_NAMES = {
    "InteractionID": "interaction_id",
    "CustomerID": "customer_id",
    "DateTime": "interaction_datetime",
    "AgentID": "agent_id",
    "IssueType": "issue_type",
    "ResolutionStatus": "resolution_status",
}
INSIGHT_NAMES = {
    "CustomerID": "customer_id",
    "FullName": "customer_name",
    "Gender": "gender",
    "Age": "age",
    "CreditScore": "credit_score",
    "MonthlyIncome": "monthly_income",
    "Country": "country",
    "State": "state",
    "City": "city",
    "Category": "product_category",
    "Product": "product_name",
    "Cost": "product_cost",
    "Price": "product_price",
    "Quantity": "quantity",
    "CampaignSchema": "campaign_source",
    "PaymentMethod": "payment_method",
    "SessionStart": "session_start",
    "SessionEnd": "session_end",
    "CartAdditionTime": "cart_addition_time",
    "OrderConfirmation": "order_confirmed",
    "OrderConfirmationTime": "order_confirmation_time",
    "OrderReturn": "order_returned",
    "ReturnReason": "return_reason",
}
PRODUCT_NAMES = {
    "ProductID": "product_id",
    "Name": "product_name",
    "Category": "category",
    "Price": "price",
}
STORE_NAMES = {
    "StoreID": "store_id",
    "Location": "location",
    "Manager": "manager_name",
    "OpenHours": "open_hours",
}
TRANSACTION_COLUMNS = [
    "transaction_id",
    "customer_id",
    "product_id",
    "store_id",
    "transaction_datetime",
    "amount",
    "payment_method",
    "status",
    "channel",
]


def conversions(key_type: str = "bigint") -> dict[str, tuple[dict[str, str], dict[str, str]]]:
    """Per raw table, the conformed names of its headers and the types of conformed columns."""

    def keys(*names: str) -> dict[str, str]:
        return {name: key_type for name in names}

    sale = {
        **keys("transaction_id", "customer_id", "product_id", "store_id"),
        "amount": "double",
        "transaction_datetime": "timestamp",
    }
    return {
        "customers": (CUSTOMER_NAMES, keys("customer_id")),
        "online_transactions": (ONLINE_NAMES, sale),
        "instore_transactions": (INSTORE_NAMES, sale),
        "loyalty_accounts": (
            LOYALTY_NAMES,
            {**keys("loyalty_id", "customer_id"), "total_points": "int", "join_date": "date"},
        ),
        "service_interactions": (
            SERVICE_NAMES,
            {**keys("interaction_id", "customer_id", "agent_id"), "interaction_datetime": "timestamp"},
        ),
        "customer_insights": (
            INSIGHT_NAMES,
            {
                **keys("customer_id"),
                "age": "int",
                "credit_score": "int",
                "monthly_income": "double",
                "product_cost": "double",
                "product_price": "double",
                "quantity": "int",
                "order_confirmed": "boolean",
                "order_returned": "boolean",
                "session_start": "timestamp",
                "session_end": "timestamp",
            },
        ),
        "products": (PRODUCT_NAMES, {**keys("product_id"), "price": "double"}),
        "stores": (STORE_NAMES, keys("store_id")),
    }


#: Column with the names of those columns of a row whose value a conversion lost.
LOST = "_lost"


def _converted(raw: DataFrame, table: str, key_type: str) -> dict[str, tuple[str, Column, bool]]:
    """Header to conformed name, converted value, and whether there is a conversion; without the lineage."""
    names, types = conversions(key_type)[table]
    result = {}
    for field in raw.schema.fields:
        if field.name not in LINEAGE:
            name = names.get(field.name.strip(), field.name.strip())
            column, kind = F.col(f"`{field.name}`"), types.get(name)
            if kind == "timestamp" and field.dataType.typeName() in ("timestamp", "timestamp_ntz"):
                kind = None
            result[field.name] = (name, column.try_cast(kind) if kind else column, kind is not None)
    return result


def _prepare(raw: DataFrame, table: str, key_type: str = "bigint") -> DataFrame:
    """Rename (blanks around headers are ignored) and convert in one projection, without the lineage."""
    return raw.select(*[value.alias(name) for name, value, _ in _converted(raw, table, key_type).values()])


def mark_losses(raw: DataFrame, table: str, key_type: str = "bigint") -> DataFrame:
    """Adds the names of the columns whose value, other than blank text, a conversion will turn into NULL.

    The cleaned tables keep that column, so it can be counted where they are written.
    """
    # The text of a value, which is slow to write, is only looked at where the conversion gave NULL.
    lost = [
        F.when(value.isNull() & (F.trim(F.col(f"`{header}`").cast("string")) != ""), F.lit(name))
        for header, (name, value, converted) in _converted(raw, table, key_type).items()
        if converted
    ]
    return raw.withColumn(LOST, F.array_compact(F.array(F.lit(None).cast("string"), *lost)))


def loss_counts(tables: Sequence[str], key_type: str = "bigint") -> list[Column]:
    """Rows with any lost value (``bad_rows``) and, per converted column, those where it was lost."""
    names = sorted({name for table in tables for name in conversions(key_type)[table][1]})
    each = [F.count_if(F.array_contains(LOST, name)).alias(f"lost_{name}") for name in names]
    return [F.count_if(F.size(LOST) > 0).alias("bad_rows"), *each]


def stamp(df: DataFrame, column: str, moment: Column | None = None) -> DataFrame:
    """Add a layer's processing time (default: now)."""
    return df.withColumn(column, F.current_timestamp() if moment is None else moment)


def conform_customers(raw: DataFrame, key_type: str = "bigint") -> DataFrame:
    """Adds ``email_domain`` (text between the first and any second @) and ``is_valid_email``."""
    email = F.col("email")
    return _prepare(raw, "customers", key_type).withColumns(
        {
            "email_domain": F.get(F.split(email, "@"), F.lit(1)),
            "is_valid_email": email.rlike(EMAIL_PATTERN),
        }
    )


def conform_transactions(online: DataFrame, instore: DataFrame, key_type: str = "bigint") -> DataFrame:
    """Both channels in one table, with the parts of the transaction time.

    The key is ``(channel, transaction_id)``: the channels number independently.
    Nothing is deduplicated here.
    """
    web = _prepare(online, "online_transactions", key_type).withColumns(
        {"channel": F.lit("online"), "store_id": F.lit(None).cast(key_type)}
    )
    shop = _prepare(instore, "instore_transactions", key_type).withColumns(
        {
            "channel": F.lit("instore"),
            "status": F.lit("Completed"),
            "product_id": F.lit(None).cast(key_type),
        }
    )
    kept = [*TRANSACTION_COLUMNS, *([LOST] if LOST in web.columns and LOST in shop.columns else [])]
    both = [side.select(*kept) for side in (web, shop)]
    when = F.col("transaction_datetime")
    return both[0].unionByName(both[1]).withColumns(
        {
            "transaction_date": when.cast("date"),
            "transaction_year": F.year(when),
            "transaction_month": F.month(when),
            "transaction_quarter": F.quarter(when),
            "transaction_day_of_week": F.dayofweek(when),
            "transaction_hour": F.hour(when),
            "is_weekend": is_weekend(F.dayofweek(when)),
        }
    )


def conform_loyalty(raw: DataFrame, as_of: AsOf, key_type: str = "bigint") -> DataFrame:
    """Adds tenure in days and in 30-day months up to ``as_of``, and the tier's rank."""
    days = F.datediff(as_date(as_of), F.col("join_date"))
    return _prepare(raw, "loyalty_accounts", key_type).withColumns(
        {
            "tenure_days": days,
            "tenure_months": F.floor(days / 30),
            "tier_rank": label(F.col("tier_level"), bands.TIER_RANK),
        }
    )


def conform_service(raw: DataFrame, key_type: str = "bigint") -> DataFrame:
    """Adds state flags (NULL for a NULL state), the issue category, date and hour."""
    status, when = F.col("resolution_status"), F.col("interaction_datetime")
    return _prepare(raw, "service_interactions", key_type).withColumns(
        {
            "interaction_date": when.cast("date"),
            "interaction_hour": F.hour(when),
            "is_resolved": status == "Resolved",
            "is_escalated": status == "Escalated",
            "is_pending": status == "Pending",
            "issue_category": label(F.col("issue_type"), bands.ISSUE_CATEGORY),
        }
    )


def conform_insights(raw: DataFrame, key_type: str = "bigint") -> DataFrame:
    """Adds order value, margin and profit, text flags as booleans, and demographic bands."""
    df = _prepare(raw, "customer_insights", key_type)
    price, quantity = F.col("product_price"), F.col("quantity")
    margin = price - F.col("product_cost")
    return df.withColumns(
        {
            "order_value": price * quantity,
            "profit_margin": margin,
            "total_profit": margin * quantity,
            "age_group": label(F.col("age"), bands.AGE_GROUP),
            "income_bracket": label(F.col("monthly_income"), bands.INCOME_BRACKET),
            "credit_tier": label(F.col("credit_score"), bands.CREDIT_TIER),
        }
    )


def conform_products(raw: DataFrame, key_type: str = "bigint") -> DataFrame:
    return _prepare(raw, "products", key_type).withColumn(
        "price_tier", label(F.col("price"), bands.PRICE_TIER)
    )


def conform_stores(raw: DataFrame, key_type: str = "bigint") -> DataFrame:
    return _prepare(raw, "stores", key_type)


# Profile attributes available when customers come from the insights table.
INSIGHT_CUSTOMER_COLUMNS: Sequence[str] = (
    "customer_id",
    "customer_name",
    "gender",
    "age",
    "age_group",
    "credit_score",
    "credit_tier",
    "monthly_income",
    "income_bracket",
    "country",
    "state",
    "city",
)


def customers_from_insights(insights: DataFrame) -> DataFrame:
    """One row per customer from the insights table: the latest session's attributes."""
    rest = [c for c in INSIGHT_CUSTOMER_COLUMNS if c != "customer_id"]
    latest = F.max_by(F.struct(*rest), F.struct("session_start", *rest))
    return (
        insights.groupBy("customer_id")
        .agg(latest.alias("_latest"))
        .select("customer_id", "_latest.*")
    )
