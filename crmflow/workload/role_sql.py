"""The roles, conformed tables and business tables as SQL for comparison."""

from __future__ import annotations

AS_OF = "DATE '2001-08-02'"


def half_up(value: str, places: int = 2) -> str:
    """Round a double by its decimal digits, halves away from zero, as Spark does."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 15)), {places}) AS DOUBLE)"


def units(amount: str) -> str:
    """The decimal that a finite amount below 10^18 is written as, in ten-thousandths; NULL for others."""
    return (
        f"CASE WHEN isfinite(CAST({amount} AS DOUBLE)) AND abs({amount}) < 1e18 "
        f"THEN CAST(CAST(CAST({amount} AS VARCHAR) AS DECIMAL(28, 10)) * 10000 AS DECIMAL(38, 6)) END"
    )


def from_units(total: str) -> str:
    return f"(CAST(CAST({total} AS VARCHAR) AS DOUBLE) / 10000.0)"


def total(amount: str) -> str:
    return from_units(f"sum({units(amount)})")


def percent(part: str, whole: str, otherwise: str = "0.0") -> str:
    return f"CASE WHEN {whole} > 0 THEN {half_up(f'({part}) / ({whole}) * 100')} ELSE {otherwise} END"


def transactions_side(online: bool) -> str:
    own = (
        """o_orderkey AS "OrderID", o_orderkey % (SELECT max(p_partkey) + 1 FROM part) AS "ProductID",
           CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'Failed' END AS "Status","""
        if online
        else """o_orderkey AS "TransactionID", o_orderkey % (SELECT max(s_suppkey) + 1 FROM supplier) AS "StoreID","""
    )
    return f"""
    SELECT {own}
           ((o_custkey * o_custkey // n) * (o_custkey * o_custkey // n)) // n AS "CustomerID",
           o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS "DateTime",
           o_orderpriority AS "PaymentMethod",
           CASE WHEN o_orderkey % 97 <> 0
                THEN (CAST(round(o_totalprice * 100) AS BIGINT) // 5000) / 100.0::DOUBLE END AS "Amount"
    FROM orders, (SELECT max(c_custkey) + 1 AS n FROM customer) AS size
    WHERE o_orderpriority {'IN' if online else 'NOT IN'} ('1-URGENT', '2-HIGH', '3-MEDIUM')"""


TIER_RANK = """CASE tier_level WHEN 'Platinum' THEN 4 WHEN 'Gold' THEN 3 WHEN 'Silver' THEN 2
               WHEN 'Bronze' THEN 1 ELSE 0 END"""

# name -> SQL; a definition may use the ones before it.
ROLES: dict[str, str] = {
    "customers_raw": """
    SELECT c_custkey AS "CustomerID", c_name AS "Name",
           CASE WHEN c_custkey % 70 = 0 THEN NULL
                WHEN c_custkey % 50 = 0 THEN lower(replace(c_name, '#', '.'))
                WHEN c_custkey % 90 = 1 THEN lower(replace(c_name, '#', '.')) || '@'
                     || lower(replace(n_name, '_', '-')) || '.example.org' || '@x'
                ELSE lower(replace(c_name, '#', '.')) || '@' || lower(replace(n_name, '_', '-')) || '.example.org'
           END AS "Email",
           c_mktsegment || ', ' || n_name AS "Address"
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "online_raw": transactions_side(True),
    "instore_raw": transactions_side(False),
    "loyalty_raw": """
    SELECT c_custkey AS "LoyaltyID", c_custkey * 2 // 3 AS "CustomerID",
           CAST(floor(abs(c_acctbal)) AS INTEGER) AS "PointsEarned",
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'Platinum' WHEN 'AUTOMOBILE' THEN 'Gold'
                WHEN 'BUILDING' THEN 'Silver' WHEN 'HOUSEHOLD' THEN 'Bronze' ELSE 'Other' END AS "TierLevel",
           DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS "JoinDate"
    FROM customer""",
    "service_raw": """
    SELECT event_id AS "InteractionID", user_id AS "CustomerID", ts - INTERVAL 8218 DAY AS "DateTime",
           event_id % 50 AS "AgentID",
           CASE event_type WHEN 'error' THEN 'Technical Issue' WHEN 'signup' THEN 'Billing'
                WHEN 'click' THEN 'Complaint' WHEN 'view' THEN 'Product Inquiry' ELSE 'Other' END AS "IssueType",
           CASE event_id % 3 WHEN 0 THEN 'Resolved' WHEN 1 THEN 'Escalated' ELSE 'Pending' END AS "ResolutionStatus"
    FROM events""",
    "insights_raw": """
    SELECT o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS "SessionStart",
           o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
             + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) AS "SessionEnd",
           c_custkey AS "CustomerID", c_name AS "FullName",
           CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS "Gender",
           CASE WHEN c_custkey % 77 <> 0 THEN CAST(16 + c_custkey % 60 AS INTEGER) END AS "Age",
           CAST(600 + c_custkey % 200 AS INTEGER) AS "CreditScore",
           CASE WHEN c_custkey % 88 <> 0 THEN c_acctbal END AS "MonthlyIncome",
           'Country ' || c_nationkey AS "Country", 'State ' || (c_custkey % 10) AS "State",
           'City ' || (c_custkey % 100) AS "City", c_mktsegment AS "Category",
           'Product ' || (o_orderkey % 30) AS "Product",
           (CAST(round(o_totalprice * 100) AS BIGINT) * 6 // 10000) / 100.0::DOUBLE AS "Cost",
           (CAST(round(o_totalprice * 100) AS BIGINT) // 1000) / 100.0::DOUBLE AS "Price",
           CAST(1 + o_orderkey % 5 AS INTEGER) AS "Quantity",
           o_orderpriority AS "CampaignSchema", 'Card' AS "PaymentMethod",
           CASE WHEN o_orderstatus <> 'P' THEN 'True' ELSE 'False' END AS "OrderConfirmation",
           CASE WHEN o_orderkey % 7 = 0 THEN 'True' ELSE 'False' END AS "OrderReturn",
           CASE WHEN o_orderkey % 7 = 0 THEN 'Damaged' END AS "ReturnReason"
    FROM orders JOIN customer ON o_custkey = c_custkey""",
    "products_raw": """
    SELECT p_partkey AS "ProductID", p_name AS "Name", p_type AS "Category",
           p_retailprice - 900 + p_size * 8 AS "Price"
    FROM part""",
    "stores_raw": """
    SELECT s_suppkey AS "StoreID", 'Nation ' || s_nationkey AS "Location", s_name AS "Manager",
           (6 + s_suppkey % 4) || '-' || (18 + s_suppkey % 5) AS "OpenHours"
    FROM supplier""",
    "customers": r"""
    SELECT "CustomerID" AS customer_id, "Name" AS customer_name, "Email" AS email, "Address" AS full_address,
           CASE WHEN contains("Email", '@') THEN split_part("Email", '@', 2) END AS email_domain,
           regexp_matches("Email", '^[\w.-]+@[\w.-]+\.\w+$') AS is_valid_email
    FROM customers_raw""",
    "transactions": """
    SELECT *, CAST(transaction_datetime AS DATE) AS transaction_date,
           CAST(year(transaction_datetime) AS INTEGER) AS transaction_year,
           CAST(month(transaction_datetime) AS INTEGER) AS transaction_month,
           CAST(quarter(transaction_datetime) AS INTEGER) AS transaction_quarter,
           CAST(dayofweek(transaction_datetime) + 1 AS INTEGER) AS transaction_day_of_week,
           CAST(hour(transaction_datetime) AS INTEGER) AS transaction_hour,
           dayofweek(transaction_datetime) IN (0, 6) AS is_weekend
    FROM (
      SELECT "OrderID" AS transaction_id, "CustomerID" AS customer_id, "ProductID" AS product_id,
             CAST(NULL AS BIGINT) AS store_id, "DateTime" AS transaction_datetime, "Amount" AS amount,
             "PaymentMethod" AS payment_method, "Status" AS status, 'online' AS channel
      FROM online_raw
      UNION ALL
      SELECT "TransactionID", "CustomerID", CAST(NULL AS BIGINT), "StoreID", "DateTime", "Amount",
             "PaymentMethod", 'Completed', 'instore'
      FROM instore_raw)""",
    "loyalty": f"""
    SELECT *, CAST(floor(tenure_days / 30) AS BIGINT) AS tenure_months, {TIER_RANK} AS tier_rank
    FROM (SELECT "LoyaltyID" AS loyalty_id, "CustomerID" AS customer_id, "PointsEarned" AS total_points,
                 "TierLevel" AS tier_level, "JoinDate" AS join_date,
                 CAST(date_diff('day', "JoinDate", {AS_OF}) AS INTEGER) AS tenure_days
          FROM loyalty_raw)""",
    "service": """
    SELECT "InteractionID" AS interaction_id, "CustomerID" AS customer_id, "DateTime" AS interaction_datetime,
           "AgentID" AS agent_id, "IssueType" AS issue_type, "ResolutionStatus" AS resolution_status,
           CAST("DateTime" AS DATE) AS interaction_date, CAST(hour("DateTime") AS INTEGER) AS interaction_hour,
           "ResolutionStatus" = 'Resolved' AS is_resolved, "ResolutionStatus" = 'Escalated' AS is_escalated,
           "ResolutionStatus" = 'Pending' AS is_pending,
           CASE WHEN "IssueType" IN ('Technical Issue', 'Billing') THEN 'Technical'
                WHEN "IssueType" = 'Complaint' THEN 'Complaint'
                WHEN "IssueType" = 'Product Inquiry' THEN 'Inquiry' ELSE 'Other' END AS issue_category
    FROM service_raw""",
    "insights": """
    SELECT "SessionStart" AS session_start, "SessionEnd" AS session_end, "CustomerID" AS customer_id,
           "FullName" AS customer_name, "Gender" AS gender, "Age" AS age, "CreditScore" AS credit_score,
           "MonthlyIncome" AS monthly_income, "Country" AS country, "State" AS state, "City" AS city,
           "Category" AS product_category, "Product" AS product_name, "Cost" AS product_cost,
           "Price" AS product_price, "Quantity" AS quantity, "CampaignSchema" AS campaign_source,
           "PaymentMethod" AS payment_method, CAST("OrderConfirmation" AS BOOLEAN) AS order_confirmed,
           CAST("OrderReturn" AS BOOLEAN) AS order_returned, "ReturnReason" AS return_reason,
           "Price" * "Quantity" AS order_value, "Price" - "Cost" AS profit_margin,
           ("Price" - "Cost") * "Quantity" AS total_profit,
           CASE WHEN "Age" < 25 THEN '18-24' WHEN "Age" < 35 THEN '25-34' WHEN "Age" < 45 THEN '35-44'
                WHEN "Age" < 55 THEN '45-54' WHEN "Age" < 65 THEN '55-64' ELSE '65+' END AS age_group,
           CASE WHEN "MonthlyIncome" < 3000 THEN 'Low (<3K)' WHEN "MonthlyIncome" < 5000 THEN 'Medium (3K-5K)'
                WHEN "MonthlyIncome" < 7500 THEN 'High (5K-7.5K)' ELSE 'Premium (7.5K+)' END AS income_bracket,
           CASE WHEN "CreditScore" >= 750 THEN 'Excellent' WHEN "CreditScore" >= 700 THEN 'Good'
                WHEN "CreditScore" >= 650 THEN 'Fair' ELSE 'Poor' END AS credit_tier
    FROM insights_raw""",
    "products": """
    SELECT "ProductID" AS product_id, "Name" AS product_name, "Category" AS category, "Price" AS price,
           CASE WHEN "Price" < 100 THEN 'Budget' WHEN "Price" < 250 THEN 'Mid-Range'
                WHEN "Price" < 400 THEN 'Premium' ELSE 'Luxury' END AS price_tier
    FROM products_raw""",
    "stores": """
    SELECT "StoreID" AS store_id, "Location" AS location, "Manager" AS manager_name, "OpenHours" AS open_hours
    FROM stores_raw""",
    "txn_rollup": f"""
    SELECT *, CAST(date_diff('day', last_transaction_date, {AS_OF}) AS INTEGER) AS days_since_last_transaction,
           CAST(date_diff('day', first_transaction_date, {AS_OF}) AS INTEGER) AS customer_tenure_days,
           {percent("online_spend", "total_spend")} AS online_spend_pct
    FROM (SELECT customer_id, count(*) AS total_transactions, {total("amount")} AS total_spend,
                 {total("amount")} / count(amount) AS avg_transaction_value,
                 max(amount) AS max_transaction_value, min(amount) AS min_transaction_value,
                 max(transaction_date) AS last_transaction_date, min(transaction_date) AS first_transaction_date,
                 count(DISTINCT transaction_month) AS active_months,
                 count(DISTINCT transaction_year * 12 + transaction_month) AS active_year_months,
                 count(DISTINCT channel) AS channels_used,
                 count(*) FILTER (channel = 'online') AS online_transactions,
                 count(*) FILTER (channel = 'instore') AS instore_transactions,
                 {total("CASE WHEN channel = 'online' THEN amount ELSE 0 END")} AS online_spend,
                 {total("CASE WHEN channel = 'instore' THEN amount ELSE 0 END")} AS instore_spend,
                 count(*) FILTER (is_weekend) AS weekend_transactions
          FROM transactions GROUP BY customer_id)""",
    "loyalty_rollup": """
    SELECT customer_id, max(total_points) AS loyalty_points, max(tier_level) AS loyalty_tier,
           max(tier_rank) AS loyalty_tier_rank, max(tenure_days) AS loyalty_tenure_days,
           count(*) AS loyalty_accounts,
           first(tier_level ORDER BY tier_rank DESC, tier_level DESC) AS best_tier
    FROM loyalty GROUP BY customer_id""",
    "service_rollup": f"""
    SELECT *, {percent("resolved_tickets", "total_support_tickets", "NULL")} AS support_resolution_rate,
           CAST(date_diff('day', last_support_date, {AS_OF}) AS INTEGER) AS days_since_last_support
    FROM (SELECT customer_id, count(*) AS total_support_tickets,
                 count(*) FILTER (is_resolved) AS resolved_tickets,
                 count(*) FILTER (is_escalated) AS escalated_tickets,
                 count(*) FILTER (is_pending) AS pending_tickets,
                 max(interaction_date) AS last_support_date, count(DISTINCT issue_type) AS unique_issue_types
          FROM service GROUP BY customer_id)""",
    "profile": """
    SELECT * REPLACE (coalesce(total_transactions, 0) AS total_transactions, coalesce(total_spend, 0.0) AS total_spend,
                      coalesce(avg_transaction_value, 0.0) AS avg_transaction_value,
                      coalesce(online_transactions, 0) AS online_transactions,
                      coalesce(instore_transactions, 0) AS instore_transactions,
                      coalesce(loyalty_points, 0) AS loyalty_points,
                      coalesce(total_support_tickets, 0) AS total_support_tickets),
           coalesce(days_since_last_transaction <= 90, false) AS is_active,
           CASE WHEN online_transactions > instore_transactions THEN 'Online'
                WHEN instore_transactions > online_transactions THEN 'In-Store'
                WHEN online_transactions > 0 AND instore_transactions > 0 THEN 'Omnichannel'
                ELSE 'Unknown' END AS preferred_channel,
           CASE WHEN total_transactions >= 10 THEN 'High' WHEN total_transactions >= 5 THEN 'Medium'
                WHEN total_transactions >= 1 THEN 'Low' ELSE 'None' END AS engagement_level,
           total_support_tickets > 0 AS has_support_issues
    FROM customers LEFT JOIN txn_rollup USING (customer_id) LEFT JOIN loyalty_rollup USING (customer_id)
         LEFT JOIN service_rollup USING (customer_id)""",
    "scores": """
    SELECT *, r_score + f_score + m_score AS rfm_score,
           CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_string
    FROM (SELECT *,
          CASE WHEN recency_days <= 30 THEN 5 WHEN recency_days <= 60 THEN 4 WHEN recency_days <= 90 THEN 3
               WHEN recency_days <= 180 THEN 2 ELSE 1 END AS r_score,
          CASE WHEN frequency >= 10 THEN 5 WHEN frequency >= 5 THEN 4 WHEN frequency >= 3 THEN 3
               WHEN frequency >= 1 THEN 2 ELSE 1 END AS f_score,
          CASE WHEN monetary >= 1000 THEN 5 WHEN monetary >= 500 THEN 4 WHEN monetary >= 200 THEN 3
               WHEN monetary >= 50 THEN 2 ELSE 1 END AS m_score
          FROM (SELECT customer_id, coalesce(days_since_last_transaction, 999) AS recency_days,
                       total_transactions AS frequency, total_spend AS monetary FROM profile))""",
    "segments": """
    SELECT *, CASE churn_risk WHEN 'Critical' THEN 4 WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END
              AS churn_risk_score
    FROM (SELECT *, CASE WHEN customer_segment IN ('Hibernating', 'Lost') THEN 'Critical'
                         WHEN customer_segment IN ('At Risk', 'Can''t Lose Them') THEN 'High'
                         WHEN customer_segment = 'Needs Attention' THEN 'Medium' ELSE 'Low' END AS churn_risk
          FROM (SELECT *,
            CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                 WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 4 THEN 'Loyal Customers'
                 WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
                 WHEN r_score >= 3 AND f_score >= 3 THEN 'Potential Loyalists'
                 WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
                 WHEN r_score <= 2 AND f_score >= 4 AND m_score >= 4 THEN 'Can''t Lose Them'
                 WHEN r_score <= 2 AND f_score <= 2 THEN 'Hibernating'
                 WHEN r_score <= 2 AND m_score <= 2 THEN 'Lost'
                 ELSE 'Needs Attention' END AS customer_segment FROM scores))""",
    "clv": """
    SELECT customer_id, historical_clv, avg_purchase_value, purchase_frequency_annual,
           avg_purchase_value * purchase_frequency_annual AS predicted_annual_value,
           avg_purchase_value * purchase_frequency_annual AS predicted_clv_1yr,
           avg_purchase_value * purchase_frequency_annual * 3 AS predicted_clv_3yr,
           avg_purchase_value * purchase_frequency_annual * 5 AS predicted_clv_5yr,
           CASE WHEN historical_clv >= 1000 THEN 'Platinum' WHEN historical_clv >= 500 THEN 'Gold'
                WHEN historical_clv >= 200 THEN 'Silver' ELSE 'Bronze' END AS clv_tier,
           percent_rank() OVER (ORDER BY historical_clv) AS clv_percentile,
           percent_rank() OVER (ORDER BY historical_clv) >= 0.8 AS is_high_value
    FROM (SELECT customer_id, total_spend AS historical_clv, avg_transaction_value AS avg_purchase_value,
                 CASE WHEN customer_tenure_days > 0
                      THEN CAST(total_transactions AS DOUBLE) / customer_tenure_days * 365
                      ELSE 0.0 END AS purchase_frequency_annual
          FROM profile)""",
    "campaigns": f"""
    SELECT *, {percent("conversions", "total_sessions")} AS conversion_rate,
           {percent("returns", "conversions")} AS return_rate,
           {half_up("total_revenue / total_sessions")} AS revenue_per_session,
           {percent("total_profit", "total_revenue")} AS profit_margin_pct,
           CAST(dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS campaign_rank
    FROM (SELECT campaign_source, count(*) AS total_sessions, count(DISTINCT customer_id) AS unique_customers,
                 count(*) FILTER (order_confirmed) AS conversions,
                 {total("CASE WHEN order_confirmed THEN order_value ELSE 0 END")} AS total_revenue,
                 {total("CASE WHEN order_confirmed THEN order_value END")}
                   / count(CASE WHEN order_confirmed THEN order_value END) AS avg_order_value,
                 {total("CASE WHEN order_confirmed THEN total_profit ELSE 0 END")} AS total_profit,
                 count(*) FILTER (order_returned) AS returns, avg(age) AS avg_customer_age,
                 {total("monthly_income")} / count(monthly_income) AS avg_customer_income
          FROM insights GROUP BY campaign_source)""",
    "daily": f"""
    SELECT *, {percent("online_revenue", "total_revenue")} AS online_revenue_pct,
           {percent("completed_orders", "total_transactions")} AS completion_rate,
           CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS day_of_week,
           dayofweek(transaction_date) IN (0, 6) AS is_weekend
    FROM (SELECT transaction_date, count(*) AS total_transactions, {total("amount")} AS total_revenue,
                 {total("amount")} / count(amount) AS avg_transaction_value,
                 count(DISTINCT customer_id) AS unique_customers,
                 count(*) FILTER (channel = 'online') AS online_transactions,
                 count(*) FILTER (channel = 'instore') AS instore_transactions,
                 {total("CASE WHEN channel = 'online' THEN amount ELSE 0 END")} AS online_revenue,
                 {total("CASE WHEN channel = 'instore' THEN amount ELSE 0 END")} AS instore_revenue,
                 count(*) FILTER (status = 'Completed') AS completed_orders,
                 count(*) FILTER (status = 'Failed') AS failed_orders
          FROM transactions GROUP BY transaction_date)""",
}

# Which other definitions each definition uses.
_USES = {
    "customers": ["customers_raw"],
    "transactions": ["online_raw", "instore_raw"],
    "loyalty": ["loyalty_raw"],
    "service": ["service_raw"],
    "insights": ["insights_raw"],
    "products": ["products_raw"],
    "stores": ["stores_raw"],
    "txn_rollup": ["transactions"],
    "loyalty_rollup": ["loyalty"],
    "service_rollup": ["service"],
    "profile": ["customers", "txn_rollup", "loyalty_rollup", "service_rollup"],
    "scores": ["profile"],
    "segments": ["scores"],
    "clv": ["profile"],
    "campaigns": ["insights"],
    "daily": ["transactions"],
}


def _needed(names: list[str]) -> set[str]:
    needed = set(names)
    for name in names:
        needed |= _needed(_USES.get(name, []))
    return needed


def using(names: str, body: str) -> str:
    """``body`` preceded by the definitions it uses (blank-separated names)."""
    needed = _needed(names.split())
    parts = [f"{name} AS ({sql})" for name, sql in ROLES.items() if name in needed]
    return f"WITH {', '.join(parts)} {body}"
