"""Conformed and business tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmflow.operators.ranking import percent_rank
from crmflow.operators.rows import top_k
from crmflow.plans import bands, conform, segments
from crmflow.plans.bands import label
from crmflow.plans.campaigns import build_campaign_performance, campaign_ranking
from crmflow.plans.daily import build_daily_metrics, customer_sketches, customers_over
from crmflow.plans.lifetime import build_lifetime_value
from crmflow.plans.profile import build_profile, loyalty_rollup, service_rollup, transaction_rollup
from crmflow.storage import materialize
from crmflow.workload import roles
from crmflow.workload.registry import query, table
from crmflow.workload.role_sql import half_up, total, using


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_profile(
        roles.customers(spark, sf_dir),
        roles.AS_OF,
        roles.transactions(spark, sf_dir),
        roles.loyalty(spark, sf_dir),
        roles.service(spark, sf_dir),
    )


query("conform_customers", using("customers", "SELECT * FROM customers"))(roles.customers)
query("conform_transactions", using("transactions", "SELECT * FROM transactions"))(roles.transactions)
query("conform_loyalty", using("loyalty", "SELECT * FROM loyalty"))(roles.loyalty)
query("conform_service", using("service", "SELECT * FROM service"))(roles.service)
query("conform_products", using("products", "SELECT * FROM products"))(roles.products)
query("conform_stores", using("stores", "SELECT * FROM stores"))(roles.stores)
query("conform_insights", using("insights", "SELECT * FROM insights"))(roles.insights)
query("profile_full", using("profile", "SELECT * FROM profile"))(profile)


@query(
    "band_all",
    using(
        "insights loyalty service products",
        """
        SELECT 'age_group' AS band, age_group AS label, count(*) AS n FROM insights GROUP BY 2
        UNION ALL SELECT 'income_bracket', income_bracket, count(*) FROM insights GROUP BY 2
        UNION ALL SELECT 'credit_tier', credit_tier, count(*) FROM insights GROUP BY 2
        UNION ALL SELECT 'tier_rank', CAST(tier_rank AS VARCHAR), count(*) FROM loyalty GROUP BY 2
        UNION ALL SELECT 'issue_category', issue_category, count(*) FROM service GROUP BY 2
        UNION ALL SELECT 'price_tier', price_tier, count(*) FROM products GROUP BY 2""",
    ),
)
def band_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows fall into each band."""

    def counted(df: DataFrame, name: str, column) -> DataFrame:
        return (
            df.groupBy(column.cast("string").alias("label"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(name).alias("band"), "label", "n")
        )

    insights = roles.insights(spark, sf_dir)
    return (
        counted(insights, "age_group", label(F.col("age"), bands.AGE_GROUP))
        .unionByName(counted(insights, "income_bracket", label(F.col("monthly_income"), bands.INCOME_BRACKET)))
        .unionByName(counted(insights, "credit_tier", label(F.col("credit_score"), bands.CREDIT_TIER)))
        .unionByName(
            counted(roles.loyalty(spark, sf_dir), "tier_rank", label(F.col("tier_level"), bands.TIER_RANK))
        )
        .unionByName(
            counted(
                roles.service(spark, sf_dir), "issue_category", label(F.col("issue_type"), bands.ISSUE_CATEGORY)
            )
        )
        .unionByName(
            counted(roles.products(spark, sf_dir), "price_tier", label(F.col("price"), bands.PRICE_TIER))
        )
    )


@query(
    "customers_from_insights",
    using(
        "insights",
        """
        SELECT customer_id, customer_name, gender, age, age_group, credit_score, credit_tier, monthly_income,
               income_bracket, country, state, city
        FROM insights
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY session_start DESC) = 1""",
    ),
)
def customers_from_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.customers_from_insights(roles.insights(spark, sf_dir))


@query("profile_txn_rollup", using("txn_rollup", "SELECT * FROM txn_rollup"))
def profile_txn_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_rollup(roles.transactions(spark, sf_dir), roles.AS_OF)


@query("profile_loyalty_rollup", using("loyalty_rollup", "SELECT * FROM loyalty_rollup"))
def profile_loyalty_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loyalty_rollup(roles.loyalty(spark, sf_dir))


@query("profile_service_rollup", using("service_rollup", "SELECT * FROM service_rollup"))
def profile_service_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service_rollup(roles.service(spark, sf_dir), roles.AS_OF)


@query("rfm_scores", using("scores", "SELECT * FROM scores"))
def rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.rfm_scores(profile(spark, sf_dir))


@query("rfm_segments", using("segments", "SELECT * FROM segments"))
def rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.build_segments(profile(spark, sf_dir))


@query(
    "churn_risk",
    using(
        "segments",
        "SELECT churn_risk, churn_risk_score, count(*) AS customer_count FROM segments GROUP BY 1, 2",
    ),
)
def churn_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        rfm_segments(spark, sf_dir)
        .groupBy("churn_risk", "churn_risk_score")
        .agg(F.count(F.lit(1)).alias("customer_count"))
    )


@query(
    "segment_distribution",
    using(
        "segments",
        f"""SELECT customer_segment, churn_risk, count(*) AS customer_count,
                   {half_up(f"{total('monetary')} / count(*)")}
                     AS avg_spend,
                   avg(frequency) AS avg_frequency
            FROM segments GROUP BY 1, 2""",
    ),
)
def segment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_distribution(rfm_segments(spark, sf_dir))


@query(
    "profile_with_risk",
    using(
        "profile segments",
        """SELECT profile.*, customer_segment, churn_risk, churn_risk_score
           FROM profile JOIN segments USING (customer_id)""",
    ),
)
def profile_with_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.profile_with_risk(profile(spark, sf_dir))


@query(
    "support_impact",
    using(
        "profile segments",
        f"""SELECT *, CASE WHEN total_tickets > 0 THEN
                   {half_up("resolved_tickets / total_tickets * 100")} END AS resolution_rate
            FROM (SELECT churn_risk, churn_risk_score, count(*) AS customer_count,
                         count(*) FILTER (total_support_tickets > 0) AS customers_with_tickets,
                         CAST(sum(total_support_tickets) AS BIGINT) AS total_tickets,
                         avg(total_support_tickets) AS avg_tickets,
                         CAST(sum(resolved_tickets) AS BIGINT) AS resolved_tickets,
                         CAST(sum(escalated_tickets) AS BIGINT) AS escalated_tickets
                  FROM profile JOIN segments USING (customer_id) GROUP BY 1, 2)""",
    ),
)
def support_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.support_impact(profile(spark, sf_dir))


@query("clv", using("clv", "SELECT * FROM clv"))
def clv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_lifetime_value(profile(spark, sf_dir))


@query(
    "clv_percentile",
    using(
        "txn_rollup",
        """SELECT customer_id, total_spend, percent_rank() OVER (ORDER BY total_spend NULLS FIRST) AS clv_percentile
           FROM txn_rollup""",
    ),
)
def clv_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = profile_txn_rollup(spark, sf_dir).select("customer_id", "total_spend")
    return percent_rank(spend, ["total_spend"], "clv_percentile")


@query("campaign_performance", using("campaigns", "SELECT * FROM campaigns"))
def campaign_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_campaign_performance(roles.insights(spark, sf_dir))


@query(
    "campaign_ranking",
    using(
        "campaigns",
        f"""SELECT campaign_rank, campaign_source, total_sessions, conversions, conversion_rate,
                   {half_up("total_revenue")} AS total_revenue FROM campaigns""",
    ),
)
def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign_ranking(campaign_performance(spark, sf_dir))


@query("daily_metrics", using("daily", "SELECT * FROM daily"))
def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_daily_metrics(roles.transactions(spark, sf_dir))


@query(
    "topk_spend",
    using(
        "profile",
        f"""SELECT customer_id, customer_name, total_transactions, {half_up("total_spend")} AS total_spend,
                   loyalty_tier, preferred_channel, is_active
            FROM profile ORDER BY profile.total_spend DESC NULLS LAST, customer_id LIMIT 10""",
    ),
)
def topk_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten customers with the largest spend."""
    best = top_k(profile(spark, sf_dir), [("total_spend", "desc"), "customer_id"], 10)
    return best.select(
        "customer_id",
        "customer_name",
        "total_transactions",
        F.round("total_spend", 2).alias("total_spend"),
        "loyalty_tier",
        "preferred_channel",
        "is_active",
    )


_ODD = """CASE o_orderkey % 13 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN '-Infinity'::DOUBLE
               WHEN 3 THEN 1e16::DOUBLE WHEN 4 THEN -1e18::DOUBLE WHEN 5 THEN (o_orderkey % 1000003) / 1000000.0::DOUBLE
               WHEN 6 THEN NULL WHEN 7 THEN 0.1::DOUBLE WHEN 8 THEN 123456789012.345678::DOUBLE ELSE o_totalprice END"""


@query(
    "money_exact",
    f"""
    WITH t AS (SELECT o_custkey, o_orderdate, o_orderstatus, {_ODD} AS raw FROM orders),
         a AS (SELECT *, CASE WHEN isfinite(raw) AND abs(raw) < 1e18 THEN raw END AS amount FROM t)
    SELECT o_custkey AS customer_id, count(*) AS total_transactions, {total("amount")} AS total_spend,
           {total("amount")} / count(amount) AS avg_transaction_value,
           max(amount) AS max_transaction_value, min(amount) AS min_transaction_value,
           {total("CASE WHEN o_orderstatus = 'F' THEN amount ELSE 0 END")} AS online_spend,
           {total("CASE WHEN o_orderstatus <> 'F' THEN amount ELSE 0 END")} AS instore_spend
    FROM a GROUP BY o_custkey""",
)
def money_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums, means and extremes of amounts with six places, beyond 10^16, not finite, or missing."""
    kind = F.pmod("o_orderkey", F.lit(13))
    small = F.pmod("o_orderkey", F.lit(1_000_003)) / F.lit(1_000_000.0)
    odd = [
        float("nan"), float("inf"), float("-inf"), 1e16, -1e18, small, F.lit(None).cast("double"), 0.1, 123456789012.345678,
    ]
    amount = F.col("o_totalprice")
    for number, value in enumerate(odd):
        amount = F.when(kind == number, value).otherwise(amount)
    channel = F.when(F.col("o_orderstatus") == "F", "online").otherwise("instore")
    transactions = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.year("o_orderdate").alias("transaction_year"),
        F.month("o_orderdate").alias("transaction_month"),
        F.lit(False).alias("is_weekend"),
        channel.alias("channel"),
        amount.alias("amount"),
    )
    return transaction_rollup(transactions, roles.AS_OF).select(
        "customer_id",
        "total_transactions",
        "total_spend",
        "avg_transaction_value",
        "max_transaction_value",
        "min_transaction_value",
        "online_spend",
        "instore_spend",
    )


@query(
    "daily_customer_sketches",
    using(
        "transactions",
        """SELECT CAST(year(transaction_date) AS INTEGER) AS year, count(DISTINCT customer_id) AS customers, true AS near
           FROM transactions GROUP BY 1""",
    ),
)
def daily_customer_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per year from the stored sketches of its days, beside the exact count and within 4 percent of it."""
    transactions = roles.transactions(spark, sf_dir)
    sketches = materialize(customer_sketches(transactions), "sketches")
    year = F.year("transaction_date").alias("year")
    exact = transactions.groupBy(year).agg(F.count_distinct("customer_id").alias("exact"))
    estimated = customers_over(sketches, year).withColumnRenamed("year", "of")
    error = F.abs(F.col("customers") - F.col("exact"))
    return exact.join(estimated, F.col("year").eqNullSafe(F.col("of"))).select(
        "year", F.col("exact").alias("customers"), (error <= F.col("exact") * 0.04).alias("near")
    )
