"""The given tables in the roles of the raw customer files.

Every role covers its whole table. Orders become transactions; their customers are
concentrated on low ids (the fourth power of the key), so that frequencies run from
none to very many and the hottest customer holds a large share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crmflow.plans import conform
from crmflow.workload.registry import table

AS_OF = "2001-08-02"
# Order priorities that play the online channel; all others are in-store.
WEB_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


_SIZES: dict[tuple[str, str], int] = {}


def _size(spark: SparkSession, sf_dir: str, name: str, key: str) -> Column:
    """Number of keys of a table whose keys start at 0; looked up once per process."""
    if (sf_dir, name) not in _SIZES:
        _SIZES[sf_dir, name] = table(spark, sf_dir, name).agg(F.max(key)).first()[0] + 1
    return F.lit(_SIZES[sf_dir, name]).cast("bigint")


def _cents(price: str) -> Column:
    return F.rint(F.col(price) * 100).cast("bigint")


def _choose(column: Column, values: dict[object, object], otherwise: object) -> Column:
    chain = F
    for key, value in values.items():
        chain = chain.when(column == key, F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    local = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
    host = F.concat(F.lower(F.replace(F.col("n_name"), F.lit("_"), F.lit("-"))), F.lit(".example.org"))
    email = (
        F.when(key % 70 == 0, F.lit(None))
        .when(key % 50 == 0, local)
        .when(key % 90 == 1, F.concat(local, F.lit("@"), host, F.lit("@x")))
        .otherwise(F.concat(local, F.lit("@"), host))
    )
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left").select(
        key.alias("CustomerID"),
        F.col("c_name").alias("Name"),
        email.alias("Email"),
        F.concat_ws(", ", "c_mktsegment", "n_name").alias("Address"),
    )


def _transactions(spark: SparkSession, sf_dir: str, online: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    customers = _size(spark, sf_dir, "customer", "c_custkey")
    square = _div(customer * customer, customers)
    amount = F.when(key % 97 != 0, _div(_cents("o_totalprice"), 5000) / F.lit(100.0))
    common = {
        "CustomerID": _div(square * square, customers),
        "DateTime": F.timestamp_add("HOUR", (key % 24).cast("int"), F.col("o_orderdate")),
        "PaymentMethod": F.col("o_orderpriority"),
        "Amount": amount,
    }
    if online:
        parts = _size(spark, sf_dir, "part", "p_partkey")
        status = _choose(F.col("o_orderstatus"), {"F": "Completed", "O": "Pending"}, "Failed")
        columns = {"OrderID": key, "ProductID": key % parts, "Status": status}
    else:
        stores = _size(spark, sf_dir, "supplier", "s_suppkey")
        columns = {"TransactionID": key, "StoreID": key % stores}
    on_web = F.col("o_orderpriority").isin(*WEB_PRIORITIES)
    side = orders.where(on_web if online else ~on_web)
    return side.select(*[c.alias(n) for n, c in {**columns, **common}.items()])


def online_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transactions(spark, sf_dir, online=True)


def instore_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transactions(spark, sf_dir, online=False)


def loyalty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    tiers = {"MACHINERY": "Platinum", "AUTOMOBILE": "Gold", "BUILDING": "Silver", "HOUSEHOLD": "Bronze"}
    return table(spark, sf_dir, "customer").select(
        key.alias("LoyaltyID"),
        _div(key * 2, 3).alias("CustomerID"),
        F.floor(F.abs("c_acctbal")).cast("int").alias("PointsEarned"),
        _choose(F.col("c_mktsegment"), tiers, "Other").alias("TierLevel"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key % 2000).cast("int")).alias("JoinDate"),
    )


def service_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    issues = {
        "error": "Technical Issue",
        "signup": "Billing",
        "click": "Complaint",
        "view": "Product Inquiry",
    }
    return table(spark, sf_dir, "events").select(
        key.alias("InteractionID"),
        F.col("user_id").alias("CustomerID"),
        F.timestamp_add("DAY", F.lit(-8218), F.col("ts")).alias("DateTime"),
        (key % 50).alias("AgentID"),
        _choose(F.col("event_type"), issues, "Other").alias("IssueType"),
        _choose(key % 3, {0: "Resolved", 1: "Escalated"}, "Pending").alias("ResolutionStatus"),
    )


def insights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key, who = F.col("o_orderkey"), F.col("c_custkey")
    cents = _cents("o_totalprice")
    start = F.timestamp_add("HOUR", (key % 24).cast("int"), F.col("o_orderdate"))
    returned = key % 7 == 0
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        start.alias("SessionStart"),
        F.timestamp_add("MINUTE", (key % 60).cast("int"), start).alias("SessionEnd"),
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("FullName"),
        _choose(who % 2, {0: "Female"}, "Male").alias("Gender"),
        F.when(who % 77 != 0, 16 + who % 60).cast("int").alias("Age"),
        (600 + who % 200).cast("int").alias("CreditScore"),
        F.when(who % 88 != 0, F.col("c_acctbal")).alias("MonthlyIncome"),
        F.concat(F.lit("Country "), F.col("c_nationkey").cast("string")).alias("Country"),
        F.concat(F.lit("State "), (who % 10).cast("string")).alias("State"),
        F.concat(F.lit("City "), (who % 100).cast("string")).alias("City"),
        F.col("c_mktsegment").alias("Category"),
        F.concat(F.lit("Product "), (key % 30).cast("string")).alias("Product"),
        (_div(cents * 6, 10_000) / F.lit(100.0)).alias("Cost"),
        (_div(cents, 1_000) / F.lit(100.0)).alias("Price"),
        (1 + key % 5).cast("int").alias("Quantity"),
        F.col("o_orderpriority").alias("CampaignSchema "),
        F.lit("Card").alias("PaymentMethod"),
        F.when(F.col("o_orderstatus") != "P", "True").otherwise("False").alias("OrderConfirmation"),
        F.when(returned, "True").otherwise("False").alias("OrderReturn"),
        F.when(returned, "Damaged").alias("ReturnReason"),
    )


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.col("p_type").alias("Category"),
        (F.col("p_retailprice") - 900 + F.col("p_size") * 8).alias("Price"),
    )


def stores_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("StoreID"),
        F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("Location"),
        F.col("s_name").alias("Manager"),
        F.concat((6 + key % 4).cast("string"), F.lit("-"), (18 + key % 5).cast("string")).alias("OpenHours"),
    )


# Conformed tables, with bigint keys as the given tables have.


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_customers(customers_raw(spark, sf_dir), "bigint")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_transactions(online_raw(spark, sf_dir), instore_raw(spark, sf_dir), "bigint")


def loyalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_loyalty(loyalty_raw(spark, sf_dir), AS_OF, "bigint")


def service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_service(service_raw(spark, sf_dir), "bigint")


def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_insights(insights_raw(spark, sf_dir), "bigint")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_products(products_raw(spark, sf_dir), "bigint")


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_stores(stores_raw(spark, sf_dir), "bigint")
