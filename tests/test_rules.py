"""Edge rows that the given tables do not hold."""

import random
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from crmflow.functions import scalar
from crmflow.operators import aggregate, filters, joins, project, quality, rows, text
from crmflow.operators.aggregate import Summary
from crmflow.operators.search import longest_keys
from crmflow.operators.skew import SkewPolicy
from crmflow.plans import bands, conform, segments
from crmflow.plans.bands import label
from crmflow.plans.campaigns import build_campaign_performance
from crmflow.plans.daily import build_daily_metrics, customer_sketches, customers_over
from crmflow.plans.lifetime import build_lifetime_value
from crmflow.plans.money import units
from crmflow.plans.profile import build_profile, loyalty_rollup, transaction_rollup
from crmflow.sources.files import literal_rows
from tests.conftest import values

AS_OF = date(2025, 3, 31)


def online(spark, data):
    schema = "OrderID int, CustomerID int, ProductID int, DateTime string, PaymentMethod string, Amount string, Status string"
    return spark.createDataFrame(data, schema)


def instore(spark, data):
    schema = "TransactionID int, CustomerID int, StoreID int, DateTime string, Amount string, PaymentMethod string"
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def transactions(spark):
    web = [
        (1, 1, 9, "2024-01-10 10:00:00", "Card", "20.10", "Completed"),
        (2, 1, 9, "2025-01-12 10:00:00", "Card", "30.20", "Failed"),
        (3, 2, 9, "2025-03-31 09:00:00", "Cash", "100", "Pending"),
        (4, 3, 9, "not a time", "Cash", "bad", "Completed"),
        (5, None, 9, "2025-02-01 00:00:00", "Cash", "7", "Completed"),
    ]
    shop = [(1, 1, 4, "2025-03-01 23:59:00", "5.55", "Card"), (2, 1, 4, "2025-03-02 08:00:00", None, "Card")]
    return conform.conform_transactions(online(spark, web), instore(spark, shop))


def customers(spark, ids=(1, 2, 3, 4)):
    data = [(i, f"n{i}", f"n{i}@x.org", "a") for i in ids]
    return conform.conform_customers(
        spark.createDataFrame(data, "CustomerID int, Name string, Email string, Address string")
    )


@pytest.mark.parametrize(
    "rules, given, expected",
    [
        (bands.AGE_GROUP, [17, 24, 25, 64, 65, None], ["18-24", "18-24", "25-34", "55-64", "65+", "65+"]),
        (
            bands.INCOME_BRACKET,
            [-5, 2999, 3000, 5000, 7500, None],
            ["Low (<3K)", "Low (<3K)", "Medium (3K-5K)", "High (5K-7.5K)", "Premium (7.5K+)", "Premium (7.5K+)"],
        ),
        (bands.CREDIT_TIER, [750, 749, 650, 649, None], ["Excellent", "Good", "Fair", "Poor", "Poor"]),
        (bands.PRICE_TIER, [99, 100, 250, 400, None], ["Budget", "Mid-Range", "Premium", "Luxury", "Luxury"]),
        (bands.ENGAGEMENT_LEVEL, [10, 9, 4, 0, None], ["High", "Medium", "Low", "None", "None"]),
        (bands.R_SCORE, [30, 31, 61, 91, 181, None], [5, 4, 3, 2, 1, 1]),
        (bands.F_SCORE, [10, 5, 3, 1, 0, None], [5, 4, 3, 2, 1, 1]),
        (bands.M_SCORE, [1000, 500, 200, 50, 49, None], [5, 4, 3, 2, 1, 1]),
        (bands.CLV_TIER, [1000, 999, 499, 199, None], ["Platinum", "Gold", "Silver", "Bronze", "Bronze"]),
    ],
)
def test_number_bands(spark, rules, given, expected):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, x int")
    found = df.select("i", label(F.col("x"), rules).alias("b")).orderBy("i").collect()
    assert [row["b"] for row in found] == expected


def test_text_bands(spark):
    df = spark.createDataFrame([("Platinum",), ("Bronze",), ("Odd",), (None,)], "t string")
    assert [r[0] for r in df.select(label(F.col("t"), bands.TIER_RANK)).collect()] == [4, 1, 0, 0]
    issues = spark.createDataFrame([("Billing",), ("Product Inquiry",), (None,)], "t string")
    assert [r[0] for r in issues.select(label(F.col("t"), bands.ISSUE_CATEGORY)).collect()] == [
        "Technical",
        "Inquiry",
        "Other",
    ]


def test_segments_of_all_score_cells(spark):
    cells = spark.createDataFrame(list(product(range(1, 6), repeat=3)), "r_score int, f_score int, m_score int")
    counts = dict(cells.groupBy(segments.segment().alias("s")).count().collect())
    assert counts == {
        "Champions": 8,
        "Loyal Customers": 10,
        "New Customers": 20,
        "Potential Loyalists": 27,
        "At Risk": 18,
        "Hibernating": 20,
        "Lost": 12,
        "Needs Attention": 10,
    }
    fixed = dict(cells.groupBy(segments.segment(fix_unreachable=True).alias("s")).count().collect())
    assert fixed["Can't Lose Them"] == 8 and fixed["At Risk"] == 10


def test_emails(spark):
    given = [None, "plain", "a@b.org", "a@b@c.org", "a+x@b.org", "a@"]
    df = spark.createDataFrame(
        [(str(i), None, e, None) for i, e in enumerate(given)],
        "CustomerID string, Name string, Email string, Address string",
    )
    found = conform.conform_customers(df).orderBy("customer_id").collect()
    assert [r["email_domain"] for r in found] == [None, None, "b.org", "b", "b.org", ""]
    assert [r["is_valid_email"] for r in found] == [None, False, True, False, False, False]


def test_bad_values_become_null(transactions):
    bad = transactions.where("transaction_id = 4").first()
    assert bad["amount"] is None and bad["transaction_datetime"] is None
    assert bad["transaction_date"] is None and bad["is_weekend"] is False
    shop = transactions.where("channel = 'instore' AND transaction_id = 1").first()
    assert shop["status"] == "Completed" and shop["product_id"] is None and shop["is_weekend"] is True


def test_transaction_rollup(transactions):
    rollup = {r["customer_id"]: r for r in transaction_rollup(transactions, AS_OF).collect()}
    one = rollup[1]
    assert (one["total_transactions"], one["total_spend"]) == (4, 55.85)
    assert one["avg_transaction_value"] == pytest.approx(55.85 / 3)
    assert (one["active_months"], one["active_year_months"]) == (2, 3)  # January of two years, and March
    assert (one["channels_used"], one["online_spend"], one["instore_spend"]) == (2, 50.3, 5.55)
    assert one["days_since_last_transaction"] == 29 and one["first_transaction_date"] == date(2024, 1, 10)
    three = rollup[3]
    assert (three["total_spend"], three["avg_transaction_value"], three["active_months"]) == (None, None, 0)
    assert three["online_spend_pct"] == 0.0 and three["last_transaction_date"] is None
    assert rollup[None]["total_transactions"] == 1
    done = transaction_rollup(transactions, AS_OF, status_filter=["Completed"])
    assert done.where("customer_id = 1").first()["total_transactions"] == 3


def test_loyalty_tier_by_name_and_by_rank(spark):
    data = [(1, 1, 5, "Silver", date(2025, 3, 1)), (2, 1, 9, "Platinum", date(2024, 3, 31)), (3, 2, 1, "Odd", None)]
    raw = spark.createDataFrame(
        data, "LoyaltyID int, CustomerID int, PointsEarned int, TierLevel string, JoinDate date"
    )
    conformed = conform.conform_loyalty(raw, AS_OF)
    assert [r["tenure_months"] for r in conformed.orderBy("loyalty_id").collect()] == [1, 12, None]
    one = loyalty_rollup(conformed).where("customer_id = 1").first()
    assert (one["loyalty_tier"], one["best_tier"], one["loyalty_tier_rank"]) == ("Silver", "Platinum", 4)
    assert (one["loyalty_points"], one["loyalty_accounts"]) == (9, 2)


def service(spark):
    data = [
        (1, 1, datetime(2025, 3, 1, 8), 1, "Billing", "Resolved"),
        (2, 1, datetime(2025, 3, 2, 8), 1, "Other", None),
    ]
    raw = spark.createDataFrame(
        data,
        "InteractionID int, CustomerID int, DateTime timestamp, AgentID int, IssueType string, ResolutionStatus string",
    )
    return conform.conform_service(raw)


def test_profile_fills_and_flags(spark, transactions):
    profile = build_profile(customers(spark), AS_OF, transactions, service=service(spark))
    found = {r["customer_id"]: r for r in profile.collect()}
    assert len(found) == 4
    never = found[4]
    assert (never["total_transactions"], never["total_spend"], never["avg_transaction_value"]) == (0, 0.0, 0.0)
    assert never["max_transaction_value"] is None and never["is_active"] is False
    assert (never["preferred_channel"], never["engagement_level"]) == ("Unknown", "None")
    assert never["has_support_issues"] is None and never["total_support_tickets"] == 0
    assert found[1]["has_support_issues"] is True and found[1]["support_resolution_rate"] == 50.0
    assert found[1]["preferred_channel"] == "Omnichannel"
    as_false = build_profile(customers(spark), AS_OF, service=service(spark), null_flags_as_false=True)
    assert as_false.where("customer_id = 4").first()["has_support_issues"] is False


def test_profile_without_transactions_still_feeds_the_rest(spark):
    profile = build_profile(customers(spark), AS_OF)
    row = profile.first()
    assert row["is_active"] is None and row["has_support_issues"] is False
    assert row["preferred_channel"] == "Unknown" and row["engagement_level"] == "None"
    scored = segments.build_segments(profile).first()
    assert (scored["recency_days"], scored["rfm_string"], scored["customer_segment"]) == (999, "111", "Hibernating")
    assert scored["churn_risk"] == "Critical" and scored["churn_risk_score"] == 4
    assert build_lifetime_value(profile).first()["purchase_frequency_annual"] == 0.0


def test_lifetime_value_of_a_first_purchase_today(spark, transactions):
    values_ = build_lifetime_value(build_profile(customers(spark), AS_OF, transactions))
    found = {r["customer_id"]: r for r in values_.collect()}
    assert found[2]["purchase_frequency_annual"] == 0.0 and found[2]["predicted_clv_5yr"] == 0.0
    assert found[2]["clv_percentile"] == 1.0 and found[2]["is_high_value"] is True
    assert found[3]["clv_percentile"] == found[4]["clv_percentile"] == 0.0
    assert found[1]["purchase_frequency_annual"] == 4 / 446 * 365


def test_daily_metrics_add_up(transactions):
    daily = build_daily_metrics(transactions)
    total = sum(r["total_revenue"] or 0 for r in daily.collect())
    assert total == pytest.approx(162.85)
    unknown = daily.where("transaction_date IS NULL").first()
    assert unknown["total_transactions"] == 1 and unknown["is_weekend"] is False
    assert unknown["total_revenue"] is None and unknown["online_revenue_pct"] == 0.0
    completed = build_daily_metrics(transactions, status_filter=["Completed"])
    assert completed.agg(F.sum("failed_orders")).first()[0] == 0


def insight_rows(spark, data):
    columns = ["CustomerID", "SessionStart", "SessionEnd", "Age", "CreditScore", "MonthlyIncome", "Price", "Cost"]
    columns += ["Quantity", "CampaignSchema ", "OrderConfirmation", "OrderReturn", "FullName", "Gender"]
    columns += ["Country", "State", "City"]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))


def test_insights_and_campaigns(spark):
    base = ["25", "700", "4000", "10.5", "4.5", "2"]
    tail = ["Ann", "F", "C", "S", "T"]
    data = [
        ("1", "2025-01-01 10:00:00", "x", *base, "Mail", "True", "False", *tail),
        ("1", "2025-01-02 10:00:00", None, *base, "Mail", "False", "True", *tail),
        ("2", "2025-01-02 10:00:00", None, None, None, None, "10", "4", "1", "Mail", "maybe", "yes", *tail),
        ("2", "2025-01-03 10:00:00", None, *base, "Web", "False", "True", *tail),
    ]
    insights = conform.conform_insights(insight_rows(spark, data))
    assert "campaign_source" in insights.columns
    odd = insights.where("monthly_income IS NULL").first()
    assert odd["order_confirmed"] is None and odd["order_returned"] is True
    assert (odd["age_group"], odd["income_bracket"], odd["credit_tier"]) == ("65+", "Premium (7.5K+)", "Poor")
    found = {r["campaign_source"]: r for r in build_campaign_performance(insights).collect()}
    mail, web = found["Mail"], found["Web"]
    assert (mail["conversions"], mail["total_revenue"], mail["total_profit"]) == (1, 21.0, 12.0)
    assert (mail["returns"], mail["return_rate"], mail["profit_margin_pct"]) == (2, 200.0, 57.14)
    assert (web["return_rate"], web["avg_order_value"], web["campaign_rank"]) == (0.0, None, 2)
    latest = conform.customers_from_insights(insights)
    assert latest.count() == 2 and latest.where("customer_id = 2").first()["age"] == 25


def test_split_filter_nulls(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    true, false = filters.filter_split(df, "x > 3")
    assert (true.count(), false.count()) == (1, 1)
    _, rest = filters.filter_split(df, F.col("x") > 3, null_as_false=True)
    assert rest.count() == 2
    with pytest.raises(ValueError):
        filters.simple_predicate(df, "x", "~", "1")


def test_select_unknown_and_types(spark):
    df = spark.createDataFrame([("1", "x", 2)], "a string, b string, c int")
    kept = project.select_fields(df, keep=["a"], rename={"a": "A"}, types={"a": "int"}, keep_unknown=True)
    assert kept.columns == ["A", "b", "c"] and kept.first()["A"] == 1
    assert project.select_fields(df, keep=["b", "a"], drop=["b"]).columns == ["a"]
    assert project.rename_columns(df.withColumnRenamed("c", "c "), {"c": "z", "q": "w"}).columns == ["a", "b", "z"]


def test_literal_rows(spark):
    df = literal_rows(spark, ["a", "b"], [["1", ""], [None, "x"]])
    assert values(df) == sorted([("1", None), (None, "x")], key=repr)
    assert literal_rows(spark, [], []).columns == []


def test_quality_on_lineage_and_nulls(spark):
    data = [(1, None, 3), (1, None, 2), (1, "x", 1), (None, None, 5)]
    df = spark.createDataFrame(data, "a int, b string, _ingestion_timestamp int")
    assert values(quality.null_counts(df)) == [("a", 1), ("b", 3)]
    assert tuple(quality.duplicate_count(df).first()) == (4, 3, 1)
    kept = quality.drop_exact_duplicates(df)
    assert kept.columns == df.columns
    assert (1, None, 2) in values(kept) and kept.count() == 3
    report = quality.quality_report(df, "t").first()
    assert (report["rows_removed"], report["null_counts"]) == (1, {"a": 1, "b": 3})


def test_auto_field_and_impute(spark):
    data = [("1", "007", "1.5", "2024-01-02", "2024-01-02 03:00:00", "x", None), ("2", "8", "2", None, None, "1", None)]
    df = spark.createDataFrame(data, "a string, b string, c string, d string, e string, f string, g string")
    assert quality.narrow_types(df) == {
        "a": "int",
        "b": "string",
        "c": "double",
        "d": "date",
        "e": "timestamp",
        "f": "string",
        "g": "string",
    }
    kept = [("12345678901234567890", "5d", "12:30", "1e3"), ("12345678901234567891", "10f", "13:00", "2.5")]
    kept = spark.createDataFrame(kept, "a string, b string, c string, d string")
    assert quality.narrow_types(kept) == {"a": "string", "b": "string", "c": "string", "d": "double"}
    with_gap = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (10.0,), (None,)], "x double")
    filled = {
        m: quality.impute(with_gap, {"x": m}).agg(F.sum("x")).first()[0] - 23.0
        for m in ("mean", "median", "mode", ("constant", 4))
    }
    assert filled == {"mean": 5.75, "median": 6.0, "mode": 10.0, ("constant", 4): 4.0}


def test_auto_field_dates_beyond_timestamps(spark):
    data = [("300000", "300000", "300000-05-06", "2024-01-02"), ("1", "x", "2024-01-02", "300000-05-06 10:00:00")]
    df = spark.createDataFrame(data, "a string, b string, c string, d string")
    assert quality.narrow_types(df) == {"a": "int", "b": "string", "c": "date", "d": "string"}


def test_text_split(spark):
    df = spark.createDataFrame([("a|b|c",), ("a",), (None,), ("|",)], "t string")
    split = text.text_to_columns(df, "t", "|", 2, "p")
    assert [(r["p1"], r["p2"]) for r in split.collect()] == [("a", "b"), ("a", None), (None, None), ("", "")]
    assert text.text_to_columns(df, "t").columns == ["t", "t1", "t2"]
    assert text.text_to_rows(df, "t", "|").count() == 7


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("a.b", "")], "t string, e string")
    row = df.select(
        scalar.replace_text(F.col("t"), ".", "-").alias("r"),
        scalar.find_text(F.col("t"), "z").alias("f"),
        scalar.is_empty(F.col("e")).alias("e"),
        scalar.regex_found(F.col("e"), "x*").alias("m"),
        scalar.regex_found(F.col("e"), "x*", allow_empty=True).alias("m0"),
        scalar.to_date(F.lit("2024-02-30")).alias("d"),
    ).first()
    assert tuple(row) == ("a-b", 0, True, False, True, None)


def test_find_replace_modes(spark):
    df = spark.createDataFrame([(1, "abcabc"), (2, "zab"), (3, None), (4, "abx")], "i int, t string")
    lookup = spark.createDataFrame(
        [("ab", "1", "p"), ("abc", "2", "q"), ("ab", "3", "r"), (None, "9", "s"), ("", "8", "u")],
        "f string, new string, extra string",
    )
    whole = joins.find_replace(df, "t", lookup, "f", "new")
    assert values(whole) == [(1, "abcabc"), (2, "zab"), (3, None), (4, "abx")]
    start = joins.find_replace(df, "t", lookup, "f", "new", append=["extra"], mode="start")
    assert values(start) == [(1, "2abc", "q"), (2, "zab", None), (3, None, None), (4, "1x", "p")]
    anywhere = joins.find_replace(df, "t", lookup, "f", "new", mode="any")
    assert values(anywhere) == [(1, "22"), (2, "z1"), (3, None), (4, "1x")]
    with pytest.raises(ValueError):
        joins.find_replace(df, "t", lookup, "f", "new", mode="end")


def test_append_fields_refuses_a_large_source(spark):
    with pytest.raises(ValueError):
        joins.append_fields(spark.range(2), spark.range(5).toDF("x"), max_source_rows=4)
    assert joins.append_fields(spark.range(2), spark.range(4).toDF("x"), max_source_rows=4).count() == 8


def test_join_name_clash_and_select(spark):
    left = spark.createDataFrame([(1, "l"), (None, "n")], "k int, v string")
    right = spark.createDataFrame([(1, "r"), (2, "s")], "k int, v string")
    joined = joins.join_tables(left, right, ["k"], "outer", {"Right_v": "w"})
    assert joined.columns == ["k", "v", "w"]
    assert values(joined) == sorted([(1, "l", "r"), (None, "n", None), (2, None, "s")], key=repr)


def test_summarize_unordered_first_is_refused(spark):
    with pytest.raises(ValueError):
        aggregate.summarize(spark.range(3), [], [Summary("id", "First")])
    kept = aggregate.summarize(spark.range(3), [], [Summary("id", "Last")], [("id", "desc")]).first()
    assert kept["id"] == 0


def test_generate_rows_limits(spark):
    df = spark.createDataFrame([(1, 3), (5, 2), (2, 2)], "a int, b int")
    up = rows.generate_rows(df, "n", F.col("a"), F.col("b"))
    assert sorted(r["n"] for r in up.collect()) == [1, 2, 2, 3]
    down = rows.generate_rows(df, "n", F.col("a"), F.col("b"), -2)
    assert sorted(r["n"] for r in down.collect()) == [2, 3, 5]
    none = rows.generate_rows(df, "n", 1, 9, 0)
    assert none.count() == 0
    chunked = SkewPolicy(rows_per_task=4)
    for stop, step in ((30, 3), (-31, -3), (4, 1), (3, 1)):
        long = rows.generate_rows(df, "n", F.lit(0), stop, step, chunked)
        assert sorted(r["n"] for r in long.collect()) == sorted(3 * list(range(0, stop + (1 if step > 0 else -1), step)))


def test_upsert_latest_wins(spark):
    schema = "k int, v int, x string"
    current = spark.createDataFrame([(1, 1, "old"), (2, 5, "kept"), (3, 1, "tie")], schema)
    changes = spark.createDataFrame([(1, 2, "new"), (2, 4, "late"), (3, 1, "won"), (4, 1, "added")], schema)
    merged = rows.upsert(current, changes, ["k"], "v")
    assert values(merged) == [(1, 2, "new"), (2, 5, "kept"), (3, 1, "won"), (4, 1, "added")]


def test_find_replace_with_very_many_keys(spark):
    """Above the number of keys that are tried per row, the substring join gives the same."""
    texts = spark.range(300).select(F.concat(F.lit("k"), F.col("id") % 40, F.lit("-k"), F.col("id")).alias("t"))
    many = spark.range(600).select(F.concat(F.lit("k"), F.col("id")).alias("f"), F.concat(F.lit("<"), "id", F.lit(">")).alias("n"))

    def longest(value, mode):
        keys = [f"k{i}" for i in range(600)]
        fitting = [k for k in keys if (value.startswith(k) if mode == "start" else k in value)]
        if not fitting:
            return value
        best = sorted(fitting, key=lambda k: (-len(k), k))[0]
        new = f"<{best[1:]}>"
        return new + value[len(best):] if mode == "start" else value.replace(best, new)

    given = [r["t"] for r in texts.collect()]
    for mode in ("start", "any"):
        found = joins.find_replace(texts, "t", many, "f", "n", mode=mode)
        assert sorted(r["t"] for r in found.collect()) == sorted(longest(v, mode) for v in given)
        small = joins.find_replace(texts, "t", many.where("f IN ('k1', 'k12')"), "f", "n", mode=mode)
        assert small.count() == 300


def test_broadcast_check_measures_rows_and_bytes(spark):
    from crmflow.operators.skew import fits_broadcast

    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("t"), F.array("id").alias("a"))
    assert fits_broadcast(wide)
    assert not fits_broadcast(wide, SkewPolicy(broadcast_rows=9))
    assert not fits_broadcast(wide, SkewPolicy(broadcast_bytes=5_000))


def test_money_is_exact(spark):
    """Sums of decimals as written, whatever the order; one rule for what is no amount."""
    nan, inf = float("nan"), float("inf")
    amounts = [0.1, 0.2, 0.3, 1e-10, 2.5e-11, 1e16, -1e16, 123456789.123456, 9e17, -9e17, 0.00005, 12345678901.2345]
    rng = random.Random(1)
    amounts += [round(rng.uniform(-1e6, 1e6), rng.randrange(8)) for _ in range(2000)]
    want = sum(Decimal(repr(a)).quantize(Decimal("1e-10"), ROUND_HALF_UP) for a in amounts)
    for _ in range(2):
        rng.shuffle(amounts)
        rows = spark.createDataFrame([(a,) for a in [*amounts, nan, inf, -inf, None, 1e18, -1e300]], "a double")
        found = rows.repartition(7).agg(F.sum(units(F.col("a"))), F.count(units(F.col("a")))).first()
        assert found[0] == want * 10_000 and found[1] == len(amounts)
    for kind in ("int", "bigint", "decimal(20,7)", "float"):
        one = spark.createDataFrame([("7.25",)], "a string").select(F.col("a").cast("double").cast(kind).alias("a"))
        assert float(one.select(units(F.col("a"))).first()[0]) in (70_000.0, 72_500.0)


def test_one_rule_for_amounts(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, nan), (1, 5.0), (1, inf), (2, -inf), (2, None), (3, 1e16), (3, 0.000001), (3, 1e18)]
    transactions = spark.createDataFrame(rows, "customer_id bigint, amount double").selectExpr(
        "*", "date'2024-01-01' AS transaction_date", "2024 AS transaction_year", "1 AS transaction_month",
        "false AS is_weekend", "'online' AS channel",
    )
    found = transaction_rollup(transactions, "2024-02-01").select(
        "customer_id", "total_spend", "avg_transaction_value", "max_transaction_value", "min_transaction_value"
    )
    assert sorted(map(tuple, found.collect())) == [
        (1, 5.0, 5.0, 5.0, 5.0), (2, None, None, None, None), (3, 1e16, 5e15, 1e16, 0.000001)
    ]


def test_longest_keys_by_brute_force(spark):
    rng = random.Random(2)
    keys = ["".join(rng.choice("abé語") for _ in range(rng.randrange(1, 6))) for _ in range(300)] + ["", None]
    texts = ["".join(rng.choice("abcé語🙂") for _ in range(rng.randrange(0, 60))) for _ in range(200)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    table = spark.createDataFrame([(k,) for k in keys + keys[:50]], "k string")
    want = {
        i: min((k for k in keys if k and t and k in t), key=lambda k: (-len(k), k), default=None)
        for i, t in enumerate(texts)
    }
    for block_bytes in (1 << 20, 300):
        found = longest_keys(df, "t", table, "k", "best", block_bytes)
        assert {r["i"]: r["best"] for r in found.collect()} == want
    assert longest_keys(df, "t", table.limit(0), "k", "best").where("best IS NOT NULL").count() == 0


def test_many_keys_in_long_texts(spark):
    """A hundred thousand keys and texts of twenty thousand words: each text is read once."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**9):x}" for _ in range(20_000)]
    texts = [" ".join(rng.sample(words, len(words))) + (" needle-99999 needle-7" if i % 2 else "") for i in range(8)]
    lookup = spark.range(100_000).select(
        F.concat(F.lit("needle-"), "id").alias("f"), F.concat(F.lit("N"), "id").alias("n")
    )
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = joins.find_replace(df, "t", lookup, "f", "n", mode="any")
    for row in found.collect():
        want = texts[row["i"]].replace("needle-99999", "N99999")
        assert row["t"] == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "Generate" not in plan


def test_fixed_samples(spark, monkeypatch):
    df = spark.range(3000).withColumn("g", F.pmod("id", F.lit(7)))
    small = values(rows.fixed_sample(df, 100, ["id"], seed=1))
    assert len(small) == 100
    # Another partitioning and the plan for large samples choose the same rows.
    assert values(rows.fixed_sample(df.repartition(13), 100, ["id"], seed=1)) == small
    monkeypatch.setattr(rows, "_SORTED_SAMPLE", 0)
    assert values(rows.fixed_sample(df, 100, ["id"], seed=1)) == small
    assert values(rows.fixed_sample(df, 100, ["id"], seed=2)) != small
    assert rows.fixed_sample(df, 5000, ["id"]).count() == 3000
    assert rows.fixed_sample(df.limit(0), 5, ["id"]).count() == 0
    # Rows of one key are told apart by their content.
    assert rows.fixed_sample(df.withColumn("k", F.lit(None).cast("string")), 40, ["k"]).count() == 40


def test_customer_sketches_merge(spark):
    sales = spark.range(200_000).selectExpr(
        "id % 20000 AS customer_id", "date_add(date'2024-01-01', CAST(id % 60 AS INT)) AS transaction_date"
    )
    sketches = customer_sketches(sales)
    month = F.month("transaction_date").alias("month")
    exact = {r[0]: r[1] for r in sales.groupBy(month).agg(F.count_distinct("customer_id")).collect()}
    for row in customers_over(sketches, month).collect():
        assert abs(row["customers"] - exact[row["month"]]) <= 0.04 * exact[row["month"]]
    total = customers_over(sketches).first()["customers"]
    assert abs(total - 20_000) <= 800
    assert sketches.agg(F.max(F.length("customers"))).first()[0] < 20_000
