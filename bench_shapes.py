"""Time our plans against the plainer plan shapes they replace, on enlarged transactions.

The transactions of BENCH_SF_DIR are written BENCH_COPIES times (default 40) with
shifted customers to the shared folder, then each pair runs BENCH_RUNS times.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, Window, functions as F

from crmflow.operators import quality
from crmflow.operators.ranking import percent_rank
from crmflow.plans.profile import transaction_rollup
from crmflow.session import local_session
from crmflow.storage import materialize
from crmflow.workload import roles


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def global_window(spend: DataFrame) -> None:
    """Every row sorted in one task."""
    drain(spend.withColumn("p", F.percent_rank().over(Window.orderBy("total_spend"))))


def split_rank(spend: DataFrame) -> None:
    drain(percent_rank(spend, ["total_spend"], "p"))


def null_count_per_column(df: DataFrame) -> None:
    """One job per column, then a distinct count."""
    for column in df.columns:
        df.where(F.col(column).isNull()).count()
    df.count()
    df.distinct().count()


def null_counts_in_one_pass(df: DataFrame) -> None:
    quality.quality_report(df, "transactions").collect()


def distinct_counts_by_expansion(df: DataFrame) -> None:
    """Several distinct counts in one aggregate: every row is expanded per distinct column."""
    amount, online = F.col("amount"), F.col("channel") == "online"
    drain(
        df.groupBy("customer_id").agg(
            F.count(F.lit(1)),
            F.sum(amount),
            F.avg(amount),
            F.max(amount),
            F.min(amount),
            F.max("transaction_date"),
            F.min("transaction_date"),
            F.count_distinct("transaction_month"),
            F.count_distinct("channel"),
            F.sum(F.when(online, amount).otherwise(0)),
            F.sum(F.when(~online, amount).otherwise(0)),
        )
    )


def distinct_counts_by_mask(df: DataFrame) -> None:
    drain(transaction_rollup(df, roles.AS_OF))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "40"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "crmflow-bench-shapes")
    once = roles.transactions(spark, sf_dir)
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    shifted = once.withColumn("copy", copy).withColumn(
        "customer_id", F.col("customer_id") + F.col("copy") * 1_000_000
    )
    transactions = materialize(shifted.repartition(32).drop("copy"), "shapes")
    spend = materialize(transaction_rollup(transactions, roles.AS_OF).select("customer_id", "total_spend"), "spend")
    pairs = {
        "percentile": (spend, global_window, split_rank),
        "quality": (transactions, null_count_per_column, null_counts_in_one_pass),
        "rollup": (transactions, distinct_counts_by_expansion, distinct_counts_by_mask),
    }
    result = {}
    for name, (df, plain, ours) in pairs.items():
        for label, run in (("plain", plain), ("ours", ours)):
            run(df)
            times = []
            for _ in range(runs):
                started = time.perf_counter()
                run(df)
                times.append(time.perf_counter() - started)
            result[f"{name}_{label}"] = round(statistics.median(times), 3)
            print(name, label, result[f"{name}_{label}"], file=sys.stderr, flush=True)
    print(json.dumps({"rows": transactions.count(), "customers": spend.count(), "seconds": result}))


if __name__ == "__main__":
    main()
