"""Plans: what must not be in them, and what must reach the scan."""

import re

import pytest

import __spark_entry__ as contract
from crmflow.operators import ordering, rows
from crmflow.workload import roles
from crmflow.workload.registry import QUERIES, table
from crmflow.session import cluster_settings

# These run jobs while they are built, or write files; their plans are covered below or are plain scans.
OWN_FILES = {n for n in contract.queries() if n.startswith(("src_", "sink_", "ingest_", "ext_", "conform_run", "business_run"))}

AUTOMATON = {"find_replace_any_texts"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - OWN_FILES))
def test_no_python_and_no_row_level_pairing(spark, small, name):
    plan = plan_of(contract.queries()[name](spark, small))
    python = re.findall(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)
    # An automaton has no built-in form: one pass over Arrow batches, at most, for its last block of keys.
    # Queries of optional packages choose their own style; what holds for every query is the pairing below.
    assert name not in QUERIES or python == [] or (name in AUTOMATON and python == ["ArrowEvalPython"])
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name", ["clv_percentile", "record_id", "running_total_global", "clv"])
def test_global_order_has_no_single_task_window(spark, small, name):
    """Only partial aggregates and one row per range partition may meet in one task."""
    lines = plan_of(contract.queries()[name](spark, small)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(text for text in lines[i + 1 :] if "HashAggregate" in text or "Scan" in text)
            assert re.search(r"HashAggregate\(keys=\[((_part|_bucket)#\d+L?)?\]", below), below


def test_rollups_combine_before_the_shuffle(spark, small):
    plan = plan_of(contract.queries()["profile_txn_rollup"](spark, small))
    assert plan.count("Exchange") == 2 and "partial_" in plan and "Expand" not in plan
    assert "SortAggregate" not in plan


def test_scan_reads_only_what_is_needed(spark, small):
    df = contract.queries()["daily_metrics"](spark, small)
    read = set(re.findall(r"o_\w+", "".join(re.findall(r"FileScan parquet \[([^\]]*)\]", plan_of(df)))))
    assert read == {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"}
    lines = contract.queries()["summarize_global"](spark, small)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan_of(lines)
    filtered = table(spark, small, "orders").where("o_totalprice > 1000").select("o_orderkey")
    assert "GreaterThan(o_totalprice,1000.0)" in plan_of(filtered)


def test_group_limit_is_applied_before_the_shuffle(spark, small):
    df = rows.first_rows_per_group(table(spark, small, "orders"), 3, ["o_custkey"], ["o_orderkey"])
    plan = plan_of(df)
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_segments_add_no_shuffle_to_the_profile(spark, small):
    profile = plan_of(contract.queries()["profile_full"](spark, small))
    segments = plan_of(contract.queries()["rfm_segments"](spark, small))
    assert segments.count("Exchange hash") <= profile.count("Exchange hash")


def test_conformed_tables_are_one_projection_each(spark, small):
    assert "Exchange" not in plan_of(roles.transactions(spark, small))
    assert "Exchange" not in plan_of(roles.insights(spark, small)).replace("BroadcastExchange", "")


def test_many_chunks_of_copies(spark, monkeypatch):
    from crmflow.operators.skew import SkewPolicy

    monkeypatch.setattr(ordering, "_COPIES_PER_CHUNK", 7)
    split = SkewPolicy(rows_per_task=20, probe_fraction=1.0)
    same = spark.sql("SELECT 1 AS x, 'a' AS y FROM range(100) UNION ALL SELECT 2, 'b' FROM range(3)")
    numbered = ordering.record_id(same, ["x"], policy=split).collect()
    assert sorted(r["RecordID"] for r in numbered) == list(range(1, 104))
    assert all((r["RecordID"] <= 100) == (r["x"] == 1) for r in numbered)
    ordered = [r["x"] for r in rows.sort_rows(same, [("x", "desc")], split).collect()]
    assert ordered == [2] * 3 + [1] * 100


def test_cluster_settings_grow_with_the_input():
    small = cluster_settings(10**9, 100)["spark.sql.shuffle.partitions"]
    large = cluster_settings(100 * 10**12, 8_000)["spark.sql.shuffle.partitions"]
    assert int(small) == 200 and int(large) > 700_000
