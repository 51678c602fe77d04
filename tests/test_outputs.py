"""Operators with several outputs, written once."""

import pytest
from pyspark.sql import functions as F

from crmflow.operators import joins, outputs
from crmflow.storage import _folder
from tests.conftest import values


def sides(spark):
    left = spark.sql(
        """SELECT CASE WHEN id < 400 THEN 7 WHEN id % 5 = 0 THEN NULL ELSE id % 50 END AS k, id % 40 AS _salt, id AS n
           FROM range(1000) UNION ALL SELECT NULL, 1, 1 FROM range(30)"""
    )
    right = spark.sql(
        """SELECT CAST(id AS int) AS key, CAST(id % 3 AS int) AS n, 'x' AS _hit FROM range(5, 60)
           UNION ALL SELECT 7, 9, 'again' UNION ALL SELECT NULL, 0, NULL"""
    )
    return left, right


def test_join_outputs_are_those_of_the_three_queries(spark):
    left, right = sides(spark)
    keys = [("k", "key")]
    pairs, left_only, right_only = joins.join_outputs(left, right, keys)
    with outputs.JoinOutputs(left, right, keys) as found:
        assert values(found.matched) == values(pairs)
        assert values(found.left_only) == values(left_only)
        assert values(found.matched) == values(pairs)  # now from the flagged left rows
        assert values(found.right_only) == values(right_only)
        assert found.rows["left_only"] == left_only.count()
        assert found.rows["left_matched"] + found.rows["left_only"] == left.count()
        assert found.rows["right_matched"] + found.rows["right_only"] == right.count()


def test_join_outputs_of_two_keys_and_a_selection(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (1, None, 2.0), (2, "b", 3.0)], "k int, s string, x double")
    right = spark.createDataFrame([(1, "a", 5.0), (1, "b", 6.0), (None, "b", 7.0)], "k bigint, s string, x double")
    found = outputs.JoinOutputs(left, right, ["k", "s"], {"Right_x": "y", "s": None})
    assert found.matched.columns == ["k", "x", "y"] and values(found.matched) == [(1, 1.0, 5.0)]
    assert sorted(r["x"] for r in found.left_only.collect()) == [2.0, 3.0]
    assert sorted(r["x"] for r in found.right_only.collect()) == [6.0, 7.0]
    found.remove()


@pytest.mark.parametrize("empty_left", [True, False])
def test_join_outputs_with_an_empty_side(spark, empty_left):
    left, right = sides(spark)
    left, right = (left.limit(0), right) if empty_left else (left, right.limit(0))
    with outputs.JoinOutputs(left, right, [("k", "key")]) as found:
        assert found.matched.count() == 0
        assert values(found.left_only) == values(left) and values(found.right_only) == values(right)


def test_each_input_is_computed_once(spark):
    left, right = sides(spark)
    computed = {"left": spark.sparkContext.accumulator(0), "right": spark.sparkContext.accumulator(0)}

    def counted(df, name):
        def run(batches):
            for batch in batches:
                computed[name].add(batch.num_rows)
                yield batch

        return df.mapInArrow(run, df.schema)

    found = outputs.JoinOutputs(counted(left, "left"), counted(right, "right"), [("k", "key")])
    for df in (found.matched, found.left_only, found.right_only, found.matched):
        df.count()
    assert {name: n.value for name, n in computed.items()} == {"left": left.count(), "right": right.count()}


def test_adaptive_execution_splits_a_hot_key_of_the_flagged_side(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rows = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256)
        )
        keys = outputs.JoinOutputs._distinct(spark.range(0, 50_000).withColumnRenamed("id", "k"), ["k"])
        marked = outputs._marked(rows, ["k"], keys["all"], "_hit")
        marked.collect()
        assert "skew=true" in marked._jdf.queryExecution().executedPlan().toString()
        keys.remove()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_filter_outputs(spark):
    df = spark.createDataFrame([(1, "a"), (5, None), (None, "c"), (5, None)], "x int, _output string")
    with outputs.filter_outputs(df, "x > 3") as found:
        assert found.rows == {"true": 2, "false": 1, "null": 1} and list(found) == ["true", "false", "null"]
        assert values(found["true"]) == [(5, None), (5, None)] and values(found["null"]) == [(None, "c")]
        assert found["true"].columns == df.columns
        with pytest.raises(KeyError):
            found["other"]
    with outputs.filter_outputs(df, F.col("x") > 3, null_as_false=True) as found:
        assert found.rows == {"true": 2, "false": 2, "null": 0} and found["null"].count() == 0


def test_unique_outputs_and_their_folder(spark):
    left, _ = sides(spark)
    found = outputs.unique_outputs(left, ["k"], ["n"])
    assert found.rows["unique"] == left.select("k").distinct().count()
    assert values(found["unique"].unionByName(found["duplicate"])) == values(left)
    first = left.groupBy("k").agg(F.min("n"))
    assert values(found["unique"].select("k", "n")) == values(first)
    system, place = _folder(spark, found.path)
    assert system.exists(place)
    found.remove()
    assert not system.exists(place)
    empty = outputs.unique_outputs(left.limit(0), ["k"], ["n"])
    assert empty.rows == {"unique": 0, "duplicate": 0} and empty["unique"].count() == 0
