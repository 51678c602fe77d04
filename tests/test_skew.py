"""The plans for hot groups give the same rows as the plain ones, and keep groups apart."""

import pytest
from pyspark.sql import Window, functions as F

from crmflow.operators import aggregate, joins, ordering, quality, ranking, rows
from crmflow.operators.aggregate import Summary
from crmflow.operators.skew import SkewPolicy, hot_groups, join_unique
from crmflow.storage import materialize
from tests.conftest import values

# So small that ordinary test groups count as hot.
SPLIT = SkewPolicy(rows_per_task=20, probe_fraction=1.0)
NO_BROADCAST = SkewPolicy(rows_per_task=20, probe_fraction=1.0, broadcast_rows=0)


@pytest.fixture(scope="module")
def sales(spark):
    """A third of the rows on key 0, some on NULL, many ties, and 60 identical copies."""
    ids = spark.range(600)
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 80)
    df = ids.select(
        key.cast("bigint").alias("k"),
        (F.col("id") % 7).alias("o"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 13).alias("v"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"),
    )
    copy = spark.createDataFrame([(0, 3, 5, "same")], df.schema)
    copies = copy.crossJoin(spark.range(60).select()).select(*df.columns)
    return materialize(df.unionByName(copies).repartition(5), "sales")


def order(*keys):
    return ["o", "t", *keys]


def test_probe_finds_only_hot_groups(sales):
    hot = hot_groups(sales, ["k"], SPLIT)
    assert {row["k"] for row in hot.collect()} == {0}
    assert hot_groups(sales, ["k"]) is None


@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_number_rows(sales, direction):
    keys = [("o", direction), "t"]
    plain = ordering.number_rows(sales, ["k"], keys)
    split = ordering.number_rows(sales, ["k"], keys, policy=SPLIT)
    assert values(split) == values(plain)


def test_number_rows_with_null_group_hot(sales):
    policy = SkewPolicy(rows_per_task=3, probe_fraction=1.0)
    assert hot_groups(sales, ["k"], policy).where("k IS NULL").count() == 1
    assert values(ordering.number_rows(sales, ["k"], order(), policy=policy)) == values(
        ordering.number_rows(sales, ["k"], order())
    )


@pytest.mark.parametrize("policy", [SPLIT, SkewPolicy()])
def test_record_ids_are_dense(sales, policy):
    numbered = ordering.record_id(sales, order(), policy=policy)
    ids = [row["RecordID"] for row in numbered.collect()]
    assert sorted(ids) == list(range(1, sales.count() + 1))
    window = Window.orderBy("o", "t")
    expected = sales.withColumn("RecordID", F.row_number().over(window)).select("RecordID", *sales.columns)
    assert values(numbered) == values(expected)


def test_record_id_start(sales):
    first = ordering.record_id(sales, order(), "n", start=100).agg(F.min("n"), F.max("n")).first()
    assert tuple(first) == (100, 100 + sales.count() - 1)


@pytest.mark.parametrize("groups", [["k"], []])
def test_running_total(sales, groups):
    window = Window.partitionBy(*groups).orderBy("o", "t").rowsBetween(Window.unboundedPreceding, 0)
    expected = sales.withColumn("total", F.sum("v").over(window))
    split = ordering.running_total(sales, "v", order(), groups, "total", SPLIT)
    assert values(split) == values(expected)


@pytest.mark.parametrize("groups", [["k"], []])
def test_neighbour_rows(sales, groups):
    wanted = {"before": ("t", -1), "after": ("v", 2)}
    window = Window.partitionBy(*groups).orderBy("o", "t")
    expected = sales.withColumns({"before": F.lag("t").over(window), "after": F.lead("v", 2).over(window)})
    split = ordering.neighbour_rows(sales, wanted, order(), groups, SPLIT)
    assert values(split) == values(expected)


@pytest.mark.parametrize("groups", [["k"], []])
@pytest.mark.parametrize("buckets", [4, 1000])
def test_rank_rows(sales, groups, buckets):
    split = ranking.rank_rows(sales, groups, [("o", "desc")], buckets, SPLIT)
    ties = Window.partitionBy(*groups).orderBy(F.col("o").desc())
    expected = sales.withColumns(
        {
            "rank": F.rank().over(ties).cast("bigint"),
            "dense_rank": F.dense_rank().over(ties).cast("bigint"),
            "percent_rank": F.percent_rank().over(ties),
        }
    )
    assert values(split.drop("row_number", "ntile")) == values(expected)
    sizes = split.groupBy(*groups, "ntile").count().groupBy(*groups)
    spread = sizes.agg((F.max("count") - F.min("count")).alias("d"), F.max("ntile").alias("tiles"))
    assert all(row["d"] <= 1 for row in spread.collect())
    plain_tiles = sales.withColumn(
        "n", F.ntile(buckets).over(Window.partitionBy(*groups).orderBy(F.col("o").desc(), "t"))
    )
    assert values(split.groupBy(*groups, "ntile").count()) == values(plain_tiles.groupBy(*groups, "n").count())


@pytest.mark.parametrize("key", ["v", ("v", "desc"), "t"])
def test_percent_rank_with_ties_and_nulls(sales, key):
    order_by = ordering.order_columns([key])
    expected = sales.withColumn("p", F.percent_rank().over(Window.orderBy(*order_by)))
    for policy in (SPLIT, SkewPolicy()):
        assert values(ranking.percent_rank(sales, [key], "p", policy)) == values(expected)


@pytest.mark.parametrize("kind", ["double", "float", "bigint", "decimal(12,3)"])
def test_percent_rank_of_numbers(spark, kind):
    """Mostly zeros, negatives, NULLs, and for doubles an infinity and NaN."""
    ids = spark.range(3000)
    mixed = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 31 != 1, (F.col("id") * 7919 % 1013 - 500) / 8)
    df = ids.select(mixed.cast(kind).alias("x"))
    if kind == "double":
        df = df.unionByName(spark.sql("SELECT CAST(s AS DOUBLE) AS x FROM VALUES ('Infinity'), ('NaN'), ('-Infinity'), ('NaN') AS t(s)"))
    expected = df.withColumn("p", F.percent_rank().over(Window.orderBy("x")))
    found = ranking.percent_rank(df, ["x"], "p")
    assert list(map(repr, values(found))) == list(map(repr, values(expected)))


@pytest.mark.parametrize("parts", [2, 400])
def test_percent_rank_in_any_number_of_parts(spark, parts):
    """A value may end one part, fill the next ones and begin another; there may be more parts than values."""
    ids = spark.range(2000)
    runs = F.when(F.col("id") < 1200, F.lit(5.0)).when(F.col("id") < 1300, F.lit(None)).otherwise(F.col("id") % 37)
    df = ids.select("id", runs.cast("double").alias("x"))
    expected = df.withColumn("p", F.percent_rank().over(Window.orderBy("x")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    merge = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert values(ranking.percent_rank(df, ["x"], "p")) == values(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)


def test_percent_rank_of_few_rows(spark):
    one = spark.createDataFrame([(5.0,)], "x double")
    assert ranking.percent_rank(one, ["x"], "p").first()["p"] == 0.0
    assert ranking.percent_rank(one.limit(0), ["x"], "p").count() == 0


@pytest.mark.parametrize("policy", [SPLIT, SkewPolicy()])
def test_unique_split_partitions_the_input(sales, policy):
    unique, duplicates = rows.unique_split(sales, ["k"], order(), policy)
    assert unique.count() == sales.select("k").distinct().count()
    assert values(unique.unionByName(duplicates)) == values(sales)
    assert values(unique) == values(rows.unique_rows(sales, ["k"], order()))


def test_first_rows_per_group_above_the_map_side_limit(sales):
    for n in (2, 1500):
        few = rows.first_rows_per_group(sales, n, ["k"], order(), SPLIT)
        window = Window.partitionBy("k").orderBy("o", "t")
        expected = sales.withColumn("r", F.row_number().over(window)).where(F.col("r") <= n).drop("r")
        assert values(few) == values(expected)


@pytest.mark.parametrize("policy", [SPLIT, SkewPolicy()])
def test_sort_keeps_copies_and_order(sales, policy):
    ordered = rows.sort_rows(sales, [("o", "desc"), "v"], policy)
    found = [(row["o"], row["v"]) for row in ordered.collect()]
    assert found == sorted(found, key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
    assert values(ordered) == values(sales)


def test_sort_splits_copies_over_tasks(spark):
    copies = spark.range(10_000).select(F.lit(1).alias("x"))
    assert rows.sort_rows(copies, ["x"], SPLIT).count() == 10_000


def lookup(spark):
    return spark.createDataFrame([(0, "zero"), (1, "one"), (4, "four"), (999, "none")], "k bigint, name string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_unique(spark, sales, how):
    names = lookup(spark)
    assert values(join_unique(sales, names, ["k"], how, SPLIT)) == values(sales.join(names, "k", how))


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
@pytest.mark.parametrize("swap", [False, True])
def test_join_tables_all_types(spark, sales, how, swap):
    names = lookup(spark).unionByName(spark.createDataFrame([(None, "null")], "k bigint, name string"))
    left, right = (names, sales) if swap else (sales, names)
    expected = left.join(right, "k", how)
    for policy in (SPLIT, SkewPolicy()):
        joined = joins.join_tables(left, right, ["k"], how, policy=policy)
        assert values(joined.select(*expected.columns)) == values(expected)


@pytest.mark.parametrize("policy", [SPLIT, SkewPolicy()])
def test_join_outputs_cover_both_sides(spark, sales, policy):
    names = lookup(spark)
    matched, left, right = joins.join_outputs(sales, names, ["k"], policy=policy)
    assert matched.count() + left.count() == sales.count()
    assert values(left) == values(sales.join(names, "k", "left_anti").select(*sales.columns))
    assert values(right) == [(999, "none")]
    assert left.where("k IS NULL").count() == sales.where("k IS NULL").count()


@pytest.mark.parametrize("policy", [SPLIT, NO_BROADCAST, SkewPolicy()])
def test_find_replace_and_dimensions_without_broadcast(spark, sales, policy):
    text = sales.withColumn("k", F.col("k").cast("string"))
    names = lookup(spark).withColumn("k", F.col("k").cast("string"))
    replaced = joins.find_replace(text, "k", names, "k", "name", policy=policy)
    expected = text.join(names, "k", "left").withColumn("k", F.coalesce("name", "k")).drop("name")
    assert values(replaced) == values(expected.select(*replaced.columns))
    joined = joins.lookup_dimensions(sales, [(lookup(spark), "k")], policy)
    assert values(joined) == values(sales.join(lookup(spark), "k", "left"))


@pytest.mark.parametrize("policy", [SPLIT, SkewPolicy()])
def test_concat_and_median_of_hot_groups(sales, policy):
    texts = aggregate.summarize(
        sales, ["k"], [Summary("v", "Concat", "text"), Summary("v", "Count", "n")], ["o", "t"], policy
    )
    lists = sales.groupBy("k").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("o", "t", "v")))),
                lambda s: s["v"].cast("string"),
            ),
            ",",
        ).alias("text"),
        F.count("v").alias("n"),
    )
    expected = lists.withColumn("text", F.when(F.col("n") > 0, F.col("text")))
    assert values(texts) == values(expected)
    parts = aggregate.concat_parts(sales, ["k"], "v", ["o", "t"], "text", rows_per_part=10, policy=policy)
    assert parts.agg(F.max(F.size(F.split("text", ",")))).first()[0] == 10
    median = quality.exact_median(sales, "v", policy).first()["median"]
    assert median == sales.agg(F.expr("percentile(v, 0.5)")).first()[0]


@pytest.mark.parametrize("policy", [SPLIT, SkewPolicy()])
def test_value_ranks_per_group(sales, policy):
    found = ordering.value_ranks(sales, [("v", "desc")], ["k"], policy)
    ties = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last())
    expected = sales.select(
        "k",
        "v",
        F.rank().over(ties).cast("bigint"),
        F.dense_rank().over(ties).cast("bigint"),
        F.count(F.lit(1)).over(Window.partitionBy("k", "v")),
        F.count(F.lit(1)).over(Window.partitionBy("k")),
    ).distinct()
    assert values(found) == values(expected)
