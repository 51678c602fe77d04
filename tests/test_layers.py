"""Reading, writing and running the layers."""

import gzip
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from crmflow.plans.layers import business_layer, conform_layer, ingest_files, ingest_folder
from crmflow.sources import files
from crmflow.sources.files import read_csv
from crmflow.sources.tables import LayerTables, add_lineage, replace_partitions, write_output
from crmflow.plans.daily import build_daily_metrics, daily_parts
from crmflow.storage import scratch_path, shared_dir
from crmflow.streaming import daily
from crmflow.streaming.daily import compact_daily_parts, read_daily_metrics, stream_daily_parts
from tests.conftest import values


@pytest.fixture
def layers(spark, tmp_path):
    run = tmp_path.name.replace("-", "_")
    names = {layer: f"t_{run}_{layer}" for layer in ("bronze", "silver", "gold")}
    return LayerTables(spark, names, str(tmp_path / "warehouse"))


def csv(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_folder_to_business_tables(spark, layers, tmp_path):
    base = tmp_path / "data"
    csv(base / "a", "Customers.csv", ["CustomerID,Name,Email,Address", '1,Ann,ann@x.org,"1 Road, Town"', "2,Bob,bob,x", "2,Bob,bob,x"])
    csv(
        base / "a" / "deep",
        "OnlineTransactions.csv",
        ["OrderID,CustomerID,ProductID,DateTime,PaymentMethod,Amount,Status", "1,1,1,2025-03-01 10:00:00,Card,99.99,Failed"],
    )
    csv(
        base,
        "InStoreTransactions.CSV",
        ["TransactionID,CustomerID,StoreID,DateTime,Amount,PaymentMethod", "1,2,1,2025-03-02 10:00:00,5.01,Cash"],
    )
    csv(base, "My-Extra File.csv", ["x,y", "1,2"])
    report = {r["table_name"]: r for r in ingest_folder(layers, str(base)).collect()}
    assert report["customers"]["status"] == "SUCCESS" and report["customers"]["row_count"] == 3
    assert report["my_extra_file"]["row_count"] == 1
    # A suffix in upper case makes no difference.
    assert (report["instore_transactions"]["status"], report["instore_transactions"]["row_count"]) == ("SUCCESS", 1)

    csv(base / "again", "InStoreTransactions.csv", (base / "InStoreTransactions.CSV").read_text().splitlines())
    ingest_folder(layers, str(base / "again"))
    as_of = date(2025, 3, 31)
    conformed = {r["table_name"]: (r["status"], r["row_count"]) for r in conform_layer(layers, as_of).collect()}
    assert conformed["customers"] == ("SUCCESS", 2)  # the repeated line is gone
    assert conformed["transactions"] == ("SUCCESS", 2)
    assert conformed["loyalty"] == ("SKIPPED", None)
    built = {r["table_name"]: (r["status"], r["row_count"]) for r in business_layer(layers, as_of).collect()}
    assert built["customer_360"] == built["customer_segments"] == built["customer_clv"] == ("SUCCESS", 2)
    assert built["campaign_performance"] == ("SKIPPED", None) and built["daily_metrics"] == ("SUCCESS", 2)
    assert "_gold_timestamp" in layers.read("customer_360", "gold").columns
    assert layers.read("customers", "silver").where("customer_id = 1").first()["full_address"] == "1 Road, Town"


def test_failed_table_leaves_the_others(spark, layers):
    layers.create("bronze")
    broken = spark.createDataFrame([(1,)], "Unrelated int")
    good = spark.createDataFrame([(1, "a", "m", "9-5")], "StoreID int, Location string, Manager string, OpenHours string")
    for name, df in (("loyalty_accounts", broken), ("stores", good)):
        layers.write(add_lineage(df, name), name, "bronze")
    report = {r["table_name"]: r for r in conform_layer(layers, "2025-03-31").collect()}
    assert report["loyalty"]["status"] == "ERROR" and report["loyalty"]["message"]
    assert report["stores"]["row_count"] == 1


def test_write_modes(spark, layers):
    layers.create("silver")
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    assert layers.write(one, "t", "silver") == 1
    assert layers.write(one.withColumn("w", F.lit(2.5)), "t", "silver", "append") == 1
    assert layers.write(one.select("k"), "t", "silver", "append") == 1
    assert sorted(map(tuple, layers.read("t", "silver").fillna(0.0).fillna("").collect())) == [
        (1, "", 0.0),
        (1, "a", 0.0),
        (1, "a", 2.5),
    ]
    with pytest.raises(TypeError):
        layers.write(spark.createDataFrame([("x",)], "k string"), "t", "silver", "append")
    with pytest.raises(ValueError):
        layers.write(one, "t", "silver", "replace")
    doubled = layers.read("t", "silver").unionByName(layers.read("t", "silver"))
    assert layers.write(doubled, "t", "silver") == 6
    assert layers.exists("t", "silver") and not layers.exists("other", "silver")
    assert layers.read_if_exists("other", "silver") is None


def test_unknown_layer_is_an_error(layers):
    with pytest.raises(ValueError):
        layers.full_name("t", "platinum")


def test_lineage_values(spark):
    row = add_lineage(spark.range(1), "f.csv", datetime(2025, 1, 2, 3), date(2025, 1, 2)).first()
    assert (row["_source_file"], row["_ingestion_timestamp"], row["_ingestion_date"]) == (
        "f.csv",
        datetime(2025, 1, 2, 3),
        date(2025, 1, 2),
    )
    assert add_lineage(spark.range(1), "f.csv").first()["_ingestion_date"] is not None


def test_profile_reports_bad_files(spark, tmp_path):
    csv(tmp_path, "a.csv", ["n,flag,t", "0,false,", "5,true,zz"])
    profile, errors = files.schema_profile(spark, [str(tmp_path / "a.csv"), str(tmp_path / "gone.csv")])
    found = {r["column_name"]: r for r in profile.collect()}
    assert (found["n"]["sample_value"], found["flag"]["sample_value"], found["t"]["sample_value"]) == ("0", "false", "zz")
    assert found["n"]["data_type"] == "int" and found["flag"]["data_type"] == "boolean"
    assert [r["file"] for r in errors.collect()] == [str(tmp_path / "gone.csv")]
    assert files.discover_csv(spark, str(tmp_path)).count() == 1


def test_replace_only_touched_partitions(spark):
    path = scratch_path(spark, "parts")
    write_output(spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, partition_by=["p"])
    replace_partitions(spark.createDataFrame([(9, "b")], "x int, p string"), path, ["p"])
    assert sorted((r["x"], r["p"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


class _Session:
    """Only what ``shared_dir`` looks at."""

    def __init__(self, master, folder=None):
        self.sparkContext = self
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.master = master


def test_shared_folder_is_the_configured_one():
    cluster = _Session("spark://host:7077", "hdfs://shared/folder/")
    assert shared_dir(cluster) == "hdfs://shared/folder"
    assert scratch_path(cluster, "x").startswith("hdfs://shared/folder/crmflow/x-")
    assert shared_dir(_Session("local[2]")) == shared_dir(_Session("local[8]"))
    with pytest.raises(RuntimeError):
        shared_dir(_Session("spark://host:7077"))


def test_failed_overwrite_keeps_the_old_table(spark, layers):
    layers.create("silver")
    old = spark.range(100).withColumn("day", F.pmod("id", F.lit(3)))
    assert layers.write(old, "kept", "silver", partition_by=["day"]) == 100
    shown = layers.version("kept", "silver")
    # Some tasks have written their files when another one fails.
    broken = spark.range(0, 100, 1, 8).withColumn(
        "day", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint")
    )
    with pytest.raises(Exception, match="lost"):
        layers.write(broken, "kept", "silver", partition_by=["day"])
    assert layers.version("kept", "silver") == shown and layers.versions("kept", "silver") == [shown]
    assert layers.read("kept", "silver").count() == 100
    assert layers.write(spark.range(7), "kept", "silver") == 7
    assert layers.read("kept", "silver").columns == ["id"] and layers.read("kept", "silver").count() == 7


def test_versions_are_kept_and_dropped(spark, layers):
    layers.create("silver")
    for rows in (1, 2, 3, 4):
        layers.write(spark.range(rows), "v", "silver")
        reader = layers.read("v", "silver")
    assert len(layers.versions("v", "silver")) == 2
    layers.write(spark.range(9), "v", "silver")
    assert reader.count() == 4, "a reader of the version before goes on"
    layers.drop("v", "silver")
    assert not layers.exists("v", "silver") and layers.versions("v", "silver") == []


def test_plain_tables_become_versions(spark, layers):
    layers.create("silver")
    spark.range(3).write.saveAsTable(layers.full_name("plain", "silver"))
    assert layers.write(spark.range(3, 5), "plain", "silver", "append") == 2
    assert layers.read("plain", "silver").count() == 5
    assert layers.write(layers.read("plain", "silver").where("id > 3"), "plain", "silver") == 1
    assert [r["id"] for r in layers.read("plain", "silver").collect()] == [4]


def test_readers_prune_partitions_through_the_name(spark, layers):
    layers.create("silver")
    layers.write(spark.range(50).withColumn("day", F.pmod("id", F.lit(5))), "p", "silver", partition_by=["day"])
    plan = layers.read("p", "silver").where("day = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def lines(path, name, *rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(rows) + "\n")


def test_files_are_read_by_their_headers(spark, tmp_path):
    path = tmp_path / "in"
    lines(path, "a.csv", "id,name,score", "1,ann,1", "2,bob,2")
    lines(path, "b.csv", "Name,score,id", "cat,2.5,3")
    lines(path, "c.csv", "id,extra", "4,x")
    lines(path, "d.csv", "id,name,score")
    (path / "e.csv").write_text("")
    with gzip.open(path / "f.csv.gz", "wt") as file:
        file.write('score,id,"na""me"\n9,5,odd\n')
    found = read_csv(spark, str(path), "id bigint, name string, score double")
    assert found.dtypes == [("id", "bigint"), ("name", "string"), ("score", "double")]
    assert sorted(map(tuple, found.collect())) == [
        (1, "ann", 1.0), (2, "bob", 2.0), (3, "cat", 2.5), (4, None, None), (5, None, 9.0)
    ]
    guessed = read_csv(spark, [f"{path}/a.csv", f"{path}/b.csv"])
    assert guessed.where("id = 3").select("id", "name", "score").first() == (3, "cat", 2.5)
    assert dict(guessed.dtypes)["score"] == "double"


def test_types_common_to_all_files(spark, tmp_path):
    path = tmp_path / "in"
    lines(path, "a.csv", "k,flag,day,n", "1,true,2024-01-01,5")
    lines(path, "b.csv", "flag,k,n,day", "7,x,99999999999,2024-01-02 10:00:00")
    found = dict(read_csv(spark, str(path)).dtypes)
    assert found == {"k": "string", "flag": "string", "day": "timestamp", "n": "bigint"}


def test_repeated_and_missing_names(spark, tmp_path):
    path = tmp_path / "in"
    lines(path, "a.csv", "a,,a", "1,2,3")
    assert read_csv(spark, str(path)).collect() == [(1, 2, 3)]
    assert read_csv(spark, str(path)).columns == ["a0", "_c1", "a2"]
    assert read_csv(spark, str(tmp_path / "in"), "b string").collect() == [(None,)]


def test_bad_rows_are_kept_and_counted(spark, layers, tmp_path):
    path = tmp_path / "in"
    lines(path, "t.csv", "id,name", "1,ann", "two,bob", "3", "4,cat,more")
    lines(path, "u.csv", "name,id", '"line\nend, quoted ""so""",5', "x,y,z")
    report = ingest_files(layers, {"t": str(path)}, schemas={"t": "id bigint, name string"}, multi_line=True)
    row = report.first()
    assert (row["status"], row["row_count"], row["bad_rows"]) == ("SUCCESS", 6, 4)
    found = layers.read("t", "bronze")
    assert sorted((r["id"] or 0, r["name"] or "", r["_corrupt_record"] is None) for r in found.collect()) == [
        (0, "bob", False), (0, "x", False), (1, "ann", True), (3, "", False), (4, "cat", False),
        (5, 'line\nend, quoted "so"', True),
    ]
    assert {r[0].rsplit("/", 1)[1] for r in found.select("_source_file").distinct().collect()} == {"t.csv", "u.csv"}


def test_raw_rows_are_written_where_they_are_read(spark, layers, tmp_path):
    folder = str(tmp_path / "people")
    spark.range(400).repartition(4).write.option("header", True).csv(folder)
    cost = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(cost)
    spark.conf.set(cost, "128m")  # a task for each file
    try:
        report = ingest_files(layers, {"people": folder}).first()
    finally:
        spark.conf.set(cost, before)
    assert (report["status"], report["row_count"]) == ("SUCCESS", 400)
    stored = layers.read("people", "bronze")
    assert stored.select("id").distinct().count() == 400
    assert len(stored.inputFiles()) == 4


def test_no_files_to_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("")
    assert read_csv(spark, str(tmp_path / "in"), "a int, b string").collect() == []
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "absent"))


def sales(rng, batch, count):
    """Rows of the last days before a batch, now and then of a day long past, and some without a date."""
    rows = []
    for _ in range(count):
        day = None if rng.random() < 0.02 else rng.choice([batch, batch, batch - 1, rng.randrange(0, batch + 1)])
        rows.append(
            (
                None if day is None else date(2024, 1, 2 + day), rng.randrange(30), rng.choice(["online", "instore"]),
                rng.choice(["Completed", "Failed"]), round(rng.uniform(0, 90), 2),
            )
        )
    return rows


SALES = "transaction_date date, customer_id bigint, channel string, status string, amount double"


def test_stream_is_compacted_into_snapshots(spark, tmp_path):
    """Reading takes one snapshot and the batches since, and late rows count."""
    rng = random.Random(6)
    source, target = tmp_path / "sales", str(tmp_path / "daily")
    everything = []
    for batch in range(11):
        rows = sales(rng, batch, 40)
        everything += rows
        spark.createDataFrame(rows, SALES).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(SALES).parquet(str(source))
        stream_daily_parts(stream, target, str(tmp_path / "progress"), compact_every=4).awaitTermination()
        folders, snapshots, batches = daily._open_parts(spark, target)
        assert len(folders) <= 4 and len(batches) <= 8 and len(snapshots) <= 2
        want = build_daily_metrics(spark.createDataFrame(everything, SALES))
        if batch in (2, 3, 7, 10):
            assert values(read_daily_metrics(spark, target)) == values(want)


def test_unfinished_snapshots_are_not_read(spark, tmp_path):
    target = str(tmp_path / "daily")
    rows = spark.createDataFrame(sales(random.Random(1), 3, 50), SALES)
    for number in range(3):
        daily_parts(rows).write.parquet(f"{target}/batches/upto={number}")
    want = values(read_daily_metrics(spark, target))
    daily_parts(rows).write.parquet(f"{target}/snapshots/upto=1")
    (tmp_path / "daily" / "snapshots" / "upto=1" / "_SUCCESS").unlink()
    assert values(read_daily_metrics(spark, target)) == want
    # A batch that runs again finds its snapshot, or writes the unfinished one anew.
    compact_daily_parts(spark, target, 1)
    compact_daily_parts(spark, target, 1)
    assert values(read_daily_metrics(spark, target)) == want
    with pytest.raises(FileNotFoundError):
        read_daily_metrics(spark, str(tmp_path / "none"))


def test_lost_values_are_counted_per_column(spark, layers, tmp_path):
    base = tmp_path / "data"
    csv(
        base,
        "online_transactions.csv",
        [
            "OrderID,CustomerID,ProductID,DateTime,PaymentMethod,Amount,Status",
            "1,1,5,2024-01-05 10:00:00,Card,9.5,Completed",
            "2,C7,5,soon,Card,n/a,Completed",
            "3,C8,,2024-01-06 10:00:00,Card,,Completed",
            "3,C8,,2024-01-06 10:00:00,Card,,Completed",
        ],
    )
    csv(
        base,
        "instore_transactions.csv",
        ["TransactionID,CustomerID,StoreID,DateTime,PaymentMethod,Amount", "1,1,S2,2024-01-05 10:00:00,Cash,4"],
    )
    csv(base, "stores.csv", ["StoreID,Location,Manager,OpenHours", "1,Oslo,Ann,9-17"])
    ingest_folder(layers, str(base))
    report = {r.table_name: r for r in conform_layer(layers, "2025-04-01").collect()}
    sales = report["transactions"]
    assert (sales.status, sales.row_count, sales.bad_rows) == ("SUCCESS", 5, 4)
    assert sales.lost_values == {"customer_id": 3, "transaction_datetime": 1, "amount": 1, "store_id": 1}
    assert (report["stores"].bad_rows, report["stores"].lost_values) == (0, {})
    assert report["products"].lost_values is None
    stored = layers.read("transactions", "silver")
    assert "_lost" not in stored.columns and stored.where("customer_id IS NULL").count() == 3


def _upsert_rows(spark, rows):
    return spark.createDataFrame(rows, "k bigint, day string, v bigint, x string, gone boolean")


def _files_by_day(layers):
    found = layers.read("u", "silver").select("day", F.input_file_name().alias("file")).distinct().collect()
    return {day: {r.file for r in found if r.day == day} for day in {r.day for r in found}}


def test_upsert_rewrites_only_touched_partitions(spark, layers):
    layers.create("silver")
    first = _upsert_rows(spark, [(k, f"d'{k % 4}" if k % 5 else None, 1, "old", None) for k in range(40)] + [(None, "d'1", 1, "old", None)])
    layers.write(first.drop("gone"), "u", "silver", partition_by=["day"])
    reader, before = layers.read("u", "silver"), _files_by_day(layers)
    changes = [
        (1, "d'1", 2, "new", None),
        (1, "d'1", 2, "new", False),
        (41, "d'1", 1, "added", None),
        (9, "d'1", 0, "late", True),
        (13, "d'1", 1, "gone", True),
        (21, "d'9", 5, "moved", None),
        (None, "d'1", 3, "null key", None),
        (77, "d'3", 1, "unknown", True),
    ]
    layers.upsert(_upsert_rows(spark, changes), "u", "silver", ["k"], "v", ["day"], deleted="gone")
    after = _files_by_day(layers)
    for day in (None, "d'0", "d'2", "d'3"):
        assert after[day] == before[day]
    assert not after["d'1"] & before["d'1"] and set(after) == {*before, "d'9"}
    rows = {r.k: (r.day, r.v, r.x) for r in layers.read("u", "silver").collect()}
    assert layers.read("u", "silver").count() == len(rows) == 41
    assert rows[1] == ("d'1", 2, "new") and rows[41] == ("d'1", 1, "added") and rows[9] == ("d'1", 1, "old")
    assert 13 not in rows and 77 not in rows
    assert rows[21] == ("d'9", 5, "moved") and rows[None] == ("d'1", 3, "null key")
    assert reader.count() == 41 and reader.where("x <> 'old'").count() == 0, "an earlier reader goes on"
    assert layers.read("u", "silver").where(F.col("day") == "d'2").count() == 8


def test_upsert_against_plain_rows_over_many_rounds(spark, layers):
    rng = random.Random(11)
    layers.create("silver")
    want = {}
    for round_ in range(12):
        changes = {
            k: (k, f"d{rng.randrange(5)}", round_, f"x{rng.random()}", rng.random() < 0.2)
            for k in rng.sample(range(60), 6)
        }
        for k, row in changes.items():
            want[k] = row
        frame = _upsert_rows(spark, list(changes.values()))
        layers.upsert(frame, "u", "silver", ["k"], "v", ["day"], deleted="gone")
        if round_ == 5:
            extra = (100, "d0", 0, "appended", False)
            layers.write(_upsert_rows(spark, [extra]).drop("gone"), "u", "silver", "append", ["day"])
            want[100] = extra
    rows = sorted((r.k, r.day, r.v, r.x) for r in layers.read("u", "silver").select("k", "day", "v", "x").collect())
    assert rows == sorted(row[:4] for row in want.values() if not row[4])
    assert len(layers.shown("u", "silver")) <= 10
    layers.write(spark.range(3), "u", "silver")
    layers.write(spark.range(4), "u", "silver")
    assert len(layers.versions("u", "silver")) == 2


def test_failed_upsert_keeps_the_old_table(spark, layers):
    layers.create("silver")
    layers.write(_upsert_rows(spark, [(1, "a", 1, "old", None)]).drop("gone"), "u", "silver", partition_by=["day"])
    assert layers.upsert(_upsert_rows(spark, []), "u", "silver", ["k"], "v", ["day"], deleted="gone") == 0
    broken = _upsert_rows(spark, [(1, "a", 2, "new", None)]).withColumn("x", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        layers.upsert(broken, "u", "silver", ["k"], "v", ["day"], deleted="gone")
    assert [r.x for r in layers.read("u", "silver").collect()] == ["old"]
    assert len(layers.versions("u", "silver")) == 1
