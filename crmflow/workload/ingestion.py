"""Sources, sinks and the layers, on files written from the given tables.

Each query works in a fresh path of the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crmflow.operators.rows import upsert
from crmflow.plans.layers import business_layer, conform_layer, ingest_files
from crmflow.sources import files, tables as layer_tables
from crmflow.sources.tables import LayerTables
from crmflow.storage import scratch_path
from crmflow.streaming.daily import read_daily_metrics, stream_daily_parts
from crmflow.streaming.ingest import append_available, csv_stream
from crmflow.workload import roles
from crmflow.workload.registry import query, table
from crmflow.workload.role_sql import using

Session = SparkSession

INGESTED_AT = datetime(2001, 8, 2, 6, 30)
INGESTED_ON = date(2001, 8, 2)

# Raw table to role, as files of a customer folder.
RAW_ROLES = {
    "customers": roles.customers_raw,
    "online_transactions": roles.online_raw,
    "instore_transactions": roles.instore_raw,
    "loyalty_accounts": roles.loyalty_raw,
    "service_interactions": roles.service_raw,
    "customer_insights": roles.insights_raw,
    "products": roles.products_raw,
    "stores": roles.stores_raw,
}


def _export(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


def _export_roles(
    spark: Session, sf_dir: str, names: Sequence[str] = tuple(RAW_ROLES)
) -> tuple[str, dict[str, str]]:
    """The raw roles as CSV folders below one path."""
    base = scratch_path(spark, "raw")
    return base, {name: _export(RAW_ROLES[name](spark, sf_dir), f"{base}/{name}") for name in names}


def _layers(spark: Session) -> LayerTables:
    """Fresh databases, so that runs do not meet."""
    run = uuid.uuid4().hex[:12]
    return LayerTables(
        spark,
        {layer: f"crmflow_{run}_{layer}" for layer in ("bronze", "silver", "gold")},
        scratch_path(spark, "warehouse"),
    )


@query(
    "src_discover",
    using(
        "customers_raw online_raw instore_raw loyalty_raw service_raw insights_raw products_raw stores_raw",
        """SELECT 'customers' AS folder, true AS has_bytes, count(*) AS data_rows FROM customers_raw
           UNION ALL SELECT 'online_transactions', true, count(*) FROM online_raw
           UNION ALL SELECT 'instore_transactions', true, count(*) FROM instore_raw
           UNION ALL SELECT 'loyalty_accounts', true, count(*) FROM loyalty_raw
           UNION ALL SELECT 'service_interactions', true, count(*) FROM service_raw
           UNION ALL SELECT 'customer_insights', true, count(*) FROM insights_raw
           UNION ALL SELECT 'products', true, count(*) FROM products_raw
           UNION ALL SELECT 'stores', true, count(*) FROM stores_raw""",
    ),
)
def src_discover(spark: Session, sf_dir: str) -> DataFrame:
    """The CSV files found below a folder, per sub-folder, next to the lines in them."""
    base, _ = _export_roles(spark, sf_dir)
    folder = F.element_at(F.split("path", "/"), -2).alias("folder")
    found = files.discover_csv(spark, base).groupBy(folder).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .text(base)
        .select(F.col("_metadata.file_path").alias("path"))
        .groupBy(folder)
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    return found.join(lines, "folder").select(
        "folder",
        (F.col("bytes") > 0).alias("has_bytes"),
        (F.col("lines") - F.col("files")).alias("data_rows"),
    )


@query("src_csv_infer", "SELECT * FROM orders")
def src_csv_infer(spark: Session, sf_dir: str) -> DataFrame:
    path = _export(table(spark, sf_dir, "orders"), scratch_path(spark, "orders"))
    orders = files.read_csv(spark, path)
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("src_csv_schema", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def src_csv_schema(spark: Session, sf_dir: str) -> DataFrame:
    """Texts with commas, quotes and line ends, read with a given schema and no inference pass."""
    documents = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents")
    documents.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return files.read_csv(spark, path, documents.schema, multi_line=True)


@query(
    "src_csv_by_header",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              CASE WHEN o_orderkey % 3 < 2 THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def src_csv_by_header(spark: Session, sf_dir: str) -> DataFrame:
    """Files of three headers: columns in another order, and a column that one lacks."""
    orders, base = table(spark, sf_dir, "orders"), scratch_path(spark, "headers")
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    headers = [names, names[::-1], names[1:4] + names[:1]]
    for number, header in enumerate(headers):
        part = orders.where(F.pmod("o_orderkey", F.lit(3)) == number)
        _export(part.select(*header), f"{base}/{number}")
    return files.read_csv(spark, [f"{base}/{n}" for n in range(3)]).select(*names)


@query(
    "src_csv_bad_rows",
    """SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL ELSE p_size END AS p_size, p_brand,
              CASE WHEN p_size = 1 THEN p_partkey || ',one,' || p_brand
                   WHEN p_size = 2 THEN p_partkey || ',2,' || p_brand || ',more' END AS _corrupt_record
       FROM part""",
)
def src_csv_bad_rows(spark: Session, sf_dir: str) -> DataFrame:
    """Rows with a value of another type or one value too many keep their text; the rest of them is read."""
    part, path = table(spark, sf_dir, "part"), scratch_path(spark, "bad-rows")
    size = F.when(F.col("p_size") == 1, "one").otherwise(F.col("p_size").cast("string"))
    line = F.concat_ws(",", "p_partkey", size, "p_brand", F.when(F.col("p_size") == 2, "more"))
    # A task writes one file, so its first line is the header.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    header = F.lit("p_partkey,p_size,p_brand")
    lines = part.select(line.alias("line"), first.alias("first"))
    lines = lines.select(F.explode(F.when(F.col("first"), F.array(header, "line")).otherwise(F.array("line"))))
    lines.write.text(path)
    schema = "p_partkey bigint, p_size int, p_brand string"
    found = files.read_csv(spark, path, schema, keep_bad_rows=True)
    return found.withColumn("p_partkey", F.col("p_partkey").cast(part.schema["p_partkey"].dataType))


def _profile_sql(name: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS file, (SELECT count(*) FROM {name}) AS row_count, {len(columns)} AS column_count,
                   '{column}' AS column_name, '{kind}' AS data_type, true AS nullable,
                   min(left(CAST({column} AS VARCHAR), 50)) AS sample_value, {i + 1} AS position FROM {name}"""
        for i, (column, kind) in enumerate(columns)
    )


_PROFILED = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [
        ("c_custkey", "int"),
        ("c_name", "string"),
        ("c_nationkey", "int"),
        ("c_acctbal", "double"),
        ("c_mktsegment", "string"),
    ],
    "orders": [
        ("o_orderkey", "int"),
        ("o_custkey", "int"),
        ("o_orderstatus", "string"),
        ("o_totalprice", "double"),
        ("o_orderdate", "timestamp"),
        ("o_orderpriority", "string"),
    ],
}


def _profile(spark: Session, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "profiled")
    paths = [
        _export(table(spark, sf_dir, name).select(*[c for c, _ in columns]), f"{base}/{name}")
        for name, columns in _PROFILED.items()
    ]
    profile, _ = files.schema_profile(spark, [*paths, f"{base}/absent"])
    return profile.withColumn("file", files.file_name(F.col("file")))


@query("src_schema_profile", " UNION ALL ".join(_profile_sql(n, c) for n, c in _PROFILED.items()))
def src_schema_profile(spark: Session, sf_dir: str) -> DataFrame:
    """Types, row counts and samples of four CSV files; a fifth that is missing is left out."""
    return _profile(spark, sf_dir)


@query(
    "src_profile_errors",
    """SELECT 'nation' AS file, true AS readable, (SELECT count(*) FROM nation) AS row_count
       UNION ALL SELECT 'customer', true, (SELECT count(*) FROM customer)
       UNION ALL SELECT 'absent', false, NULL""",
)
def src_profile_errors(spark: Session, sf_dir: str) -> DataFrame:
    """Each file that was asked for: its rows, or that it could not be read."""
    base = scratch_path(spark, "profiled")
    paths = [_export(table(spark, sf_dir, name), f"{base}/{name}") for name in ("nation", "customer")]
    profile, errors = files.schema_profile(spark, [*paths, f"{base}/absent"])
    read = profile.select("file", F.lit(True).alias("readable"), "row_count").distinct()
    failed = errors.where("message <> ''").select(
        "file", F.lit(False).alias("readable"), F.lit(None).cast("bigint").alias("row_count")
    )
    return read.unionByName(failed).withColumn("file", files.file_name(F.col("file")))


@query(
    "src_record_limit",
    """SELECT least(count(*), 700) AS limited, count(*) AS whole, count(DISTINCT o_orderkey) >= least(count(*), 700) AS known
       FROM orders""",
)
def src_record_limit(spark: Session, sf_dir: str) -> DataFrame:
    """An input with a record limit has that many different rows of the file, or all."""
    path = scratch_path(spark, "orders")
    layer_tables.write_output(table(spark, sf_dir, "orders"), path)
    limited = files.read_input(spark, path, record_limit=700)
    whole = files.read_input(spark, path)
    found = whole.join(limited.select("o_orderkey"), "o_orderkey", "left_semi")
    return limited.agg(F.count(F.lit(1)).alias("limited")).select(
        "limited",
        F.lit(whole.count()).alias("whole"),
        (F.lit(found.count()) >= F.col("limited")).alias("known"),
    )


@query(
    "src_schema_summary",
    """SELECT 'region' AS file, (SELECT count(*) FROM region) AS row_count, 2 AS column_count,
              'r_regionkey, r_name' AS column_preview
       UNION ALL SELECT 'nation', (SELECT count(*) FROM nation), 3, 'n_nationkey, n_name, n_regionkey'
       UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), 5,
                        'c_custkey, c_name, c_nationkey, c_acctbal +1 more'
       UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), 6,
                        'o_orderkey, o_custkey, o_orderstatus, o_totalprice +2 more'""",
)
def src_schema_summary(spark: Session, sf_dir: str) -> DataFrame:
    return files.schema_summary(_profile(spark, sf_dir))


@query(
    "src_table_naming",
    """SELECT p_partkey, file_name, CASE WHEN file_name = 'Customers.csv' THEN 'customers'
              ELSE regexp_replace(lower(replace(file_name, '.csv', '')), '[ -]', '_', 'g') END AS table_name
       FROM (SELECT p_partkey, CASE WHEN p_size = 1 THEN 'Customers.csv'
                                    ELSE p_brand || '-' || p_name || '.csv' END AS file_name FROM part)""",
)
def src_table_naming(spark: Session, sf_dir: str) -> DataFrame:
    """Table names for files named after the parts; one name is a known one."""
    made = F.concat("p_brand", F.lit("-"), "p_name", F.lit(".csv"))
    named = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") == 1, "Customers.csv").otherwise(made).alias("file_name")
    )
    return named.withColumn("table_name", files.table_name(F.col("file_name")))


@query(
    "ingest_lineage",
    """SELECT *, 'customer.parquet' AS _source_file, TIMESTAMP '2001-08-02 06:30:00' AS _ingestion_timestamp,
              DATE '2001-08-02' AS _ingestion_date FROM customer""",
)
def ingest_lineage(spark: Session, sf_dir: str) -> DataFrame:
    source = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    # As text the time is that of the session's zone, wherever the driver runs.
    at = F.lit(INGESTED_AT.isoformat()).cast("timestamp")
    stamped = layer_tables.add_lineage(table(spark, sf_dir, "customer"), source, at, INGESTED_ON)
    return stamped.withColumn("_ingestion_timestamp", F.col("_ingestion_timestamp").cast("timestamp_ntz"))


@query(
    "ingest_table",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal, DATE '2001-08-02' AS _ingestion_date,
              2 * (SELECT count(*) FROM supplier) AS rows_written
       FROM supplier, (VALUES (1), (2)) AS twice(n)""",
)
def ingest_table(spark: Session, sf_dir: str) -> DataFrame:
    """One table written to the raw layer and appended again; row counts come from the writes."""
    layers = _layers(spark)
    layers.create("bronze")
    raw = layer_tables.add_lineage(table(spark, sf_dir, "supplier"), "supplier", INGESTED_AT, INGESTED_ON)
    written = layers.write(raw, "supplier", "bronze", "overwrite", ["_ingestion_date"])
    written += layers.write(raw, "supplier", "bronze", "append", ["_ingestion_date"])
    return (
        layers.read("supplier", "bronze")
        .drop("_source_file", "_ingestion_timestamp")
        .withColumn("rows_written", F.lit(written).cast("bigint"))
    )


@query(
    "ingest_run_report",
    """SELECT 'nation' AS table_name, 'SUCCESS' AS status, (SELECT count(*) FROM nation) AS row_count
       UNION ALL SELECT 'orders', 'SUCCESS', (SELECT count(*) FROM orders)
       UNION ALL SELECT 'absent', 'ERROR', NULL
       UNION ALL SELECT 'customer', 'SUCCESS', (SELECT count(*) FROM customer)""",
)
def ingest_run_report(spark: Session, sf_dir: str) -> DataFrame:
    """Status and rows per file; the missing one does not stop the others."""
    base = scratch_path(spark, "incoming")
    paths = {n: _export(table(spark, sf_dir, n), f"{base}/{n}") for n in ("nation", "orders", "customer")}
    found = {"nation": paths["nation"], "orders": paths["orders"], "absent": f"{base}/absent"}
    report = ingest_files(_layers(spark), {**found, "customer": paths["customer"]})
    return report.select("table_name", "status", "row_count")


_ALL_RAW = "customers_raw online_raw instore_raw loyalty_raw service_raw insights_raw products_raw stores_raw"


@query(
    "conform_run_report",
    using(
        _ALL_RAW,
        """SELECT 'customers' AS table_name, 'SUCCESS' AS status, (SELECT count(*) FROM customers_raw) AS row_count
           UNION ALL SELECT 'transactions', 'SUCCESS', (SELECT count(*) FROM orders)
           UNION ALL SELECT 'loyalty', 'SUCCESS', (SELECT count(*) FROM loyalty_raw)
           UNION ALL SELECT 'service_interactions', 'SUCCESS', (SELECT count(*) FROM service_raw)
           UNION ALL SELECT 'customer_insights', 'SUCCESS', (SELECT count(*) FROM insights_raw)
           UNION ALL SELECT 'products', 'SUCCESS', (SELECT count(*) FROM products_raw)
           UNION ALL SELECT 'stores', 'SKIPPED', NULL""",
    ),
)
def conform_run_report(spark: Session, sf_dir: str) -> DataFrame:
    """All cleaned tables from raw CSV; the stores were not delivered."""
    layers = _layers(spark)
    _, paths = _export_roles(spark, sf_dir)
    ingest_files(layers, {n: p for n, p in paths.items() if n != "stores"})
    return conform_layer(layers, roles.AS_OF).select("table_name", "status", "row_count")


@query(
    "conform_lost_values",
    """SELECT 'customers' AS table_name, 'customer_id' AS column_name, count(*) AS lost, count(*) AS bad_rows
       FROM customer WHERE c_custkey % 10 = 0
       UNION ALL
       SELECT 'loyalty', u.column_name,
              CASE u.column_name WHEN 'customer_id' THEN count(*) FILTER (c_custkey % 10 = 0)
                   WHEN 'total_points' THEN count(*) FILTER (c_custkey % 7 = 0) ELSE count(*) FILTER (c_custkey % 3 = 0) END,
              count(*) FILTER (c_custkey % 10 = 0 OR c_custkey % 7 = 0 OR c_custkey % 3 = 0)
       FROM customer CROSS JOIN (VALUES ('customer_id'), ('total_points'), ('join_date')) AS u(column_name)
       GROUP BY u.column_name""",
)
def conform_lost_values(spark: Session, sf_dir: str) -> DataFrame:
    """Values of raw files that fit no type, counted per column while the cleaned tables are written."""
    layers, base = _layers(spark), scratch_path(spark, "lossy")
    customer, key = table(spark, sf_dir, "customer"), F.col("c_custkey")

    def broken_when(divisor: int, word: str, value: Column) -> Column:
        return F.when(key % divisor == 0, F.lit(word)).otherwise(value.cast("string"))

    number = broken_when(10, "unknown", key).alias("CustomerID")
    people = customer.select(
        number, F.col("c_name").alias("Name"), F.lit("").alias("Email"), F.col("c_name").alias("Address")
    )
    accounts = customer.select(
        key.alias("LoyaltyID"),
        number,
        broken_when(7, "many", F.lit(100)).alias("PointsEarned"),
        F.lit("Gold").alias("TierLevel"),
        broken_when(3, "soon", F.lit("2024-02-29")).alias("JoinDate"),
    )
    paths = {
        name: _export(df, f"{base}/{name}") for name, df in (("customers", people), ("loyalty_accounts", accounts))
    }
    ingest_files(layers, paths)
    report = conform_layer(layers, roles.AS_OF)
    return report.select(
        "table_name", F.explode("lost_values").alias("column_name", "lost"), "bad_rows"
    )


_PROFILE_RAW = ("customers", "online_transactions", "instore_transactions", "loyalty_accounts", "service_interactions")


def _business_tables(
    spark: Session, sf_dir: str, delivered: Sequence[str] = tuple(RAW_ROLES)
) -> tuple[LayerTables, DataFrame]:
    """All layers built from the raw CSV files that were delivered, and the report of the last."""
    layers = _layers(spark)
    _, paths = _export_roles(spark, sf_dir, delivered)
    ingest_files(layers, paths)
    conform_layer(layers, roles.AS_OF)
    return layers, business_layer(layers, roles.AS_OF)


@query(
    "business_run_report",
    using(
        "customers_raw daily campaigns",
        """SELECT 'customer_360' AS table_name, 'SUCCESS' AS status, (SELECT count(*) FROM customers_raw) AS row_count
           UNION ALL SELECT 'customer_segments', 'SUCCESS', (SELECT count(*) FROM customers_raw)
           UNION ALL SELECT 'customer_clv', 'SUCCESS', (SELECT count(*) FROM customers_raw)
           UNION ALL SELECT 'campaign_performance', 'SUCCESS', (SELECT count(*) FROM campaigns)
           UNION ALL SELECT 'daily_metrics', 'SUCCESS', (SELECT count(*) FROM daily)""",
    ),
)
def business_run_report(spark: Session, sf_dir: str) -> DataFrame:
    """Raw files to business tables, layer by layer."""
    return _business_tables(spark, sf_dir)[1].select("table_name", "status", "row_count")


@query("business_run_segments", using("segments", "SELECT * FROM segments"))
def business_run_segments(spark: Session, sf_dir: str) -> DataFrame:
    """The stored segments after raw files went through all layers, value by value."""
    layers, _ = _business_tables(spark, sf_dir, _PROFILE_RAW)
    return layers.read("customer_segments", "gold").drop("_gold_timestamp")


@query("business_run_value", using("clv", "SELECT * FROM clv"))
def business_run_value(spark: Session, sf_dir: str) -> DataFrame:
    """The stored lifetime values after raw files went through all layers."""
    layers, _ = _business_tables(spark, sf_dir, _PROFILE_RAW)
    return layers.read("customer_clv", "gold").drop("_gold_timestamp")


@query("business_run_daily", using("daily", "SELECT * FROM daily"))
def business_run_daily(spark: Session, sf_dir: str) -> DataFrame:
    """The stored daily metrics after raw files went through all layers."""
    layers, _ = _business_tables(spark, sf_dir, ("online_transactions", "instore_transactions"))
    return layers.read("daily_metrics", "gold").drop("_gold_timestamp")


@query("business_run_campaigns", using("campaigns", "SELECT * FROM campaigns"))
def business_run_campaigns(spark: Session, sf_dir: str) -> DataFrame:
    """The stored campaign results after raw files went through all layers."""
    layers, _ = _business_tables(spark, sf_dir, ("customer_insights",))
    return layers.read("campaign_performance", "gold").drop("_gold_timestamp")


@query("src_table", using("stores", "SELECT * FROM stores"))
def src_table(spark: Session, sf_dir: str) -> DataFrame:
    """A table of the cleaned layer, scanned by name."""
    layers = _layers(spark)
    layers.create("silver")
    layers.write(roles.stores(spark, sf_dir), "stores", "silver")
    return layers.read("stores", "silver")


@query(
    "sink_append_evolve",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def sink_append_evolve(spark: Session, sf_dir: str) -> DataFrame:
    """An append that brings one new column and lacks another."""
    layers = _layers(spark)
    layers.create("silver")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    first = customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    second = supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    layers.write(first, "parties", "silver", "overwrite")
    layers.write(second, "parties", "silver", "append")
    return layers.read("parties", "silver")


@query(
    "sink_merge_files",
    """SELECT n_nationkey AS key, n_name AS name, n_regionkey AS parent FROM nation
       UNION ALL SELECT r_regionkey, r_name, NULL FROM region""",
)
def sink_merge_files(spark: Session, sf_dir: str) -> DataFrame:
    """Files of one folder whose columns differ."""
    path = scratch_path(spark, "places")
    nation = table(spark, sf_dir, "nation")
    layer_tables.write_output(
        nation.withColumnsRenamed({"n_nationkey": "key", "n_name": "name", "n_regionkey": "parent"}), path
    )
    region = table(spark, sf_dir, "region").withColumnsRenamed({"r_regionkey": "key", "r_name": "name"})
    layer_tables.write_output(region, path, mode="append")
    return layer_tables.read_merged(spark, path)


@query("src_generic", "SELECT * FROM events")
def src_generic(spark: Session, sf_dir: str) -> DataFrame:
    """Events through JSON and ORC files, read by format name."""
    events = table(spark, sf_dir, "events")
    base = scratch_path(spark, "events")
    early = events.where("ts < '2024-01-15'")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    layer_tables.write_output(early, f"{base}/early", "json", timestampNTZFormat=micros)
    layer_tables.write_output(events.where("ts >= '2024-01-15'"), f"{base}/late", "orc")
    json = files.read_input(spark, f"{base}/early", "json").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return json.select(*events.columns).unionByName(files.read_input(spark, f"{base}/late", "orc"))


@query("sink_partitioned", "SELECT * FROM orders")
def sink_partitioned(spark: Session, sf_dir: str) -> DataFrame:
    """Orders written by priority, then read back over all partitions."""
    path = scratch_path(spark, "orders-by-priority")
    orders = table(spark, sf_dir, "orders")
    layer_tables.write_output(orders, path, partition_by=["o_orderpriority"])
    return spark.read.parquet(path).select(*orders.columns)


@query(
    "sink_replace_partitions",
    """SELECT o_orderkey, o_totalprice, CASE WHEN l_orderkey IS NULL THEN o_orderstatus ELSE 'F' END AS o_orderstatus,
              CAST(year(o_orderdate) AS INTEGER) AS year
       FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE year(l_shipdate) >= 2001)
            ON l_orderkey = o_orderkey AND year(o_orderdate) = 2001""",
)
def sink_replace_partitions(spark: Session, sf_dir: str) -> DataFrame:
    """Orders stored by year; those of 2001 that have shipped are updated, and only that year is rewritten."""
    path = scratch_path(spark, "orders-by-year")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("year")
    )
    layer_tables.write_output(orders, path, partition_by=["year"])
    touched = spark.read.parquet(path).where("year = 2001").withColumn("version", F.lit(1))
    shipped = table(spark, sf_dir, "lineitem").where(F.year("l_shipdate") >= 2001).select("l_orderkey").distinct()
    changes = (
        touched.join(shipped, touched["o_orderkey"] == shipped["l_orderkey"], "left_semi")
        .withColumn("o_orderstatus", F.lit("F"))
        .withColumn("version", F.lit(2))
    )
    updated = upsert(touched, changes, ["o_orderkey"], "version").drop("version")
    layer_tables.replace_partitions(updated, path, ["year"])
    return spark.read.parquet(path)


@query(
    "preview",
    """SELECT o_orderkey, o_custkey, o_totalprice, (SELECT count(*) FROM orders) AS table_rows
       FROM orders ORDER BY o_orderkey LIMIT 20""",
)
def preview(spark: Session, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    shown, count = files.preview(orders.orderBy("o_orderkey"))
    return shown.withColumn("table_rows", F.lit(count).cast("bigint"))


# Streams


@query(
    "ext_stream_ingest",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, true AS has_source FROM orders",
)
def ext_stream_ingest(spark: Session, sf_dir: str) -> DataFrame:
    """Orders arriving as CSV files, appended with lineage; a second run finds nothing new."""
    orders = table(spark, sf_dir, "orders")
    source, target, checkpoint = [scratch_path(spark, n) for n in ("arriving", "appended", "progress")]
    _export(orders, source)
    for _ in range(2):
        append_available(csv_stream(spark, source, orders.schema), target, checkpoint).awaitTermination()
    stored = spark.read.parquet(target)
    return stored.select(*orders.columns, F.col("_source_file").endswith(".csv").alias("has_source"))


@query("ext_stream_daily", using("daily", "SELECT * FROM daily"))
def ext_stream_daily(spark: Session, sf_dir: str) -> DataFrame:
    """Daily metrics of a stream that arrives in several batches: all days, all customers."""
    source, target, checkpoint = [scratch_path(spark, n) for n in ("sales", "daily", "progress")]
    transactions = roles.transactions(spark, sf_dir)
    transactions.write.parquet(source)
    stream = spark.readStream.schema(transactions.schema).option("maxFilesPerTrigger", 4).parquet(source)
    stream_daily_parts(stream, target, checkpoint).awaitTermination()
    return read_daily_metrics(spark, target)


@query(
    "sink_atomic_overwrite",
    """SELECT s_suppkey, s_nationkey, s_acctbal * 2 AS doubled, 'refused' AS failed_write,
              (SELECT count(*) FROM supplier) AS rows_after_failure, 2 AS versions FROM supplier""",
)
def sink_atomic_overwrite(spark: Session, sf_dir: str) -> DataFrame:
    """A table that survives an overwrite which fails half-way, and is then rebuilt from itself."""
    layers = _layers(spark)
    layers.create("silver")
    supplier = table(spark, sf_dir, "supplier")
    layers.write(supplier, "supplier", "silver", partition_by=["s_nationkey"])
    last = supplier.agg(F.max("s_suppkey")).scalar()
    fails = F.when(F.col("s_suppkey") == last, F.raise_error(F.lit("refused"))).otherwise(F.col("s_acctbal"))
    try:
        layers.write(supplier.withColumn("s_acctbal", fails.cast("double")), "supplier", "silver")
        outcome = "written"
    except Exception as error:
        outcome = "refused" if "refused" in str(error) else "other"
    after = layers.read("supplier", "silver").count()
    current = layers.read("supplier", "silver")
    layers.write(current.withColumn("doubled", F.col("s_acctbal") * 2), "supplier", "silver")
    return layers.read("supplier", "silver").select(
        "s_suppkey",
        "s_nationkey",
        "doubled",
        F.lit(outcome).alias("failed_write"),
        F.lit(after).cast("bigint").alias("rows_after_failure"),
        F.lit(len(layers.versions("supplier", "silver"))).alias("versions"),
    )


@query(
    "sink_upsert_partitions",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 2000 AND o_orderkey % 5 = 1 THEN o_totalprice * 2
                               ELSE o_totalprice END AS o_totalprice,
              CAST(CASE WHEN year(o_orderdate) = 2000 AND o_orderkey % 5 = 2 THEN 2001
                        ELSE year(o_orderdate) END AS INTEGER) AS year,
              true AS others_untouched
       FROM orders WHERE NOT (year(o_orderdate) = 2000 AND o_orderkey % 5 = 0)""",
)
def sink_upsert_partitions(spark: Session, sf_dir: str) -> DataFrame:
    """Orders by year; of those of 2000 some are repriced, moved to 2001 or deleted. An older change loses.
    Only files of these two years are written anew."""
    layers = _layers(spark)
    layers.create("silver")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.lit(1).alias("version")
    )
    layers.write(orders, "orders", "silver", partition_by=["year"])

    def names() -> DataFrame:
        return layers.read("orders", "silver").select("year", F.input_file_name().alias("file")).distinct()

    before = names()
    kind, old = F.col("o_orderkey") % 5, F.col("year") == 2000
    changes = orders.where(old & kind.isin(0, 1, 2, 3)).select(
        "o_orderkey",
        F.when(kind.isin(1, 3), F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(kind == 2, 2001).otherwise(F.col("year")).alias("year"),
        F.when(kind == 3, 0).otherwise(2).alias("version"),
        (kind == 0).alias("gone"),
    )
    layers.upsert(changes, "orders", "silver", ["o_orderkey"], "version", ["year"], deleted="gone")
    # One row per file.
    untouched = before.where("year NOT IN (2000, 2001)").exceptAll(names()).isEmpty()
    return layers.read("orders", "silver").drop("version").withColumn("others_untouched", F.lit(untouched))
