"""CSV discovery, reading, schema profile and table naming."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Source file to raw table.
FILE_TABLES = {
    "Customers.csv": "customers",
    "Products.csv": "products",
    "Stores.csv": "stores",
    "Agents.csv": "agents",
    "OnlineTransactions.csv": "online_transactions",
    "InStoreTransactions.csv": "instore_transactions",
    "LoyaltyAccounts.csv": "loyalty_accounts",
    "LoyaltyTransactions.csv": "loyalty_transactions",
    "CustomerServiceInteractions.csv": "service_interactions",
    "Customer360Insights.csv": "customer_insights",
    "customer_transactions_final.csv": "shopping_behavior",
}

SAMPLE_CHARS = 50
#: Files whose headers are looked at together.
HEADER_THREADS = 16

PROFILE_SCHEMA = (
    "file string, row_count bigint, column_count int, column_name string, "
    "data_type string, nullable boolean, sample_value string, position int"
)


def discover_csv(spark: SparkSession, base_path: str, recursive: bool = True) -> DataFrame:
    """``path, length`` of every CSV file below a folder, whatever the case of its suffix.

    Only the listing is read, not the files.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(base_path)
        .select("path", "length")
    )


#: Column that holds the text of rows that do not fit their header or schema.
CORRUPT = "_corrupt_record"


def _paths(spark: SparkSession, path: str | Sequence[str], recursive: bool) -> list[str]:
    """The files of a path or paths, in order; only listings are read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    found = listed.load([path] if isinstance(path, str) else list(path)).select("path", "length")
    # Empty files have no header and no rows.
    return sorted(row["path"] for row in found.where("length > 0").collect())


def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Names in the first record of a CSV file, which may be compressed; one line of it is read."""
    jvm, context = spark._jvm, spark.sparkContext
    conf = context._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        plain = codec.createInputStream(stream) if codec is not None else stream
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        text = lines.readLine() or ""
        # A name may hold line ends inside quotes.
        while text.count('"') % 2:
            more = lines.readLine()
            if more is None:
                break
            text = f"{text}\n{more}"
    finally:
        stream.close()
    names = next(csv.reader(io.StringIO(text.removeprefix("\ufeff"))), [])
    return tuple(name.strip() for name in names)


def header_groups(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the names in their headers."""
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        headers = list(pool.map(lambda p: read_header(spark, p), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, path in zip(headers, paths):
        groups.setdefault(header, []).append(path)
    return groups


def _common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """The narrowest type that holds values of all the given inferred types."""
    distinct = list(dict.fromkeys(k for k in kinds if not isinstance(k, (T.NullType, T.BooleanType))))
    flags = [k for k in kinds if isinstance(k, T.BooleanType)]
    if not distinct:
        return flags[0] if flags else T.StringType()
    if len(distinct) == 1 and not flags:
        return distinct[0]
    widths = {T.IntegerType: 1, T.LongType: 2, T.DoubleType: 3}
    if not flags and all(type(k) in widths for k in distinct):
        return max(distinct, key=lambda k: widths[type(k)])
    if not flags and all(isinstance(k, (T.DateType, T.TimestampType)) for k in distinct):
        return T.TimestampType()
    return T.StringType()


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    recursive: bool = False,
    multi_line: bool = False,
    keep_bad_rows: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """CSV files with headers, columns taken by name; a quote inside a quoted value is doubled.

    Files are grouped by their header, and each group is one scan: files may differ in the order
    of their columns and lack some, which are NULL there. With a schema, its columns come back
    in its order, and others are left out. Without one, all names of all headers come back, whatever their case, and
    types are inferred from all rows (one more pass) and made common to all files.

    ``multi_line`` allows line ends inside quotes; such files cannot be split, so each is read
    by one task. ``keep_bad_rows`` adds ``_corrupt_record``: the text of rows whose number of
    values is not that of the header or whose values do not fit their types, else NULL; what
    can be read of them stays. ``file_column`` names a column for the path of each row's file.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    groups = header_groups(spark, _paths(spark, path, recursive))
    base = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if not groups:
        empty = spark.createDataFrame([], schema or T.StructType([]))
        return empty.withColumn(file_column, F.lit(None).cast("string")) if file_column else empty
    if schema is None:
        found: dict[str, list[T.DataType]] = {}
        spelled: dict[str, str] = {}
        for header, paths in groups.items():
            guessed = base.option("inferSchema", True).option("samplingRatio", 1.0).csv(paths)
            # Repeated names get a number, so places say which column is meant.
            for name, field in zip(_distinct(header), guessed.schema.fields):
                found.setdefault(spelled.setdefault(name.lower(), name), []).append(field.dataType)
        schema = T.StructType([T.StructField(n, _common_type(k), True) for n, k in found.items()])
    wanted = {f.name.lower(): f for f in schema.fields}

    def scan(header: tuple[str, ...], paths: list[str]) -> DataFrame:
        fields = [wanted.get(name.lower(), T.StructField(name, T.StringType())) for name in _distinct(header)]
        present = {f.name for f in fields}
        reader = base.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        stored = [*fields, T.StructField(CORRUPT, T.StringType())] if keep_bad_rows else fields
        rows = reader.schema(T.StructType(stored)).csv(paths)
        columns = [
            F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        if keep_bad_rows:
            columns.append(F.col(CORRUPT))
        if file_column:
            columns.append(F.col("_metadata.file_path").alias(file_column))
        return rows.select(*columns)

    return reduce(DataFrame.unionByName, [scan(header, paths) for header, paths in groups.items()])


def _distinct(header: Sequence[str]) -> list[str]:
    """Names of a header; empty and repeated ones are told apart by their place."""
    lower = [name.lower() for name in header]
    return [
        name if name and lower.count(name.lower()) == 1 else f"{name or '_c'}{place}"
        for place, name in enumerate(header)
    ]


def table_name(file_name: Column, known: Mapping[str, str] = FILE_TABLES) -> Column:
    """Raw table for a file name: the known one, or the name in lower case without its suffix, with _ for blanks and hyphens."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(file_name), r"\.csv$", ""), "[ -]", "_")
    if not known:
        return plain
    mapping = F.create_map(*[F.lit(x) for name, table in known.items() for x in (name.lower(), table)])
    return F.coalesce(F.element_at(mapping, F.lower(file_name)), plain)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def profile_frame(df: DataFrame, label: str) -> DataFrame:
    """One row per column: row count, type, nullability and a sample value, from one pass.

    The sample is the smallest value as text, cut to 50 characters, so that it does
    not depend on how the input is split; false, zero and empty text are kept.
    """
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[
            F.min(F.left(F.col(f"`{f.name}`").cast("string"), F.lit(SAMPLE_CHARS))).alias(f"_sample_{i}")
            for i, f in enumerate(fields)
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
                F.col(f"_sample_{i}").alias("sample_value"),
                F.lit(i + 1).alias("position"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(
        F.lit(label).alias("file"),
        "row_count",
        F.lit(len(fields)).alias("column_count"),
        F.inline(rows),
    )


def schema_profile(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Profile of each file, and ``file, message`` of those that could not be read.

    Files are keyed by full path. A bad file does not stop the others.
    """
    profiles, errors = [], []
    for path in paths:
        try:
            profiles.append(profile_frame(read_csv(spark, path), path))
        except Exception as error:  # reported as a row
            errors.append((path, str(error).splitlines()[0]))
    empty = spark.createDataFrame([], PROFILE_SCHEMA)
    return (
        reduce(lambda a, b: a.unionByName(b), profiles, empty),
        spark.createDataFrame(errors, "file string, message string"),
    )


def schema_summary(profile: DataFrame, shown: int = 4) -> DataFrame:
    """``file, row_count, column_count, column_preview``: the first names and how many more."""
    grouped = profile.groupBy("file", "row_count", "column_count").agg(
        F.sort_array(F.collect_list(F.struct("position", "column_name")))["column_name"].alias("_names")
    )
    more = F.col("column_count") - shown
    preview = F.concat_ws(", ", F.slice("_names", 1, shown))
    return grouped.select(
        "file",
        "row_count",
        "column_count",
        F.when(more > 0, F.concat(preview, F.lit(" +"), more.cast("string"), F.lit(" more")))
        .otherwise(preview)
        .alias("column_preview"),
    )


def literal_rows(
    spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[str | None]]
) -> DataFrame:
    """A typed-in table of text columns; an empty cell is NULL."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    if not columns:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame([tuple(v or None for v in row) for row in rows], schema)


def read_input(
    spark: SparkSession,
    source: str,
    format: str = "parquet",
    record_limit: int | None = None,
    **options: str,
) -> DataFrame:
    """A table by name (``format="table"``), files of any Spark format, or a JDBC table or query.

    For ``jdbc`` the source is the table or a parenthesised query, and the options
    carry ``url`` and, for a parallel read, ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``. A record limit is honoured.
    """
    if format == "table":
        df = spark.table(source)
    elif format == "jdbc":
        df = spark.read.format("jdbc").options(dbtable=source, **options).load()
    else:
        df = spark.read.format(format).options(**options).load(source)
    return df if record_limit is None else df.limit(record_limit)


def preview(df: DataFrame, rows: int = 20) -> tuple[DataFrame, int]:
    """The first rows and the row count."""
    return df.limit(rows), df.count()
