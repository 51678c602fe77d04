"""Table operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmflow.operators import aggregate, filters, joins, ordering, outputs, project, quality, ranking, rows
from crmflow.operators.aggregate import Summary
from crmflow.plans.money import from_units, units
from crmflow.sources.files import literal_rows
from crmflow.workload import roles
from crmflow.workload.registry import query, table
from crmflow.workload.role_sql import half_up, total, using

Session = SparkSession


# Data quality


def _events_twice(spark: Session, sf_dir: str) -> DataFrame:
    """Events without their id and with the time cut to the day, so that rows repeat, plus lineage."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "user_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.col("ts").cast("date").alias("day"),
        F.when(F.col("value") >= 1, F.floor("value")).alias("value"),
        F.col("ts").alias("_ingestion_timestamp"),
        F.col("event_id").alias("_source_row"),
    )


_EVENTS_TWICE = """
    SELECT user_id, nullif(event_type, 'error') AS event_type, CAST(ts AS DATE) AS day,
           CASE WHEN value >= 1 THEN CAST(floor(value) AS BIGINT) END AS value,
           ts AS _ingestion_timestamp, event_id AS _source_row
    FROM events"""


@query(
    "dq_null_counts",
    f"""WITH e AS ({_EVENTS_TWICE})
        SELECT * FROM (
          SELECT 'user_id' AS column_name, count(*) FILTER (user_id IS NULL) AS null_count FROM e
          UNION ALL SELECT 'event_type', count(*) FILTER (event_type IS NULL) FROM e
          UNION ALL SELECT 'day', count(*) FILTER (day IS NULL) FROM e
          UNION ALL SELECT 'value', count(*) FILTER (value IS NULL) FROM e)
        WHERE null_count > 0""",
)
def dq_null_counts(spark: Session, sf_dir: str) -> DataFrame:
    return quality.null_counts(_events_twice(spark, sf_dir))


@query(
    "dq_duplicate_count",
    f"""WITH e AS ({_EVENTS_TWICE}), d AS (SELECT DISTINCT user_id, event_type, day, value FROM e)
        SELECT (SELECT count(*) FROM e) AS row_count, (SELECT count(*) FROM d) AS distinct_count,
               (SELECT count(*) FROM e) - (SELECT count(*) FROM d) AS duplicate_count""",
)
def dq_duplicate_count(spark: Session, sf_dir: str) -> DataFrame:
    return quality.duplicate_count(_events_twice(spark, sf_dir))


@query(
    "dq_dedup",
    f"""WITH e AS ({_EVENTS_TWICE})
        SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day, value
                                                   ORDER BY _ingestion_timestamp, _source_row) = 1""",
)
def dq_dedup(spark: Session, sf_dir: str) -> DataFrame:
    return quality.drop_exact_duplicates(_events_twice(spark, sf_dir))


@query(
    "dq_report",
    f"""WITH e AS ({_EVENTS_TWICE}), d AS (SELECT DISTINCT user_id, event_type, day, value FROM e),
             o AS (SELECT count(*) AS n, count(*) FILTER (event_type IS NULL) AS types,
                          count(*) FILTER (value IS NULL) AS vals FROM e),
             c AS (SELECT count(*) AS n FROM d)
        SELECT 'events' AS table_name, o.n AS original_row_count, c.n AS cleaned_row_count,
               o.n - c.n AS rows_removed, o.n - c.n AS duplicate_count,
               'event_type=' || types || ',value=' || vals AS null_counts
        FROM o, c""",
)
def dq_report(spark: Session, sf_dir: str) -> DataFrame:
    """The report, with its map of null counts written as text."""
    report = quality.quality_report(_events_twice(spark, sf_dir), "events")
    entries = F.transform(
        F.array_sort(F.map_entries("null_counts")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return report.withColumn("null_counts", F.array_join(entries, ","))


@query(
    "dq_null_keys",
    using(
        "transactions",
        """SELECT 'left' AS side, 'product_id' AS key, count(*) FILTER (product_id IS NULL) AS null_rows,
                  count(*) AS total_rows FROM transactions
           UNION ALL SELECT 'right', 'p_partkey', count(*) FILTER (p_partkey IS NULL), count(*) FROM part""",
    ),
)
def dq_null_keys(spark: Session, sf_dir: str) -> DataFrame:
    return joins.null_key_counts(
        roles.transactions(spark, sf_dir), table(spark, sf_dir, "part"), [("product_id", "p_partkey")]
    )


@query(
    "cleanse",
    """SELECT doc_id, replace(replace(upper(trim(text, ' ')), 'ß', 'SS'), 'ẞ', 'SS') AS text,
              upper(trim(lang, ' ')) AS lang, source
       FROM documents""",
)
def cleanse(spark: Session, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return project.cleanse(documents, ["text", "lang", "absent"])


@query(
    "impute",
    using(
        "insights",
        f"""SELECT customer_id, session_start, coalesce(age, (SELECT CAST(median(age) AS INTEGER) FROM insights)) AS age,
               coalesce(monthly_income, (SELECT {total("monthly_income")} / count(monthly_income) FROM insights))
                 AS monthly_income,
               coalesce(return_reason, 'none') AS return_reason,
               coalesce(price_class, (SELECT price_class FROM
                 (SELECT price_class, count(*) AS n FROM
                    (SELECT CASE WHEN quantity > 1 THEN CAST(floor(product_price / 50) AS BIGINT) END AS price_class
                     FROM insights) WHERE price_class IS NOT NULL GROUP BY 1)
                 ORDER BY n DESC, price_class LIMIT 1)) AS price_class
        FROM (SELECT *, CASE WHEN quantity > 1 THEN CAST(floor(product_price / 50) AS BIGINT) END AS price_class
              FROM insights)""",
    ),
)
def impute(spark: Session, sf_dir: str) -> DataFrame:
    """Median age, mean income, most frequent price class and a constant reason."""
    insights = roles.insights(spark, sf_dir)
    class_ = F.when(F.col("quantity") > 1, F.floor(F.col("product_price") / 50))
    sessions = insights.select(
        "customer_id",
        "session_start",
        "age",
        # Whole units keep the mean exact, whatever the order of addition.
        units(F.col("monthly_income")).alias("income_units"),
        "return_reason",
        class_.alias("price_class"),
    )
    mean = sessions.agg(from_units(F.sum("income_units")) / F.count("income_units")).scalar()
    filled = quality.impute(
        sessions, {"age": "median", "return_reason": ("constant", "none"), "price_class": "mode"}
    )
    return filled.withColumn(
        "monthly_income", F.coalesce(from_units(F.col("income_units")), mean)
    ).drop("income_units")


@query(
    "auto_field",
    """SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_day, o_orderdate AS order_time, o_orderpriority
       FROM (SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_totalprice,
                    o_orderdate, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS t, o_orderpriority
             FROM orders) AS o(o_orderkey, o_totalprice, o_orderdate_plain, o_orderdate, o_orderpriority)""",
)
def auto_field(spark: Session, sf_dir: str) -> DataFrame:
    """Orders as text, cast back to the narrowest types."""
    orders = table(spark, sf_dir, "orders")
    time = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate"))
    text = orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
        time.cast("string").alias("order_time"),
        "o_orderpriority",
    )
    return quality.auto_field(text).withColumn(
        "order_time", F.col("order_time").cast("timestamp_ntz")
    )


# Projection, derivation, filter


@query(
    "try_cast_cols",
    """SELECT doc_id, TRY_CAST(word AS INTEGER) AS as_int, TRY_CAST(word AS DOUBLE) AS as_double,
              TRY_CAST(lang AS INTEGER) AS lang, n_chars::INTEGER AS n_chars
       FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN CAST(n_chars AS VARCHAR)
                            ELSE CAST(n_chars AS VARCHAR) || 'x' END AS word FROM documents)""",
)
def try_cast_cols(spark: Session, sf_dir: str) -> DataFrame:
    """Numbers, words and malformed numbers in one text column, cast to numbers."""
    key, size = F.col("doc_id"), F.col("n_chars").cast("string")
    word = F.when(key % 3 == 0, F.col("lang")).when(key % 3 == 1, size).otherwise(F.concat(size, F.lit("x")))
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", word.alias("as_int"), word.alias("as_double"), "lang", "n_chars"
    )
    return project.try_cast_columns(
        documents, {"as_int": "int", "as_double": "double", "lang": "int", "n_chars": "int", "absent": "int"}
    )


@query(
    "select_rename_drop",
    """SELECT l_orderkey AS order_id, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS line, l_quantity,
              l_extendedprice AS price, l_discount, l_tax, l_returnflag, l_linestatus
       FROM lineitem""",
)
def select_rename_drop(spark: Session, sf_dir: str) -> DataFrame:
    return project.select_fields(
        table(spark, sf_dir, "lineitem"),
        drop=["l_shipdate"],
        rename={"l_orderkey": "order_id", "l_extendedprice": "price", "l_linenumber": "line"},
        types={"l_linenumber": "bigint"},
        keep_unknown=True,
    )


@query(
    "filter_split",
    using(
        "transactions",
        """SELECT transaction_id, channel, amount,
                  CASE WHEN amount >= 50 THEN 'true' WHEN amount < 50 THEN 'false' ELSE 'null' END AS output
           FROM transactions""",
    ),
)
def filter_split(spark: Session, sf_dir: str) -> DataFrame:
    """Both outputs, and the rows in neither because the condition is NULL."""
    rows_ = roles.transactions(spark, sf_dir).select("transaction_id", "channel", "amount")
    condition = F.col("amount") >= 50
    true, false = filters.filter_split(rows_, condition)
    return (
        true.withColumn("output", F.lit("true"))
        .unionByName(false.withColumn("output", F.lit("false")))
        .unionByName(rows_.where(condition.isNull()).withColumn("output", F.lit("null")))
    )


@query(
    "filter_simple",
    """SELECT count(*) AS all_rows, count(*) FILTER (l_quantity = 25) AS eq, count(*) FILTER (l_quantity <> 25) AS ne,
              count(*) FILTER (l_quantity < 25) AS lt, count(*) FILTER (l_quantity <= 25) AS le,
              count(*) FILTER (l_quantity > 25) AS gt, count(*) FILTER (l_quantity >= 25) AS ge,
              count(*) FILTER (l_tax IS NULL) AS is_null, count(*) FILTER (l_tax IS NOT NULL) AS is_not_null,
              count(*) FILTER (contains(CAST(l_orderkey AS VARCHAR), '99')) AS has_text
       FROM lineitem""",
)
def filter_simple(spark: Session, sf_dir: str) -> DataFrame:
    """Rows that pass each simple predicate; the operand is text, the column a number."""
    lineitem = table(spark, sf_dir, "lineitem")
    names = {"eq": "=", "ne": "!=", "lt": "<", "le": "<=", "gt": ">", "ge": ">="}
    tests = {n: filters.simple_predicate(lineitem, "l_quantity", op, "25") for n, op in names.items()}
    tests["is_null"] = filters.simple_predicate(lineitem, "l_tax", "is null")
    tests["is_not_null"] = filters.simple_predicate(lineitem, "l_tax", "is not null")
    tests["has_text"] = filters.simple_predicate(lineitem, "l_orderkey", "contains", "99")
    return lineitem.agg(
        F.count(F.lit(1)).alias("all_rows"), *[F.count_if(test).alias(n) for n, test in tests.items()]
    )


@query(
    "formula",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate,
              l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross,
              CASE WHEN l_extendedprice * (1 - l_discount) * (1 + l_tax) > 50000 THEN 'large' ELSE 'small' END AS size,
              CAST(l_linenumber * 10 AS BIGINT) AS l_linenumber_10
       FROM lineitem""",
)
def formula(spark: Session, sf_dir: str) -> DataFrame:
    """Later fields use earlier ones; one field is cast to a declared type."""
    lineitem = table(spark, sf_dir, "lineitem")
    result = project.formula(
        lineitem,
        [
            ("net", F.col("l_extendedprice") * (1 - F.col("l_discount"))),
            ("gross", F.col("net") * (1 + F.col("l_tax"))),
            ("size", "CASE WHEN gross > 50000 THEN 'large' ELSE 'small' END"),
            ("l_linenumber_10", F.col("l_linenumber") * 10, "bigint"),
        ],
    )
    return result.drop("l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query(
    "formula_multi_field",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax, l_discount * 100 AS pct_l_discount,
              l_tax * 100 AS pct_l_tax
       FROM lineitem""",
)
def formula_multi_field(spark: Session, sf_dir: str) -> DataFrame:
    rates = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax"
    )
    return project.formula_multi_field(rates, ["l_discount", "l_tax"], lambda c: c * 100, "pct_")


@query(
    "record_id",
    """SELECT row_number() OVER (ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS "RecordID", o_orderkey, o_orderdate
       FROM orders""",
)
def record_id(spark: Session, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ordering.record_id(orders, [("o_orderdate", "desc"), "o_orderkey"])


@query(
    "generate_rows",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, step
       FROM lineitem, unnest(range(1, CAST(l_quantity AS BIGINT) + 1, 10)) AS t(step)""",
)
def generate_rows(spark: Session, sf_dir: str) -> DataFrame:
    """For each line the units 1, 11, 21 … up to its quantity."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    return rows.generate_rows(lines, "step", 1, F.col("l_quantity"), 10)


# Joins


def _sales(spark: Session, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Transactions (product NULL in store) and the products, whose key has another name."""
    left = roles.transactions(spark, sf_dir).select("channel", "transaction_id", "product_id", "amount")
    right = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("amount"), "p_brand")
    return left, right


@query(
    "join_inner",
    using(
        "transactions",
        """SELECT channel, transaction_id, product_id, t.amount, p_brand AS brand, p_partkey, p_size AS "Right_amount"
           FROM transactions t JOIN part ON product_id = p_partkey""",
    ),
)
def join_inner(spark: Session, sf_dir: str) -> DataFrame:
    left, right = _sales(spark, sf_dir)
    matched, _, _ = joins.join_outputs(left, right, [("product_id", "p_partkey")], {"p_brand": "brand"})
    return matched


@query(
    "join_left_only",
    using(
        "transactions",
        """SELECT channel, transaction_id, product_id, amount FROM transactions
           WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = product_id)""",
    ),
)
def join_left_only(spark: Session, sf_dir: str) -> DataFrame:
    left, right = _sales(spark, sf_dir)
    return joins.join_outputs(left, right, [("product_id", "p_partkey")])[1]


@query(
    "join_right_only",
    using(
        "transactions",
        """SELECT customer_id, email FROM
             (SELECT c_custkey AS customer_id, c_name AS email FROM customer)
           WHERE customer_id NOT IN (SELECT customer_id FROM transactions)""",
    ),
)
def join_right_only(spark: Session, sf_dir: str) -> DataFrame:
    """Customers that never bought; the left key is heavily skewed."""
    left = roles.transactions(spark, sf_dir).select("transaction_id", "customer_id")
    right = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("email")
    )
    return joins.join_outputs(left, right, ["customer_id"])[2]


@query(
    "join_all_outputs",
    using(
        "transactions",
        """SELECT channel, transaction_id, product_id, t.amount, p_partkey, p_brand AS brand, p_size AS size,
                  CASE WHEN p_partkey IS NULL THEN 'left' WHEN transaction_id IS NULL THEN 'right' ELSE 'matched' END AS output
           FROM transactions t FULL JOIN (SELECT * FROM part WHERE p_partkey % 3 > 0) ON product_id = p_partkey""",
    ),
)
def join_all_outputs(spark: Session, sf_dir: str) -> DataFrame:
    """All three outputs of a join, each input computed once."""
    left = roles.transactions(spark, sf_dir).select("channel", "transaction_id", "product_id", "amount")
    right = table(spark, sf_dir, "part").where("p_partkey % 3 > 0").select(
        "p_partkey", F.col("p_brand").alias("brand"), F.col("p_size").alias("size")
    )
    found = outputs.JoinOutputs(left, right, [("product_id", "p_partkey")])
    named = {"matched": found.matched, "left": found.left_only, "right": found.right_only}
    return rows.union_by_name([df.withColumn("output", F.lit(name)) for name, df in named.items()])


@query(
    "join_output_counts",
    using(
        "transactions",
        """SELECT 'left_matched' AS output, count(*) AS n FROM transactions
             WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
           UNION ALL SELECT 'left_only', count(*) FROM transactions
             WHERE customer_id IS NULL OR customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
           UNION ALL SELECT 'right_matched', count(*) FROM customer
             WHERE c_acctbal > 0 AND c_custkey IN (SELECT customer_id FROM transactions WHERE customer_id IS NOT NULL)
           UNION ALL SELECT 'right_only', count(*) FROM customer
             WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT customer_id FROM transactions WHERE customer_id IS NOT NULL)""",
    ),
)
def join_output_counts(spark: Session, sf_dir: str) -> DataFrame:
    """How many rows of each side match, counted while the outputs are written."""
    left = roles.transactions(spark, sf_dir).select("transaction_id", "customer_id")
    right = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_name")
    with outputs.JoinOutputs(left, right, [("customer_id", "c_custkey")]) as found:
        return spark.createDataFrame(list(found.rows.items()), "output string, n bigint")


@query(
    "filter_all_outputs",
    using(
        "transactions",
        """SELECT transaction_id, channel, amount,
                  CASE WHEN amount >= 50 THEN 'true' WHEN amount < 50 THEN 'false' ELSE 'null' END AS output
           FROM transactions""",
    ),
)
def filter_all_outputs(spark: Session, sf_dir: str) -> DataFrame:
    """The outputs of a condition, from one pass over the rows."""
    rows_ = roles.transactions(spark, sf_dir).select("transaction_id", "channel", "amount")
    found = outputs.filter_outputs(rows_, F.col("amount") >= 50)
    return rows.union_by_name([df.withColumn("output", F.lit(name)) for name, df in found.items()])


@query(
    "unique_all_outputs",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
              CASE WHEN row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) = 1
                   THEN 'unique' ELSE 'duplicate' END AS output
       FROM lineitem""",
)
def unique_all_outputs(spark: Session, sf_dir: str) -> DataFrame:
    """First shipment of each part and all later ones, from one numbering."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    found = outputs.unique_outputs(lines, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])
    return rows.union_by_name([df.withColumn("output", F.lit(name)) for name, df in found.items()])


@query(
    "join_full_outer",
    using(
        "transactions loyalty",
        """SELECT coalesce(t.customer_id, l.customer_id) AS customer_id, channel, transaction_id, loyalty_id, tier_level
           FROM transactions t FULL JOIN loyalty l ON t.customer_id = l.customer_id""",
    ),
)
def join_full_outer(spark: Session, sf_dir: str) -> DataFrame:
    return joins.join_tables(
        roles.transactions(spark, sf_dir).select("customer_id", "channel", "transaction_id"),
        roles.loyalty(spark, sf_dir).select("customer_id", "loyalty_id", "tier_level"),
        ["customer_id"],
        "outer",
    )


@query(
    "join_left",
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice
       FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND c_nationkey = o_orderkey % 25""",
)
def join_left(spark: Session, sf_dir: str) -> DataFrame:
    """Two keys with different names on each side."""
    orders = table(spark, sf_dir, "orders").withColumn("nation", (F.col("o_orderkey") % 25).cast("int"))
    return joins.join_tables(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name"),
        orders.select("o_custkey", "nation", "o_orderkey", "o_totalprice"),
        [("c_custkey", "o_custkey"), ("c_nationkey", "nation")],
        "left",
        {"c_nationkey": None, "nation": None, "o_custkey": None},
    )


@query(
    "join_right",
    using(
        "transactions",
        """SELECT channel, transaction_id, product_id, t.amount, p_partkey, p_brand, p_size AS "Right_amount"
           FROM transactions t RIGHT JOIN part ON product_id = p_partkey""",
    ),
)
def join_right(spark: Session, sf_dir: str) -> DataFrame:
    left, right = _sales(spark, sf_dir)
    return joins.join_tables(left, right, [("product_id", "p_partkey")], "right")


@query(
    "find_replace",
    """SELECT o_orderkey, o_custkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS customer, c_mktsegment
       FROM orders LEFT JOIN (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 0) c
         ON o_custkey = c_custkey""",
)
def find_replace(spark: Session, sf_dir: str) -> DataFrame:
    """Customer numbers replaced by names where the lookup has them; every lookup row is there twice."""
    nation = table(spark, sf_dir, "nation").where("n_regionkey <> 0")
    customer = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    lookup = customer.select(F.col("c_custkey").cast("string").alias("number"), "c_name", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_custkey").cast("string").alias("customer")
    )
    return joins.find_replace(
        orders, "customer", lookup.unionByName(lookup), "number", "c_name", append=["c_mktsegment"]
    )


@query(
    "find_replace_start",
    """SELECT c_custkey, CASE WHEN b.brand IS NULL THEN c_mktsegment
                              ELSE b.name || substr(c_mktsegment, length(b.brand) + 1) END AS c_mktsegment
       FROM customer LEFT JOIN
         (SELECT brand, min(name) AS name FROM
            (SELECT CASE p_size % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'BUILD' ELSE 'MACH' END AS brand, p_type AS name FROM part)
          GROUP BY brand) b
         ON starts_with(c_mktsegment, b.brand)
       QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY length(b.brand) DESC NULLS LAST) = 1""",
)
def find_replace_start(spark: Session, sf_dir: str) -> DataFrame:
    """The longest key a value begins with is replaced."""
    size = F.col("p_size") % 3
    key = F.when(size == 0, "B").when(size == 1, "BUILD").otherwise("MACH")
    lookup = table(spark, sf_dir, "part").select(key.alias("brand"), F.col("p_type").alias("name"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return joins.find_replace(customer, "c_mktsegment", lookup, "brand", "name", mode="start")


@query(
    "find_replace_any",
    """SELECT p_partkey, CASE WHEN word IS NULL THEN p_name ELSE replace(p_name, word, code) END AS p_name
       FROM part LEFT JOIN
         (SELECT DISTINCT split_part(p_name, ' ', 1) AS word, 'C' || length(split_part(p_name, ' ', 1)) AS code FROM part)
         ON contains(p_name, word)
       QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(word) DESC NULLS LAST, word) = 1""",
)
def find_replace_any(spark: Session, sf_dir: str) -> DataFrame:
    """The longest key found anywhere in a value is replaced wherever it occurs."""
    part = table(spark, sf_dir, "part")
    word = F.get(F.split("p_name", " "), F.lit(0))
    lookup = part.select(word.alias("word"), F.concat(F.lit("C"), F.length(word)).alias("code"))
    return joins.find_replace(part.select("p_partkey", "p_name"), "p_name", lookup, "word", "code", mode="any")


@query(
    "find_replace_any_texts",
    r"""WITH keys AS (SELECT DISTINCT left(text, 12) AS key, 'K' || length(left(text, 12)) AS code FROM documents WHERE text <> '')
       SELECT doc_id, sha256(CASE WHEN key IS NULL THEN text ELSE replace(text, key, code) END) AS text_sha256, code
       FROM documents LEFT JOIN keys ON contains(text, key)
       QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(key) DESC NULLS LAST, key) = 1""",
)
def find_replace_any_texts(spark: Session, sf_dir: str) -> DataFrame:
    """The beginnings of all documents as keys, looked for anywhere in all documents."""
    documents = table(spark, sf_dir, "documents")
    start = F.left("text", F.lit(12))
    lookup = documents.where("text <> ''").select(
        start.alias("key"), F.concat(F.lit("K"), F.length(start)).alias("code")
    )
    found = joins.find_replace(
        documents.select("doc_id", "text"), "text", lookup, "key", "code", append=["code"], mode="any"
    )
    return found.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "code")


@query("append_fields", "SELECT s_suppkey, s_name, r_regionkey, r_name FROM supplier, region")
def append_fields(spark: Session, sf_dir: str) -> DataFrame:
    return joins.append_fields(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), table(spark, sf_dir, "region")
    )


@query(
    "join_dims",
    using(
        "transactions products stores",
        """SELECT channel, transaction_id, product_id, store_id, amount, product_name, price_tier, location
           FROM transactions LEFT JOIN products USING (product_id) LEFT JOIN stores USING (store_id)""",
    ),
)
def join_dims(spark: Session, sf_dir: str) -> DataFrame:
    sales = roles.transactions(spark, sf_dir).select("channel", "transaction_id", "product_id", "store_id", "amount")
    products = roles.products(spark, sf_dir).select("product_id", "product_name", "price_tier")
    stores = roles.stores(spark, sf_dir).select("store_id", "location")
    return joins.lookup_dimensions(sales, [(products, "product_id"), (stores, "store_id")])


# Aggregation, pivot, window


@query(
    "summarize_all",
    f"""SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, count(q) AS filled, count(*) AS lines,
               count(q) AS non_null, count(DISTINCT l_partkey) AS parts, avg(CAST(l_quantity AS BIGINT)) AS mean,
               min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
               {half_up("stddev_samp(l_quantity)", 6)} AS spread, {half_up("var_samp(l_quantity)", 6)} AS variance
        FROM (SELECT *, CASE WHEN l_quantity > 10 THEN l_quantity END AS q FROM lineitem) GROUP BY l_returnflag""",
)
def summarize_all(spark: Session, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {"units": F.col("l_quantity").cast("bigint"), "q": F.when(F.col("l_quantity") > 10, F.col("l_quantity"))}
    )
    result = aggregate.summarize(
        lines,
        ["l_returnflag"],
        [
            Summary("units", "Sum", "total"),
            Summary("q", "Count", "filled"),
            Summary("q", "CountAll", "lines"),
            Summary("q", "CountNonNull", "non_null"),
            Summary("l_partkey", "CountDistinct", "parts"),
            Summary("units", "Avg", "mean"),
            Summary("l_shipdate", "Min", "first_ship"),
            Summary("l_shipdate", "Max", "last_ship"),
            Summary("l_quantity", "StdDev", "spread"),
            Summary("l_quantity", "Variance", "variance"),
        ],
    )
    return result.withColumns({"spread": F.round("spread", 6), "variance": F.round("variance", 6)})


@query(
    "summarize_global",
    """SELECT count(o_orderkey) AS orders, count(DISTINCT o_custkey) AS customers, min(o_orderdate) AS first_day,
              max(o_orderdate) AS last_day
       FROM orders""",
)
def summarize_global(spark: Session, sf_dir: str) -> DataFrame:
    """No group: one row for the whole table."""
    return aggregate.summarize(
        table(spark, sf_dir, "orders"),
        [],
        [
            Summary("o_orderkey", "Count", "orders"),
            Summary("o_custkey", "CountDistinct", "customers"),
            Summary("o_orderdate", "Min", "first_day"),
            Summary("o_orderdate", "Max", "last_day"),
        ],
    )


@query(
    "summarize_concat",
    """SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS order_keys,
              count(*) AS n
       FROM orders GROUP BY o_custkey""",
)
def summarize_concat(spark: Session, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return aggregate.summarize(
        orders,
        ["o_custkey"],
        [Summary("o_orderkey", "Concat", "order_keys"), Summary("o_orderkey", "CountAll", "n")],
        order_by=["o_orderdate", "o_orderkey"],
    )


@query(
    "summarize_first_last",
    """SELECT o_custkey, first(o_orderpriority ORDER BY o_orderdate, o_orderkey) AS first_priority,
              last(o_orderpriority ORDER BY o_orderdate, o_orderkey) AS last_priority,
              first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS odd_action
       FROM orders GROUP BY o_custkey""",
)
def summarize_first_last(spark: Session, sf_dir: str) -> DataFrame:
    """An unknown action counts as First."""
    return aggregate.summarize(
        table(spark, sf_dir, "orders"),
        ["o_custkey"],
        [
            Summary("o_orderpriority", "First", "first_priority"),
            Summary("o_orderpriority", "Last", "last_priority"),
            Summary("o_totalprice", "Mystery", "odd_action"),
        ],
        order_by=["o_orderdate", "o_orderkey"],
    )


@query(
    "cross_tab",
    """SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'A') AS BIGINT) AS "A",
              CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'N') AS BIGINT) AS "N",
              CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'R') AS BIGINT) AS "R"
       FROM lineitem GROUP BY l_suppkey""",
)
def cross_tab(spark: Session, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("units")
    )
    return aggregate.cross_tab(lines, ["l_suppkey"], "l_returnflag", "units", "Sum", ["A", "N", "R"])


@query(
    "cross_tab_rest",
    """SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'A') AS BIGINT) AS "A",
              CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag IS DISTINCT FROM 'A') AS BIGINT) AS "other"
       FROM lineitem GROUP BY l_suppkey""",
)
def cross_tab_rest(spark: Session, sf_dir: str) -> DataFrame:
    """Headers that are not listed share a column."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("units")
    )
    return aggregate.cross_tab(lines, ["l_suppkey"], "l_returnflag", "units", "Sum", ["A"], rest="other")


@query(
    "cross_tab_methods",
    """SELECT o_custkey, min(o_totalprice) FILTER (o_orderstatus = 'F') AS min_F,
              min(o_totalprice) FILTER (o_orderstatus = 'O') AS min_O,
              min(o_totalprice) FILTER (o_orderstatus = 'P') AS min_P,
              string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FILTER (o_orderstatus = 'F') AS keys_F,
              string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FILTER (o_orderstatus = 'O') AS keys_O,
              string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FILTER (o_orderstatus = 'P') AS keys_P
       FROM orders GROUP BY o_custkey""",
)
def cross_tab_methods(spark: Session, sf_dir: str) -> DataFrame:
    """Other methods than Sum, and header values that are looked up."""
    orders = table(spark, sf_dir, "orders")
    smallest = aggregate.cross_tab(orders, ["o_custkey"], "o_orderstatus", "o_totalprice", "Min")
    keys = aggregate.cross_tab(
        orders, ["o_custkey"], "o_orderstatus", "o_orderkey", "Concat", order_by=["o_orderkey"]
    )
    return smallest.withColumnsRenamed({s: f"min_{s}" for s in "FOP"}).join(
        keys.withColumnsRenamed({s: f"keys_{s}" for s in "FOP"}), "o_custkey"
    )


@query(
    "transpose",
    """SELECT l_orderkey, l_partkey, l_linenumber, unnest(['l_quantity', 'l_discount', 'l_tax']) AS "Name",
              unnest([l_quantity, l_discount, l_tax]) AS "Value"
       FROM lineitem""",
)
def transpose(spark: Session, sf_dir: str) -> DataFrame:
    return aggregate.transpose(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_partkey", "l_linenumber"],
        ["l_quantity", "l_discount", "l_tax"],
        value_type="double",
    )


@query(
    "running_total",
    """SELECT o_custkey, o_orderkey, units, CAST(sum(units) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
       FROM (SELECT o_custkey, o_orderkey, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS units FROM orders)""",
)
def running_total(spark: Session, sf_dir: str) -> DataFrame:
    """Running order value of each customer."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("units")
    )
    return ordering.running_total(
        orders, "units", ["o_orderdate", "o_orderkey"], ["o_custkey"], "running"
    ).drop("o_orderdate")


@query(
    "running_total_global",
    """SELECT event_id, cents, CAST(sum(cents) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
       FROM (SELECT event_id, ts, CAST(round(value * 100) AS BIGINT) AS cents FROM events)""",
)
def running_total_global(spark: Session, sf_dir: str) -> DataFrame:
    """Running total of the whole table, with no group to divide the work."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.round(F.col("value") * 100).cast("bigint").alias("cents")
    )
    return ordering.running_total(events, "cents", ["ts", "event_id"], name="running").drop("ts")


@query(
    "multi_row_formula",
    """SELECT user_id, event_id, event_type, lag(event_type) OVER w AS previous_type, lead(event_id, 2) OVER w AS second_next,
              date_diff('second', date_trunc('second', lag(ts) OVER w), date_trunc('second', ts)) AS gap_seconds
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def multi_row_formula(spark: Session, sf_dir: str) -> DataFrame:
    """Previous and next rows of each user, and a value computed across two rows."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    near = ordering.neighbour_rows(
        events,
        {"previous_type": ("event_type", -1), "second_next": ("event_id", 2), "previous_ts": ("ts", -1)},
        ["ts", "event_id"],
        ["user_id"],
    )
    seconds = F.timestamp_diff(
        "SECOND", F.date_trunc("second", "previous_ts"), F.date_trunc("second", "ts")
    )
    return near.withColumn("gap_seconds", seconds).drop("ts", "previous_ts")


@query(
    "window_misc",
    """SELECT p_brand, p_partkey, p_size, row_number() OVER t AS row_number, rank() OVER w AS rank,
              dense_rank() OVER w AS dense_rank, percent_rank() OVER w AS percent_rank, ntile(4) OVER t AS ntile,
              lag(p_partkey) OVER t AS previous, lead(p_partkey) OVER t AS next
       FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size DESC NULLS LAST),
                        t AS (PARTITION BY p_brand ORDER BY p_size DESC NULLS LAST, p_partkey)""",
)
def window_misc(spark: Session, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size")
    order = [("p_size", "desc"), "p_partkey"]
    near = ordering.neighbour_rows(
        part, {"previous": ("p_partkey", -1), "next": ("p_partkey", 1)}, order, ["p_brand"]
    )
    numbered = ranking.rank_rows(near, ["p_brand"], order, buckets=4)
    tied = ranking.rank_rows(near, ["p_brand"], [("p_size", "desc")], buckets=4)
    ties = tied.select("p_partkey", "rank", "dense_rank", "percent_rank")
    return numbered.drop("rank", "dense_rank", "percent_rank").join(ties, "p_partkey")


# Set operations, sort, sample, unique


@query(
    "union_by_name",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, NULL AS s_suppkey, NULL AS n_name FROM customer
       UNION ALL SELECT NULL, s_name, s_nationkey, s_acctbal, NULL, s_suppkey, NULL FROM supplier
       UNION ALL SELECT NULL, NULL, n_nationkey, NULL, NULL, NULL, n_name FROM nation""",
)
def union_by_name(spark: Session, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").withColumnsRenamed(
        {"s_name": "c_name", "s_nationkey": "c_nationkey", "s_acctbal": "c_acctbal"}
    )
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return rows.union_by_name([table(spark, sf_dir, "customer"), supplier, nation])


@query(
    "sort_multi",
    "SELECT * FROM lineitem ORDER BY l_returnflag ASC NULLS FIRST, l_extendedprice DESC NULLS LAST, l_orderkey",
)
def sort_multi(spark: Session, sf_dir: str) -> DataFrame:
    return rows.sort_rows(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", ("l_extendedprice", "desc"), "l_orderkey"]
    )


@query("sample_first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def sample_first_n(spark: Session, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return rows.first_rows(orders, 100, [("o_totalprice", "desc"), "o_orderkey"])


@query(
    "sample_per_group",
    """SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 20""",
)
def sample_per_group(spark: Session, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return rows.first_rows_per_group(orders, 20, ["o_orderpriority"], [("o_totalprice", "desc"), "o_orderkey"])


@query(
    "sample_hash",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) < CAST(0.1 * 4294967296 AS BIGINT)""",
)
def sample_hash(spark: Session, sf_dir: str) -> DataFrame:
    """All orders of a repeatable tenth of the customers."""
    return rows.key_sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], 10)


@query("sample_random")
def sample_random(spark: Session, sf_dir: str) -> DataFrame:
    """Each line with probability one tenth."""
    return rows.random_sample(table(spark, sf_dir, "lineitem"), 0.1, seed=42)


@query(
    "sample_fixed",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       ORDER BY md5('7|' || o_orderkey || '|' || o_custkey) LIMIT 500""",
)
def sample_fixed(spark: Session, sf_dir: str) -> DataFrame:
    """Five hundred orders, each set of them as likely as any other."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows.fixed_sample(orders, 500, ["o_orderkey", "o_custkey"], seed=7)


@query(
    "unique_first",
    """SELECT user_id, event_type, event_id, ts FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def unique_first(spark: Session, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    return rows.unique_rows(events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "unique_duplicates",
    """SELECT user_id, event_type, event_id, ts,
              CASE WHEN row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
                   THEN 'unique' ELSE 'duplicate' END AS output
       FROM events""",
)
def unique_duplicates(spark: Session, sf_dir: str) -> DataFrame:
    """Both outputs, which together are the input."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    unique, duplicates = rows.unique_split(events, ["user_id", "event_type"], ["ts", "event_id"])
    return unique.withColumn("output", F.lit("unique")).unionByName(
        duplicates.withColumn("output", F.lit("duplicate"))
    )


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark: Session, sf_dir: str) -> DataFrame:
    return rows.distinct_rows(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag"))


@query(
    "upsert_latest",
    """SELECT o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM
         (SELECT o_orderkey, o_orderdate, o_orderstatus, o_totalprice, 0 AS new FROM orders
          UNION ALL
          SELECT l_orderkey, max(l_shipdate), 'S', CAST(count(*) AS DOUBLE), 1 FROM lineitem GROUP BY l_orderkey)
       QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, new DESC) = 1""",
)
def upsert_latest(spark: Session, sf_dir: str) -> DataFrame:
    """Orders updated with their last shipment, wherever that is newer."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("o_orderdate"),
        F.lit("S").alias("o_orderstatus"),
        F.count(F.lit(1)).cast("double").alias("o_totalprice"),
    )
    return rows.upsert(orders, shipped, ["o_orderkey"], "o_orderdate")


@query(
    "src_literal",
    """SELECT o_orderpriority, coalesce(service_level, 'unknown') AS service_level, note, count(*) AS orders
       FROM orders LEFT JOIN (VALUES ('1-URGENT', 'same day', 'call first'), ('2-HIGH', 'next day', NULL),
                                     ('5-LOW', 'weekly', NULL)) AS t(priority, service_level, note)
            ON o_orderpriority = priority
       GROUP BY ALL""",
)
def src_literal(spark: Session, sf_dir: str) -> DataFrame:
    """A typed-in table (empty cells are NULL) as the lookup of the orders."""
    levels = literal_rows(
        spark,
        ["o_orderpriority", "service_level", "note"],
        [["1-URGENT", "same day", "call first"], ["2-HIGH", "next day", ""], ["5-LOW", "weekly", ""]],
    )
    orders = table(spark, sf_dir, "orders").select("o_orderpriority")
    return (
        joins.lookup_dimensions(orders, [(levels, "o_orderpriority")])
        .groupBy("o_orderpriority", F.coalesce("service_level", F.lit("unknown")).alias("service_level"), "note")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
