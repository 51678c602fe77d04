"""Column functions, text tools and date tools on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crmflow.functions import scalar
from crmflow.operators import text
from crmflow.plans.dates import as_date
from crmflow.workload import roles
from crmflow.workload.registry import query, table
from crmflow.workload.role_sql import using

Session = SparkSession


@query(
    "fn_string",
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, ltrim('  ' || p_name || ' ') AS left_trimmed,
              rtrim('  ' || p_name || ' ') AS right_trimmed, upper(p_name) AS upper, lower(p_brand) AS lower,
              left(p_name, 3) AS left_3, right(p_name, 4) AS right_4, substr(p_name, 2, 5) AS mid, length(p_name) AS len,
              replace(p_brand, '#', '.') AS replaced, contains(p_name, 'red') AS has_red,
              starts_with(p_name, 'blue') AS starts_blue, ends_with(p_name, 'bolt') AS ends_bolt,
              instr(p_name, 'i') AS first_i, lpad(CAST(p_size AS VARCHAR), 5, '0') AS padded_left,
              rpad(p_type, 12, '.') AS padded_right, p_brand || '/' || p_type AS joined, p_name || NULL AS with_null
       FROM part""",
)
def fn_string(spark: Session, sf_dir: str) -> DataFrame:
    name, brand = F.col("p_name"), F.col("p_brand")
    spaced = F.concat(F.lit("  "), name, F.lit(" "))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.trim(spaced).alias("trimmed"),
        F.ltrim(spaced).alias("left_trimmed"),
        F.rtrim(spaced).alias("right_trimmed"),
        F.upper(name).alias("upper"),
        F.lower(brand).alias("lower"),
        scalar.left_text(name, 3).alias("left_3"),
        scalar.right_text(name, 4).alias("right_4"),
        F.substring(name, 2, 5).alias("mid"),
        F.length(name).alias("len"),
        scalar.replace_text(brand, "#", ".").alias("replaced"),
        name.contains("red").alias("has_red"),
        name.startswith("blue").alias("starts_blue"),
        name.endswith("bolt").alias("ends_bolt"),
        scalar.find_text(name, "i").alias("first_i"),
        F.lpad(F.col("p_size").cast("string"), 5, "0").alias("padded_left"),
        F.rpad("p_type", 12, ".").alias("padded_right"),
        F.concat(brand, F.lit("/"), F.col("p_type")).alias("joined"),
        F.concat(name, F.lit(None).cast("string")).alias("with_null"),
    )


@query(
    "fn_null",
    using(
        "customers",
        """SELECT customer_id, email IS NULL AS is_null, email IS NOT NULL AS is_not_null,
                  email_domain IS NULL OR email_domain = '' AS is_empty,
                  email_domain IS NOT NULL AND email_domain <> '' AS is_not_empty,
                  coalesce(email, 'none') AS if_null, nullif(full_address, customer_name) AS null_if,
                  nullif(is_valid_email, false) AS valid_or_null, CAST(NULL AS VARCHAR) AS nothing
           FROM customers""",
    ),
)
def fn_null(spark: Session, sf_dir: str) -> DataFrame:
    email, domain = F.col("email"), F.col("email_domain")
    return roles.customers(spark, sf_dir).select(
        "customer_id",
        email.isNull().alias("is_null"),
        email.isNotNull().alias("is_not_null"),
        scalar.is_empty(domain).alias("is_empty"),
        scalar.is_not_empty(domain).alias("is_not_empty"),
        F.coalesce(email, F.lit("none")).alias("if_null"),
        F.nullif("full_address", "customer_name").alias("null_if"),
        F.nullif("is_valid_email", F.lit(False)).alias("valid_or_null"),
        F.lit(None).cast("string").alias("nothing"),
    )


@query(
    "fn_convert",
    r"""SELECT event_id, CAST(user_id AS VARCHAR) AS as_text,
               TRY_CAST(regexp_extract(props, '\d+') AS DOUBLE) AS as_number,
               TRY_CAST(CASE WHEN event_type = 'error' THEN event_type ELSE regexp_extract(props, '\d+') END AS INTEGER)
                 AS as_integer,
               CASE WHEN event_type <> 'click' THEN CAST(ts AS DATE) END AS as_date,
               CASE WHEN event_type <> 'click' THEN date_trunc('second', ts) END AS as_time,
               CASE WHEN event_type <> 'click' THEN CAST(ts AS DATE) END AS plain_date
        FROM events""",
)
def fn_convert(spark: Session, sf_dir: str) -> DataFrame:
    """Text that does not fit its target (the clicks and errors) gives NULL."""
    digits = F.regexp_extract("props", r"\d+", 0)
    broken = F.col("event_type") == "click"
    day = F.when(broken, "no day").otherwise(F.date_format("ts", "dd/MM/yyyy"))
    time = F.when(broken, "25:99").otherwise(F.date_format("ts", "yyyyMMdd HHmmss"))
    iso = F.when(broken, "2024-13-45").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("as_text"),
        scalar.to_number(digits).alias("as_number"),
        scalar.to_integer(F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(digits)).alias(
            "as_integer"
        ),
        scalar.to_date(day, "dd/MM/yyyy").alias("as_date"),
        scalar.to_datetime(time, "yyyyMMdd HHmmss").cast("timestamp_ntz").alias("as_time"),
        scalar.to_date(iso).alias("plain_date"),
    )


@query(
    "fn_date",
    """SELECT o_orderkey, DATE '2001-08-02' AS today, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
              CAST(day(d) AS INTEGER) AS day, d + CAST(o_orderkey % 40 AS INTEGER) AS plus_days,
              CAST(d + INTERVAL 3 MONTH AS DATE) AS plus_months, CAST(d + INTERVAL 1 YEAR AS DATE) AS plus_years,
              CAST(date_diff('day', d, DATE '2001-08-02') AS INTEGER) AS days,
              CAST(date_sub('month', d, DATE '2001-08-02') AS INTEGER) AS months,
              CAST(date_sub('month', d, DATE '2001-08-02') // 12 AS INTEGER) AS years
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def fn_date(spark: Session, sf_dir: str) -> DataFrame:
    day, today = F.col("o_orderdate").cast("date"), as_date(roles.AS_OF)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        today.alias("today"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        scalar.date_plus(day, (F.col("o_orderkey") % 40).cast("int")).alias("plus_days"),
        scalar.date_plus(day, 3, "months").alias("plus_months"),
        scalar.date_plus(day, 1, "years").alias("plus_years"),
        scalar.date_diff(day, today).alias("days"),
        scalar.date_diff(day, today, "months").alias("months"),
        scalar.date_diff(day, today, "years").alias("years"),
    )


@query(
    "fn_date_parts",
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
              CAST(quarter(ts) AS INTEGER) AS quarter, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
              CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
              CAST(floor(second(ts)) AS INTEGER) AS second,
              CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INTEGER) AS days_left
       FROM events""",
)
def fn_date_parts(spark: Session, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.to_date("ts").alias("day"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.quarter("ts").alias("quarter"),
        F.dayofweek("ts").alias("day_of_week"),
        F.hour("ts").alias("hour"),
        F.minute("ts").alias("minute"),
        F.second("ts").alias("second"),
        F.datediff(F.lit("2024-02-01").cast("date"), F.to_date("ts")).alias("days_left"),
    )


@query(
    "fn_math",
    """SELECT c_custkey, abs(c_acctbal) AS absolute, CAST(ceil(c_acctbal) AS BIGINT) AS up,
              CAST(floor(c_acctbal) AS BIGINT) AS down,
              CAST(round(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(18, 4)), 1) AS DOUBLE) AS rounded,
              c_custkey % 7 AS remainder, pow(c_nationkey, 2) AS squared, sqrt(c_custkey) AS root,
              round(ln(c_custkey + 1), 9) AS natural_log, round(log10(c_custkey + 1), 9) AS log_10,
              round(exp(c_nationkey / 10), 6) AS exponential
       FROM customer""",
)
def fn_math(spark: Session, sf_dir: str) -> DataFrame:
    balance, key = F.col("c_acctbal"), F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.abs(balance).alias("absolute"),
        F.ceil(balance).alias("up"),
        F.floor(balance).alias("down"),
        F.round(balance, 1).alias("rounded"),
        (key % 7).alias("remainder"),
        F.pow("c_nationkey", F.lit(2)).alias("squared"),
        F.sqrt(key).alias("root"),
        F.round(F.log(key + 1), 9).alias("natural_log"),
        F.round(F.log10(key + 1), 9).alias("log_10"),
        F.round(F.exp(F.col("c_nationkey") / 10), 6).alias("exponential"),
    )


@query("fn_random")
def fn_random(spark: Session, sf_dir: str) -> DataFrame:
    """Seeded random numbers."""
    return table(spark, sf_dir, "customer").select("c_custkey", F.rand(7).alias("random"))


@query(
    "fn_least_greatest",
    using(
        "profile",
        """SELECT customer_id, least(max_transaction_value, online_spend, loyalty_points) AS smallest,
                  greatest(max_transaction_value, online_spend, loyalty_points) AS largest
           FROM profile""",
    ),
)
def fn_least_greatest(spark: Session, sf_dir: str) -> DataFrame:
    """Row-wise minimum and maximum; NULLs are skipped."""
    from crmflow.workload.business import profile

    columns = ["max_transaction_value", "online_spend", "loyalty_points"]
    return profile(spark, sf_dir).select(
        "customer_id", F.least(*columns).alias("smallest"), F.greatest(*columns).alias("largest")
    )


@query(
    "fn_regex",
    r"""SELECT doc_id, regexp_matches(text, '[0-9]{3}') AS has_digits, regexp_matches(text, 'x*') AS maybe_empty,
               regexp_extract(text, 'x*') <> '' AS not_empty,
               regexp_replace(text, '[aeiou]+', '-', 'g') AS no_vowels,
               CAST(len(regexp_extract_all(text, '[A-Z][a-z]+')) AS INTEGER) AS capitalized
        FROM documents""",
)
def fn_regex(spark: Session, sf_dir: str) -> DataFrame:
    body = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        scalar.regex_found(body, "[0-9]{3}").alias("has_digits"),
        scalar.regex_found(body, "x*", allow_empty=True).alias("maybe_empty"),
        scalar.regex_found(body, "x*").alias("not_empty"),
        F.regexp_replace(body, "[aeiou]+", "-").alias("no_vowels"),
        scalar.regex_count(body, "[A-Z][a-z]+").alias("capitalized"),
    )


@query(
    "regex_tool",
    r"""WITH parsed AS (
          SELECT c_custkey, regexp_matches(c_name, '#0+[1-9]') AS matches, regexp_replace(c_name, '0+', '0', 'g') AS short,
                 regexp_extract(c_name, '([A-Za-z]+)#([0-9]+)', 1) AS word,
                 regexp_extract(c_name, '([A-Za-z]+)#([0-9]+)', 2) AS digits, c_name
          FROM customer)
        SELECT c_custkey, matches, short, word, digits, unnest(regexp_extract_all(c_name, '[1-9]+')) AS token FROM parsed""",
)
def regex_tool(spark: Session, sf_dir: str) -> DataFrame:
    """Match, replace, parse into columns and tokenize into rows."""
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    df = text.regex_match(df, "c_name", "#0+[1-9]", "matches")
    df = text.regex_replace(df, "c_name", "0+", "0", "short")
    df = text.regex_parse(df, "c_name", "([A-Za-z]+)#([0-9]+)", ["word", "digits"])
    return text.regex_tokenize(df, "c_name", "[1-9]+", "token").drop("c_name")


@query(
    "regex_tokens",
    """SELECT token, count(*) AS n, count(DISTINCT doc_id) AS documents FROM
         (SELECT doc_id, unnest(regexp_extract_all(text, '[a-z]+')) AS token FROM documents)
       GROUP BY token""",
)
def regex_tokens(spark: Session, sf_dir: str) -> DataFrame:
    """Words of all documents with the number of times and documents they occur in."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = text.regex_tokenize(documents, "text", "[a-z]+", "token")
    # Counting per (word, document) first keeps a word found everywhere off a single task.
    per_document = tokens.groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_document.groupBy("token").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("documents"))


@query(
    "datetime_tool",
    """SELECT event_id, strftime(ts, '%d.%m.%Y %H:%M') AS as_text, date_trunc('minute', ts) AS parsed,
              CAST(NULL AS TIMESTAMP) AS misfit
       FROM events""",
)
def datetime_tool(spark: Session, sf_dir: str) -> DataFrame:
    """Time to text and back."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    df = text.datetime_to_text(events, "ts", "dd.MM.yyyy HH:mm", "as_text")
    df = text.text_to_datetime(df, "as_text", "dd.MM.yyyy HH:mm", "parsed")
    df = text.text_to_datetime(df, "event_type", "dd.MM.yyyy", "misfit")
    return df.select(
        "event_id",
        "as_text",
        F.col("parsed").cast("timestamp_ntz").alias("parsed"),
        F.col("misfit").cast("timestamp_ntz").alias("misfit"),
    )


@query(
    "text_to_columns",
    using(
        "customers",
        """SELECT customer_id, nullif(split_part(email, '.', 1), '') AS part1, split_part(email, '.', 2) AS part2,
                  CASE WHEN len(string_split(email, '.')) >= 3 THEN split_part(email, '.', 3) END AS part3,
                  CASE WHEN len(string_split(email, '.')) >= 6 THEN split_part(email, '.', 6) END AS part6
           FROM customers""",
    ),
)
def text_to_columns(spark: Session, sf_dir: str) -> DataFrame:
    """The delimiter is a dot, which as a pattern would match everything."""
    customers = roles.customers(spark, sf_dir).select("customer_id", "email")
    return text.text_to_columns(customers, "email", ".", 6, "part").drop("email", "part4", "part5")


@query(
    "text_to_columns_rest",
    """SELECT doc_id, string_split(text, ' ')[1] AS word1,
              CASE WHEN contains(text, ' ') THEN substr(text, instr(text, ' ') + 1) END AS word2
       FROM documents""",
)
def text_to_columns_rest(spark: Session, sf_dir: str) -> DataFrame:
    """The last column keeps what is behind the first delimiter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.text_to_columns(docs, "text", " ", 2, "word", keep_rest=True).drop("text")


@query(
    "text_to_rows",
    "SELECT doc_id, unnest(string_split(text, '. ')) AS text FROM documents",
)
def text_to_rows(spark: Session, sf_dir: str) -> DataFrame:
    """One row per sentence of every document."""
    return text.text_to_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ". ")


@query(
    "fn_case",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
              CASE WHEN l_quantity > 40 THEN 'bulk' WHEN l_quantity > 20 AND l_discount > 0.05 THEN 'deal'
                   WHEN l_returnflag = 'R' THEN 'returned' ELSE 'plain' END AS kind
       FROM lineitem""",
)
def fn_case(spark: Session, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity")
    kind = (
        F.when(quantity > 40, "bulk")
        .when((quantity > 20) & (F.col("l_discount") > 0.05), "deal")
        .when(F.col("l_returnflag") == "R", "returned")
        .otherwise("plain")
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", kind.alias("kind")
    )


@query(
    "fn_operators",
    using(
        "transactions",
        """SELECT channel, transaction_id, amount > 50 AND store_id < 10 AS both, amount > 50 OR store_id < 10 AS either,
                  NOT (amount > 50) AS negated, amount <> 50 AS differs, amount <= 20 AS at_most,
                  payment_method IN ('1-URGENT', '5-LOW') AS listed, payment_method LIKE '%-H%' AS matches
           FROM transactions""",
    ),
)
def fn_operators(spark: Session, sf_dir: str) -> DataFrame:
    """Logic over NULL amounts and stores has three values."""
    large, near = F.col("amount") > 50, F.col("store_id") < 10
    return roles.transactions(spark, sf_dir).select(
        "channel",
        "transaction_id",
        (large & near).alias("both"),
        (large | near).alias("either"),
        (~large).alias("negated"),
        (F.col("amount") != 50).alias("differs"),
        (F.col("amount") <= 20).alias("at_most"),
        scalar.in_list(F.col("payment_method"), "1-URGENT", "5-LOW").alias("listed"),
        F.col("payment_method").like("%-H%").alias("matches"),
    )


@query(
    "fn_misc",
    r"""SELECT event_id, strftime(ts, '%Y/%m') AS month, CAST(minute(ts) AS INTEGER) AS minute,
               CAST(CAST(ts AS DATE) - 3 AS DATE) AS before, CAST(CAST(ts AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month,
               upper(event_type[1]) || event_type[2:] AS title, instr(event_type, 'i') AS place, md5(props) AS md5,
               sha1(props) AS sha1, sha256(props) AS sha256, json_extract_string(props, '$.k') AS k,
               CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS k_plus,
               CAST(len(list_distinct([event_type, 'view', 'view'])) AS INTEGER) AS kinds
        FROM events""",
)
def fn_misc(spark: Session, sf_dir: str) -> DataFrame:
    kind, day = F.col("event_type"), F.col("ts").cast("date")
    parsed = F.from_json("props", "k int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy/MM").alias("month"),
        F.minute("ts").alias("minute"),
        F.date_sub(day, 3).alias("before"),
        F.add_months(day, 1).alias("next_month"),
        F.initcap(kind).alias("title"),
        F.instr(kind, "i").alias("place"),
        F.md5("props").alias("md5"),
        F.sha1("props").alias("sha1"),
        F.sha2("props", 256).alias("sha256"),
        F.get_json_object("props", "$.k").alias("k"),
        (parsed["k"] + 1).alias("k_plus"),
        F.size(F.array_distinct(F.array_union(F.array(kind, F.lit("view")), F.array(F.lit("view"))))).alias("kinds"),
    )


@query("fn_hash")
def fn_hash(spark: Session, sf_dir: str) -> DataFrame:
    """Spark's own row hashes, which no other engine shares."""
    return table(spark, sf_dir, "events").select("event_id", F.hash("*").alias("hash"), F.xxhash64("*").alias("long_hash"))
