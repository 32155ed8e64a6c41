"""Names, alignment, unions, keyword filters, imputation and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.catalog.registry import query, read
from careflow.functions.naming import clean_column_names, find_columns, quoted, resolve_column
from careflow.functions.temporal import parse_text_timestamp, render_date_columns
from careflow.operators.filters import keyword_rows
from careflow.operators.impute import approximate_medians, fill_missing
from careflow.operators.keyword_join import keyword_semijoin
from careflow.operators.projection import align, prefix_columns
from careflow.operators.union import outer_union

_DIRTY = {"p_partkey": " 编号 ", "p_name": "名称（文字）", "p_brand": "a_b-c#d",
          "p_size": "年龄（周岁）", "p_type": "诊断（ICD编码）", "p_retailprice": " 价　格 "}


@query("clean_names", """SELECT p_partkey AS "编号", p_name AS "名称文字", p_brand AS "a_bcd",
  p_size AS "年龄周岁", p_type AS "诊断ICD编码", p_retailprice AS "价 格" FROM part""")
def clean_names(spark, sf_dir):
    return clean_column_names(read(spark, sf_dir, "part").withColumnsRenamed(_DIRTY))


@query("find_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate::VARCHAR AS l_shipdate FROM lineitem")
def find_key_columns(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    found = lines.select(*find_columns(lines.columns, ["key", "date"]))
    return found.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query("resolve_column", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def resolve_status(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    column = resolve_column(orders.columns, ["state", "status"])
    return orders.groupBy(F.col(quoted(column)).alias("status")).agg(F.count("*").alias("n"))


@query("align_schema", """SELECT CAST(c_custkey AS VARCHAR) AS "患者ID", c_name AS "姓名",
  CAST(c_nationkey AS VARCHAR) AS "地区", CAST(NULL AS VARCHAR) AS "年龄", c_mktsegment AS "人群类别",
  '' AS "就诊日期" FROM customer""")
def align_schema(spark, sf_dir):
    customer = read(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_custkey": "患者ID", "c_name": " 姓名 ", "c_nationkey": "地区", "c_mktsegment": "（人群类别）"})
    target = ["患者ID", "姓名", "地区", "年龄", "人群类别", "就诊日期"]
    return customer.select(*align(customer, target, clean=True))


@query("prefix_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def prefix(spark, sf_dir):
    return prefix_columns(read(spark, sf_dir, "lineitem"), 4)


@query("outer_union", """
SELECT o_orderkey AS "key", o_orderpriority AS kind, CAST(o_totalprice AS VARCHAR) AS amount,
  o_orderstatus AS status, CAST(NULL AS BIGINT) AS user_id FROM
  (SELECT o_orderkey, o_orderpriority, o_orderstatus, round(o_totalprice)::BIGINT AS o_totalprice FROM orders)
UNION ALL SELECT event_id, event_type, props, NULL, user_id FROM events""")
def outer_union_by_name(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("kind"),
        F.round("o_totalprice").cast("bigint").alias("amount"), F.col("o_orderstatus").alias("status"))
    events = read(spark, sf_dir, "events").select(
        F.col("event_id").alias("key"), F.col("event_type").alias("kind"),
        F.col("props").alias("amount"), "user_id")
    return outer_union([orders, events])


_WORDS = ("license", "Copyright", "password", "tion the", "http")


@query("keyword_documents", "SELECT doc_id, lang FROM documents WHERE " + " OR ".join(
    f"contains(text, '{w}')" for w in _WORDS))
def keyword_documents(spark, sf_dir):
    return keyword_rows(read(spark, sf_dir, "documents"), "text", _WORDS).select("doc_id", "lang")


_PASSAGES_SQL = """SELECT doc_id, lang FROM documents d
WHERE EXISTS (SELECT 1 FROM benchmark b WHERE contains(d.text, b.text))"""


def _passages(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Documents that hold a passage; every seventh has no key."""
    documents, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    key = F.when(F.col("doc_id") % 7 > 0, F.col("doc_id"))
    found = keyword_semijoin(
        documents.select("doc_id", "lang", "text", key.alias("known_id"), F.when(key.isNull(), F.col("doc_id")).alias("other_id")),
        "text", benchmark.select(F.col("text").alias("passage")), "passage",
        ["known_id", "other_id"], **options)
    return found.select("doc_id", "lang")


@query("keyword_semijoin", _PASSAGES_SQL)
def passages(spark, sf_dir):
    return _passages(spark, sf_dir)


@query("keyword_semijoin_nested", _PASSAGES_SQL)
def passages_nested(spark, sf_dir):
    """Term by term as far as the measure of the vocabulary allows."""
    return _passages(spark, sf_dir, max_nested_terms=100_000)


@query("keyword_semijoin_broadcast", _PASSAGES_SQL)
def passages_broadcast(spark, sf_dir):
    """By anchors, whatever the size of the vocabulary."""
    return _passages(spark, sf_dir, max_nested_terms=0)


@query("keyword_semijoin_shuffled", _PASSAGES_SQL)
def passages_shuffled(spark, sf_dir):
    return _passages(spark, sf_dir, max_nested_terms=0)


@query("keyword_semijoin_shared_beginning", """SELECT o_orderkey, o_orderstatus FROM (
  SELECT o_orderkey, o_orderstatus, 'sent to https://shop.example.com/customers/Customer#'
    || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || ', thanks' AS note FROM orders) o
WHERE EXISTS (SELECT 1 FROM customer c WHERE c_acctbal > 4000
  AND contains(o.note, 'https://shop.example.com/customers/' || c_name))""")
def shared_beginning(spark, sf_dir):
    """Terms that share their first 44 bytes with each other and with every text."""
    address = "https://shop.example.com/customers/"
    number = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    notes = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.concat(F.lit(f"sent to {address}Customer#"), number, F.lit(", thanks")).alias("note"))
    customers = read(spark, sf_dir, "customer").where("c_acctbal > 4000")
    terms = customers.select(F.concat(F.lit(address), "c_name").alias("term"))
    found = keyword_semijoin(notes, "note", terms, "term", ["o_orderkey"])
    return found.select("o_orderkey", "o_orderstatus")


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with values blanked by rules on other columns."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("kind"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("amount"),
        F.when(F.col("value") < 60, F.col("user_id")).alias("user"),
    )


_GAPPY_SQL = """g AS (SELECT CAST(event_id AS VARCHAR) AS id, nullif(event_type, 'error') AS kind,
  CASE WHEN event_type <> 'view' THEN value END AS amount,
  CASE WHEN value < 60 THEN user_id END AS "user" FROM events)"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.round("amount", 6)).withColumn(
        "user", F.round(F.col("user").cast("double"), 6))


def _filled_sql(amount: str, user: str, kind: str = "''") -> str:
    return f"""WITH {_GAPPY_SQL} SELECT id, coalesce(kind, {kind}) AS kind,
  round(coalesce(amount, {amount}), 6) AS amount,
  round(CAST(coalesce("user", {user}) AS DOUBLE), 6) AS "user" FROM g"""


def _mode_sql(column: str) -> str:
    return (f"(SELECT {column} FROM g WHERE {column} IS NOT NULL GROUP BY {column} "
            f"ORDER BY count(*) DESC, {column} LIMIT 1)")


@query("impute_default", _filled_sql("0", "0"))
def impute_default(spark, sf_dir):
    return _rounded(fill_missing(_gappy(spark, sf_dir), "default"))


@query("impute_mean", _filled_sql("(SELECT avg(amount) FROM g)", '(SELECT avg("user") FROM g)'))
def impute_mean(spark, sf_dir):
    return _rounded(fill_missing(_gappy(spark, sf_dir), "mean"))


@query("impute_median", _filled_sql("(SELECT median(amount) FROM g)", '(SELECT median("user") FROM g)'))
def impute_median(spark, sf_dir):
    return _rounded(fill_missing(_gappy(spark, sf_dir), "median"))


@query("median_approx_ranks", """SELECT name, n, true AS near FROM (
  SELECT 'l_extendedprice' AS name, count(l_extendedprice) AS n FROM lineitem
  UNION ALL SELECT 'l_quantity', count(l_quantity) FROM lineitem)""")
def median_approx_ranks(spark, sf_dir):
    """The rank of each approximate median, counted exactly, is as near to the middle as promised."""
    lines, names, accuracy = read(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"], 1000
    medians = approximate_medians(lines, names, accuracy).first()
    # Equal values share ranks from the first to the last of them; the middle must be within reach of one.
    ranks = lines.agg(*[x for c in names for x in (
        F.count_if(F.col(c) < medians[c]).alias(f"{c}_below"), F.count_if(F.col(c) <= medians[c]).alias(f"{c}_upto"),
        F.count(c).alias(f"{c}_n"))])
    return ranks.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("name"), F.col(f"{c}_n").alias("n"),
        ((F.col(f"{c}_below") <= F.col(f"{c}_n") * (0.5 + 1 / accuracy) + 1)
         & (F.col(f"{c}_upto") >= F.col(f"{c}_n") * (0.5 - 1 / accuracy) - 1)).alias("near")) for c in names])))


@query("impute_mode", _filled_sql(_mode_sql("amount"), _mode_sql('"user"'), _mode_sql("kind")))
def impute_mode(spark, sf_dir):
    return _rounded(fill_missing(_gappy(spark, sf_dir), "mode"))


_WIDE = 100


def _wide_sql(i: int) -> str:
    return f"CASE WHEN (event_id + {i}) % 7 > 0 THEN (event_id * {i + 1} + user_id) % {3 + i % 11} END"


@query("impute_mode_wide", "WITH w AS (SELECT event_id, " + ", ".join(f"{_wide_sql(i)} AS c{i}" for i in range(_WIDE)) + """ FROM events)
SELECT event_id, """ + ", ".join(
    f"coalesce(c{i}, (SELECT c{i} FROM w WHERE c{i} IS NOT NULL GROUP BY c{i} ORDER BY count(*) DESC, c{i} LIMIT 1)) AS c{i}"
    for i in range(_WIDE)) + " FROM w")
def impute_mode_wide(spark, sf_dir):
    """More columns with gaps than an id of grouping sets has bits."""
    wide = read(spark, sf_dir, "events").select("event_id", *[
        F.expr(f"{_wide_sql(i)} AS c{i}") for i in range(_WIDE)])
    return fill_missing(wide, "mode")


@query("format_dates", """
SELECT event_id AS row_key, 'e' AS origin, CASE WHEN ts = date_trunc('day', ts) THEN strftime(ts, '%Y-%m-%d')
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "就诊日期", event_type AS other FROM events
UNION ALL
SELECT o_orderkey, 'o', CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END,
  o_orderpriority FROM orders""")
def format_dates(spark, sf_dir):
    """Times, and day text in several layouts; text that is no date becomes blank."""
    events = read(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_key"), F.lit("e").alias("origin"),
        F.col("ts").alias("就诊日期"), F.col("event_type").alias("other"))
    day = F.col("o_orderdate").cast("date").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "P", "P001")
        .when(F.col("o_orderpriority") == "1-URGENT", F.replace(day, F.lit("-"), F.lit("/")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.replace(day, F.lit("-"), F.lit(".")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.replace(day, F.lit("-"), F.lit("")))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(day, F.lit(" 00:00:00")))
        .otherwise(day)
    )
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_key"), F.lit("o").alias("origin"),
        text.alias("就诊日期"), F.col("o_orderpriority").alias("other"))
    return render_date_columns(events).unionByName(render_date_columns(orders))


@query("parse_dates", """SELECT o_orderstatus AS status, CAST(o_orderdate AS DATE)::VARCHAR AS day,
  count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2
UNION ALL SELECT 'P', NULL, count(*) FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0""")
def parse_dates(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", "no date").otherwise(
        F.date_format("o_orderdate", "yyyy/M/d"))
    return read(spark, sf_dir, "orders").groupBy(
        F.col("o_orderstatus").alias("status"),
        parse_text_timestamp(text).cast("date").cast("string").alias("day"),
    ).agg(F.count("*").alias("n"))
