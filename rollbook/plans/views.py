"""The test tables in the shape of a directory, in Spark and as SQL.

Each view exists twice: a function for Spark and a common table expression for the check.
"""

from __future__ import annotations

import operator
from functools import reduce

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.datetime(2024, 1, 31)
CHECK_DAYS = 3
# Departments the second crawl no longer shows.
GONE = ("Brand#5", "Brand#10", "Brand#15", "Brand#20", "Brand#25")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(c) -> F.Column:
    return c.cast("string")


def v_class(spark: SparkSession, d: str, spread: bool = False) -> DataFrame:
    """One row per line item, as a class of a term.

    `spread` deals the line items out before the joins, while they are few bytes.
    """
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    if spread:
        numbers = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
        li = li.select(*numbers, "l_returnflag", "l_linestatus", "l_shipdate").hint("rebalance", "l_orderkey")
    p, s = table(spark, d, "part"), table(spark, d, "supplier")
    joined = (
        li.join(o, li["l_orderkey"] == o["o_orderkey"])
        .join(p, li["l_partkey"] == p["p_partkey"])
        .join(s, li["l_suppkey"] == s["s_suppkey"])
    )
    month = F.month("o_orderdate")
    season = F.when(month <= 5, "Spring").when(month <= 8, "Summer").otherwise("Fall")
    qty = F.col("l_quantity").cast("int").cast("string")
    year = F.year("o_orderdate").cast("string")
    line = F.col("l_linenumber")
    size = F.col("p_size")
    hour = (F.col("l_quantity").cast("int") % 9 + 1).cast("string")
    days = F.when(line <= 2, "MW").when(line <= 4, "TR").when(line <= 6, "F").otherwise("S")
    return joined.select(
        F.concat(year, F.lit("-"), season).alias("term"),
        F.col("p_brand").alias("department_code"),
        F.col("p_type").alias("department"),
        F.concat("p_brand", F.lit(" "), F.col("p_partkey").cast("string")).alias("course_code"),
        F.col("p_name").alias("course_title"),
        (F.col("l_orderkey") * 10 + line).cast("string").alias("call_number"),
        F.when(F.col("l_suppkey") % 10 != 0, F.col("s_name")).alias("instructor"),
        F.concat(
            qty,
            F.lit(" students"),
            F.when(line == 7, "").otherwise(" (50 max)"),
            F.lit(" as of 12:04PM Thursday, "),
            F.date_format("l_shipdate", "MMMM d, yyyy"),
        ).alias("enrollment_text"),
        F.concat(
            F.lit("W"),
            F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"),
            F.lit("-"),
            year,
            F.lit("3-"),
            F.lpad(line.cast("string"), 3, "0"),
        ).alias("class_id"),
        F.when(
            line == 7, days
        ).otherwise(
            F.concat(
                days, F.lit(" "), hour, F.lit(":10am-"), hour, F.lit(":55am\nRoom "), size.cast("string")
            )
        ).alias("schedule_text"),
        F.when(size % 5 == 0, F.concat(F.lit("1-"), (size % 4 + 2).cast("string")))
        .otherwise((size % 5).cast("string"))
        .alias("points"),
        F.when(F.col("l_returnflag") == "A", "LECTURE")
        .when(F.col("l_returnflag") == "N", "SEMINAR")
        .otherwise("DISCUSSION")
        .alias("type"),
        F.when(F.col("l_linestatus") == "F", "Morningside").otherwise("Elsewhere").alias("campus"),
        F.col("l_shipdate").cast("date").alias("seen_on"),
        F.col("l_quantity").cast("int").alias("seats"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_partkey").alias("part"),
        F.col("l_orderkey").alias("order_key"),
    )


V_CLASS = """v_class AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) || '-' || CASE WHEN month(o_orderdate) <= 5 THEN 'Spring'
           WHEN month(o_orderdate) <= 8 THEN 'Summer' ELSE 'Fall' END AS term,
         p_brand AS department_code, p_type AS department,
         p_brand || ' ' || CAST(p_partkey AS VARCHAR) AS course_code, p_name AS course_title,
         CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS call_number,
         CASE WHEN l_suppkey % 10 <> 0 THEN s_name END AS instructor,
         CAST(CAST(l_quantity AS INT) AS VARCHAR) || ' students'
           || CASE WHEN l_linenumber = 7 THEN '' ELSE ' (50 max)' END
           || ' as of 12:04PM Thursday, ' || strftime(l_shipdate, '%B %-d, %Y') AS enrollment_text,
         'W' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') || '-' || CAST(year(o_orderdate) AS VARCHAR)
           || '3-' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS class_id,
         CASE WHEN l_linenumber <= 2 THEN 'MW' WHEN l_linenumber <= 4 THEN 'TR' WHEN l_linenumber <= 6 THEN 'F'
           ELSE 'S' END AS days,
         CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_quantity AS INT) % 9 + 1 AS VARCHAR) || ':10am' END AS t_start,
         CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_quantity AS INT) % 9 + 1 AS VARCHAR) || ':55am' END AS t_end,
         CASE WHEN l_linenumber <> 7 THEN 'Room ' || CAST(p_size AS VARCHAR) END AS room,
         CASE WHEN p_size % 5 = 0 THEN '1-' || CAST(p_size % 4 + 2 AS VARCHAR)
           ELSE CAST(p_size % 5 AS VARCHAR) END AS points,
         CASE l_returnflag WHEN 'A' THEN 'LECTURE' WHEN 'N' THEN 'SEMINAR' ELSE 'DISCUSSION' END AS type,
         CASE WHEN l_linestatus = 'F' THEN 'Morningside' ELSE 'Elsewhere' END AS campus,
         CAST(l_shipdate AS DATE) AS seen_on, CAST(l_quantity AS INT) AS seats, l_linenumber AS line,
         l_suppkey AS supplier, l_partkey AS part, l_orderkey AS order_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey)"""


def v_new(spark: SparkSession, d: str, spread: bool = False) -> DataFrame:
    """The second crawl: some departments are gone."""
    return v_class(spark, d, spread).filter(~F.col("department_code").isin(*GONE))


V_NEW = f"""v_new AS (SELECT * FROM v_class WHERE department_code NOT IN {GONE})"""


def v_enrollment_old(spark: SparkSession, d: str) -> DataFrame:
    """Stored history per (term, call_number): ship date -> 'seats/50'."""
    seen = v_class(spark, d).select(
        "term",
        "call_number",
        F.col("seen_on").cast("string").alias("date"),
        F.concat(F.col("seats").cast("string"), F.lit("/50")).alias("seen"),
    )
    per_date = seen.groupBy("term", "call_number", "date").agg(F.max("seen").alias("seen"))
    return per_date.groupBy("term", "call_number").agg(
        F.map_from_entries(F.collect_list(F.struct("date", "seen"))).alias("enrollment")
    )


V_ENROLLMENT_OLD = """v_enrollment_old AS (
  SELECT term, call_number, CAST(seen_on AS VARCHAR) AS date, max(CAST(seats AS VARCHAR) || '/50') AS seen
  FROM v_class GROUP BY ALL)"""


def v_enrollment_new(spark: SparkSession, d: str) -> DataFrame:
    """New crawl: even lines show another value on a known date, odd lines a later date."""
    even = F.col("line") % 2 == 0
    date = F.when(even, F.col("seen_on")).otherwise(F.date_add("seen_on", 7)).cast("string")
    seats = F.when(even, F.col("seats") + 1).otherwise(F.col("seats")).cast("string")
    return v_class(spark, d).select(
        "term",
        "call_number",
        "course_code",
        F.create_map(date, F.concat(seats, F.lit("/50"))).alias("enrollment"),
    )


V_ENROLLMENT_NEW = """v_enrollment_new AS (
  SELECT term, call_number, course_code,
         CAST(CASE WHEN line % 2 = 0 THEN seen_on ELSE seen_on + 7 END AS VARCHAR) AS date,
         CAST(CASE WHEN line % 2 = 0 THEN seats + 1 ELSE seats END AS VARCHAR) || '/50' AS seen
  FROM v_class)"""


def v_instructor(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as people with the departments they taught in and, for some, a link."""
    taught = v_class(spark, d).select("supplier", "department").distinct()
    deps = taught.groupBy("supplier").agg(F.array_sort(F.collect_set("department")).alias("departments"))
    s = table(spark, d, "supplier")
    link = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("/people/"), F.col("s_suppkey").cast("string")))
    return s.join(deps, s["s_suppkey"] == deps["supplier"]).select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), "departments", link.alias("link")
    )


V_INSTRUCTOR = """v_instructor AS (
  SELECT s_suppkey AS id, s_name AS name, list_sort(list(DISTINCT department)) AS departments,
         CASE WHEN s_suppkey % 2 = 0 THEN '/people/' || CAST(s_suppkey AS VARCHAR) END AS link
  FROM supplier JOIN v_class ON supplier = s_suppkey GROUP BY ALL)"""


def v_last_check(spark: SparkSession, d: str) -> DataFrame:
    """Last check per user: the latest costly error event; other users were never checked."""
    e = table(spark, d, "events").filter((F.col("event_type") == "error") & (F.col("value") > 60))
    return e.groupBy(F.col("user_id").cast("string").alias("name")).agg(F.max("ts").alias("last_check"))


V_LAST_CHECK = """v_last_check AS (
  SELECT CAST(user_id AS VARCHAR) AS name, max(ts) AS last_check FROM events
  WHERE event_type = 'error' AND value > 60 GROUP BY 1)"""


def v_user(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("name")).distinct()


V_USER = """v_user AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS name FROM events)"""


def v_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("user_id").alias("key"), "ts", "event_id", F.col("event_type").alias("content")
    )


V_SNAPSHOT = """v_snapshot AS (SELECT user_id AS key, ts, event_id, event_type AS content FROM events)"""


def v_result(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select(
        F.col("conv_id").alias("query"),
        F.col("turn").alias("rank"),
        F.col("role").alias("title"),
        F.col("text").alias("snippet"),
        (F.length("text") % 3).alias("label"),
    )


V_RESULT = """v_result AS (
  SELECT conv_id AS query, turn AS rank, role AS title, text AS snippet, length(text) % 3 AS label
  FROM conversations)"""


def v_pred(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select(
        "doc_id", F.col("quality").alias("y_true"), F.col("toxic").alias("y_pred")
    )


V_PRED = """v_pred AS (SELECT doc_id, quality AS y_true, toxic AS y_pred FROM labels)"""


def v_name(spark: SparkSession, d: str) -> DataFrame:
    """Distinct part names with their 'Last, First' form, and supplier names."""
    p = table(spark, d, "part").select(F.col("p_name").alias("name")).distinct()
    parts = F.split("name", " ")
    swapped = F.concat(F.get(parts, F.lit(1)), F.lit(", "), F.get(parts, F.lit(0)))
    s = table(spark, d, "supplier").select(F.col("s_name").alias("name")).distinct()
    return p.select("name", swapped.alias("foreign")).unionByName(
        s.select("name", F.col("name").alias("foreign"))
    )


V_NAME = """v_name AS (
  SELECT DISTINCT p_name AS name, split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1) AS foreign_name
  FROM part UNION ALL SELECT DISTINCT s_name, s_name FROM supplier)"""


_WIDTH = 64  # values of an embedding; every third one belongs to the same class


def v_score(spark: SparkSession, d: str) -> DataFrame:
    """Three logits, each the sum of a third of all embedding values, in order."""
    e = table(spark, d, "embeddings")
    logits = []
    for k in range(3):
        terms = [F.get("embedding", F.lit(i)).cast("double") for i in range(k, _WIDTH, 3)]
        logits.append(reduce(operator.add, terms))
    return e.select("vec_id", F.array(*logits).alias("logits"), (F.col("label") % 3).alias("y"))


_LOGITS = ", ".join(
    " + ".join(f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(k, _WIDTH, 3)) + f" AS {name}"
    for k, name in enumerate("abc")
)
V_SCORE = f"""v_logit AS (SELECT vec_id, {_LOGITS}, label % 3 AS y FROM embeddings),
v_score AS (
  SELECT vec_id, y, a, b, c, exp(a) / (exp(a) + exp(b) + exp(c)) AS pa,
         exp(b) / (exp(a) + exp(b) + exp(c)) AS pb, exp(c) / (exp(a) + exp(b) + exp(c)) AS pc FROM v_logit)"""


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
