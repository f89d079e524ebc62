"""Sources and sinks: a view is written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook import schemas
from rollbook.functions import terms
from rollbook.operators import columns, merge
from rollbook.plans import views as V
from rollbook.plans.registry import query
from rollbook.sources import readers, writers
from rollbook.sources.scratch import scratch_dir

PART = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("p_partkey", "p_name", "p_brand", "p_type")]
)
PART_SQL = "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type FROM part"
ARRAY_ROWS = 1000


@query("src_json_records", PART_SQL)
def src_json_records(spark, d):
    """JSON array files, each with a bounded number of records."""
    p = V.table(spark, d, "part").select(F.col("p_partkey").cast("string"), "p_name", "p_brand", "p_type")
    chunk = F.floor(F.col("p_partkey").cast("bigint") / ARRAY_ROWS)
    arrays = p.groupBy(chunk.alias("chunk")).agg(
        F.to_json(F.collect_list(F.struct(*p.columns))).alias("value")
    )
    path = scratch_dir(spark, "arrays")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.json_records(spark, path, PART)


def _results(spark, d):
    """Search results, nested: one row per query with its whole list, as stored records are."""
    item = F.struct("title", "snippet", F.col("label").cast("int").alias("label"))
    return (
        V.v_result(spark, d)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct("rank", item.alias("item")))).alias("r"))
        .select(
            F.concat(F.lit("person "), F.col("query").cast("string")).alias("name"),
            F.lit("dep").alias("department"),
            F.lit("").alias("course_descr"),
            F.transform("r", lambda x: x["item"]).alias("search_results"),
        )
    )


_RESULT_ROWS = """SELECT 'person ' || query AS name, rank, title, length(snippet) AS n, label FROM v_result"""


@query("src_jsonl", V.ctes(V.V_RESULT) + _RESULT_ROWS)
def src_jsonl(spark, d):
    path = scratch_dir(spark, "results")
    writers.jsonl_append(_results(spark, d), path)
    back = readers.json_lines(spark, path, schemas.SEARCH_RESULTS)
    return back.select("name", F.posexplode("search_results").alias("rank", "s")).select(
        "name", "rank", "s.title", F.length("s.snippet").alias("n"), "s.label"
    )


_CSV_SQL = """SELECT call_number, CASE WHEN line = 7 THEN days ELSE
  days || ' ' || t_start || '-' || t_end || chr(10) || room END AS schedule_text, 'a "b", c' AS note FROM v_class"""


@query("src_csv", V.ctes(V.V_CLASS) + _CSV_SQL)
def src_csv(spark, d):
    """Cells hold line breaks, commas and quotes."""
    df = V.v_class(spark, d).select("call_number", "schedule_text", F.lit('a "b", c').alias("note"))
    path = scratch_dir(spark, "csv")
    writers.csv_flat(df, path)
    return readers.csv_table(spark, path, df.schema)


@query("src_term_files", V.ctes(V.V_CLASS) + "SELECT term, call_number, course_code, points FROM v_class")
def src_term_files(spark, d):
    """Stored terms, one `<term>.json` array each; the term comes from the name of the file."""
    df = V.v_class(spark, d).select("term", "call_number", "course_code", "points")
    path = scratch_dir(spark, "terms")
    writers.term_files(df, path, order=["course_code", "call_number"])
    schema = T.StructType([f for f in df.schema.fields if f.name != "term"])
    return readers.term_files(spark, path, schema, array_files=True)


_PAGE_TREE_SQL = """SELECT 'T' || page_id % 5 AS term, split_part(url, '/', 4) AS department_code,
      page_id::VARCHAR AS class_id, TIMESTAMP '2020-07-10 00:00:00' + to_minutes(page_id) AS ts, html FROM pages"""


def _page_tree(spark, d):
    """A tree of stored pages; a second crawl an hour later finds only the long pages changed."""
    path = scratch_dir(spark, "html")
    first = V.table(spark, d, "pages").select(
        F.concat(F.lit("T"), (F.col("page_id") % 5).cast("string")).alias("term"),
        F.get(F.split("url", "/"), F.lit(3)).alias("department_code"),
        F.col("page_id").cast("string").alias("class_id"),
        F.timestamp_seconds(F.unix_timestamp(F.lit("2020-07-10 00:00:00")) + 60 * F.col("page_id")).alias("ts"),
        F.col("html").alias("raw_content"),
    )
    writers.page_tree(first, path)
    changed = F.concat("raw_content", F.when(F.length("raw_content") > 5000, "new").otherwise(""))
    later = F.col("ts") + F.expr("INTERVAL 1 HOUR")
    writers.page_tree(first.withColumns({"raw_content": changed, "ts": later}), path)
    return path


@query(
    "src_html_pages",
    f"""WITH t AS ({_PAGE_TREE_SQL}),
    s AS (SELECT * FROM t UNION ALL
      SELECT term, department_code, class_id, ts + INTERVAL 1 HOUR, html || 'new' FROM t WHERE length(html) > 5000)
    SELECT term, department_code, class_id, strftime(ts, '%Y-%m-%d %H:%M') AS stored, length(html) AS n, md5(html) AS digest
    FROM s""",
)
def src_html_pages(spark, d):
    """Pages of two crawls as they lie on disk, with what their paths say."""
    pages = readers.raw_pages(spark, _page_tree(spark, d))
    return pages.select(
        "term", "department_code", "class_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("stored"),
        F.length("raw_content").alias("n"), F.md5("raw_content").alias("digest"),
    )


@query(
    "src_api_json",
    V.ctes(V.V_RESULT)
    + """SELECT query, rank, title, md5(snippet) AS digest, 'page ' || query AS page_title, md5(snippet) AS extract
    FROM v_result""",
)
def src_api_json(spark, d):
    """Search and article answers, rendered as API payloads and parsed back."""
    r = V.v_result(spark, d)
    hit = F.struct("title", "snippet")
    search = F.to_json(F.struct(F.struct(F.array(hit).alias("search")).alias("query")))
    page = F.struct(
        F.concat(F.lit("page "), F.col("query").cast("string")).alias("title"),
        F.col("snippet").alias("extract"),
    )
    pages = F.create_map(F.col("query").cast("string"), page)
    article = F.to_json(F.struct(F.struct(pages.alias("pages")).alias("query")))
    raw = r.select("query", "rank", search.alias("search"), article.alias("article"))
    parsed = raw.select(
        "query",
        "rank",
        F.inline(readers.search_payload(F.col("search"))),
        readers.article_payload(F.col("article")).alias("a"),
    )
    return parsed.select(
        "query", "rank", "title", F.md5("snippet").alias("digest"),
        F.col("a.title").alias("page_title"), F.md5("a.extract").alias("extract"),
    )


_HISTORY_SQL = """SELECT term, call_number, course_code, CAST(seen_on AS VARCHAR) || '=' || seats || '/é' AS history FROM v_class"""


@query("sink_json_records", V.ctes(V.V_CLASS) + _HISTORY_SQL)
def sink_json_records(spark, d):
    """Enrollment histories per term; slashes and accents stay unescaped."""
    history = F.create_map(
        F.col("seen_on").cast("string"), F.concat(F.col("seats").cast("string"), F.lit("/é"))
    )
    df = V.v_class(spark, d).select("term", "call_number", "course_code", history.alias("enrollment"))
    path = scratch_dir(spark, "enrollment")
    writers.json_by_term(df, path)
    back = readers.term_partitions(spark, path, schemas.ENROLLMENT)
    return back.select("term", "call_number", "course_code", terms.map_text(F.col("enrollment")).alias("history"))


@query(
    "sink_csv_flat",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, array_to_string(list_sort([p_name, p_brand]), chr(10)) AS open_to,
      array_to_string(list_sort(list_concat(string_split(p_name, ' '), [p_type])), chr(10)) AS prerequisites,
      array_to_string(list_sort([p_brand, p_type]), ' ') AS classes FROM part""",
)
def sink_csv_flat(spark, d):
    p = V.table(spark, d, "part")
    df = p.select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        F.array("p_name", "p_brand").alias("open_to"),
        F.array(F.split("p_name", " "), F.array("p_type")).alias("prerequisites"),
        F.array(F.struct(F.col("p_type").alias("term"), F.col("p_brand").alias("course_code"))).alias("classes"),
        F.array(F.struct("p_size")).alias("reviews"),
    )
    path = scratch_dir(spark, "flat")
    writers.csv_flat(df, path)
    names = ("p_partkey", "open_to", "prerequisites", "classes")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return readers.csv_table(spark, path, schema)


@query(
    "sink_jsonl_append",
    V.ctes(V.V_RESULT) + f"{_RESULT_ROWS} WHERE title = 'user' UNION ALL {_RESULT_ROWS} WHERE title <> 'user'",
)
def sink_jsonl_append(spark, d):
    """Two runs append to one log."""
    r = V.v_result(spark, d).select(
        F.concat(F.lit("person "), F.col("query").cast("string")).alias("name"),
        "rank", "title", F.length("snippet").alias("n"), "label",
    )
    path = scratch_dir(spark, "log")
    for part in (F.col("title") == "user", F.col("title") != "user"):
        writers.jsonl_append(r.filter(part), path)
    return readers.json_lines(spark, path, r.schema)


@query(
    "sink_raw_snapshots",
    """WITH s AS (SELECT page_id, split_part(url, '/', 4) AS department_code, 1 AS crawl, md5(html) AS digest FROM pages
      UNION ALL SELECT page_id, split_part(url, '/', 4), 2, md5(html || 'new') FROM pages WHERE length(html) > 5000)
    SELECT page_id, department_code, crawl, digest FROM s""",
)
def sink_raw_snapshots(spark, d):
    """Two crawls; in the second only the long pages have changed."""
    pages = V.table(spark, d, "pages").select(
        "page_id", F.get(F.split("url", "/"), F.lit(3)).alias("department_code"), F.col("html").alias("raw_content")
    )
    path = scratch_dir(spark, "raw")
    keys = ["department_code", "page_id"]
    writers.raw_snapshots(pages.withColumn("crawl", F.lit(1)), None, path, keys)
    stored = spark.read.parquet(path).select(*keys, "digest")
    changed = F.when(F.length("raw_content") > 5000, F.concat("raw_content", F.lit("new"))).otherwise(
        F.col("raw_content")
    )
    second = pages.withColumn("raw_content", changed).withColumn("crawl", F.lit(2))
    writers.raw_snapshots(second, stored, path, keys)
    return spark.read.parquet(path).select(
        "page_id", "department_code", "crawl", F.md5("raw_content").alias("digest")
    )


@query(
    "sink_class_file",
    V.ctes(V.V_CLASS)
    + """SELECT term, course_code, course_title, call_number, instructor, points, type FROM v_class""",
)
def sink_class_file(spark, d):
    """A stored class table: merged, ordered columns, sorted inside each file."""
    cols = ("term", "department_code", "course_code", "course_title", "call_number", "instructor", "points", "type")
    merged = merge.merge_term(V.v_class(spark, d).select(*cols))
    df = columns.reorder(merged.classes, ["course_code", "course_title", "instructor"])
    path = scratch_dir(spark, "classes")
    spread = df.hint("rebalance", "term").sortWithinPartitions("term", *columns.CLASS_ORDER)
    writers.json_by_term(spread, path, rebalance=False)
    schema = T.StructType([f for f in df.schema.fields if f.name != "term"])
    return readers.term_partitions(spark, path, schema).select(
        "term", "course_code", "course_title", "call_number", "instructor", "points", "type"
    )


