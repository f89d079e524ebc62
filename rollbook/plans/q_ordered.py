"""Order-dependent operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollbook.operators import ordered
from rollbook.plans import views as V
from rollbook.plans.registry import query

_TS = "%Y-%m-%d %H:%M:%S.%f"


def _stamp():
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")


@query(
    "win_latest_snapshot",
    V.ctes(V.V_SNAPSHOT)
    + f"""SELECT key, event_id, content, strftime(ts, '{_TS}') AS ts FROM v_snapshot
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) = 1""",
)
def win_latest_snapshot(spark, d):
    last = ordered.latest_snapshot(V.v_snapshot(spark, d), ["key"], ["ts", "event_id"])
    return last.select("key", "event_id", "content", _stamp())


CHANGES_SQL = """kept AS (SELECT * FROM (SELECT *, lag(content) OVER w AS p, row_number() OVER w AS n FROM v_snapshot
  WINDOW w AS (PARTITION BY key ORDER BY ts, event_id)) WHERE n = 1 OR p IS DISTINCT FROM content),
stored AS (SELECT key, event_id, content, ts FROM kept
  QUALIFY row_number() OVER (PARTITION BY key, date_trunc('minute', ts) ORDER BY ts DESC, event_id DESC) = 1)"""


@query(
    "win_change_detect",
    V.ctes(V.V_SNAPSHOT, CHANGES_SQL)
    + f"SELECT key, event_id, content, strftime(ts, '{_TS}') AS ts FROM stored",
)
def win_change_detect(spark, d):
    kept = ordered.change_detect(V.v_snapshot(spark, d), ["key"], "ts", "event_id", "content")
    stored = ordered.one_per_minute(kept, ["key"], "ts", "event_id")
    return stored.select("key", "event_id", "content", _stamp())


@query(
    "win_first_relevant",
    V.ctes(V.V_RESULT)
    + """SELECT query, rank, label FROM (SELECT *, coalesce(max((label = 2)::INT) OVER (PARTITION BY query ORDER BY rank
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM v_result) WHERE done = 0 AND label > 0""",
)
def win_first_relevant(spark, d):
    df = V.v_result(spark, d).select("query", "rank", "label")
    return ordered.first_relevant(df, ["query"], "rank", "label")


@query(
    "win_candidates_until_found",
    V.ctes(V.V_RESULT)
    + """SELECT query, rank, title, CASE WHEN label = 0 THEN 'found' ELSE 'unsure' END AS kind
    FROM (SELECT *, coalesce(max((label = 0)::INT) OVER (PARTITION BY query ORDER BY rank
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM v_result)
    WHERE done = 0 AND (label = 0 OR title = 'user')""",
)
def win_candidates_until_found(spark, d):
    df = V.v_result(spark, d).select("query", "rank", "title", "label")
    out = ordered.candidates_until_found(
        df, ["query"], "rank", F.col("label") == 0, F.col("title") == "user"
    )
    return out.select("query", "rank", "title", "kind")


@query(
    "win_first_match",
    """SELECT p_name, arg_min(p_partkey, (p_retailprice, p_partkey)) AS p_partkey, min(p_retailprice) AS p_retailprice,
      count(*) AS matches FROM part GROUP BY 1""",
)
def win_first_match(spark, d):
    p = V.table(spark, d, "part").select("p_name", "p_partkey", "p_retailprice")
    out = ordered.first_match(p, ["p_name"], ["p_retailprice", "p_partkey"])
    return out.select("p_name", "p_partkey", "p_retailprice", "matches")


@query(
    "win_carry_skip",
    """WITH e AS (SELECT event_type AS name, event_id, CASE WHEN value > 60 THEN 'na' WHEN value > 30 THEN 'n' ELSE 'y' END AS ans
      FROM events),
    l AS (SELECT *, last_value(CASE WHEN ans = 'na' THEN name END IGNORE NULLS) OVER (ORDER BY event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS said FROM e)
    SELECT event_id, name, coalesce(said = name, false) AS auto_false FROM l""",
)
def win_carry_skip(spark, d):
    """One review file: the event stream by event id, the reviewed name being the type."""
    value = F.col("value")
    ans = F.when(value > 60, "na").when(value > 30, "n").otherwise("y")
    df = V.table(spark, d, "events").select(
        F.lit("file").alias("batch"), "event_id", F.col("event_type").alias("name"), ans.alias("ans")
    )
    out = ordered.carry_skip(df, ["batch"], "event_id", "name", "ans", piece_rows=1000)
    return out.select("event_id", "name", "auto_false")


@query(
    "win_head_split",
    V.ctes(V.V_PRED)
    + """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= round_even(0.7 * count(*) OVER (), 0)
      THEN 'train' ELSE 'test' END AS split FROM v_pred""",
)
def win_head_split(spark, d):
    return ordered.head_split(V.v_pred(spark, d).select("doc_id"), "doc_id")


@query(
    "win_stratified_split",
    V.ctes(V.V_PRED)
    + """SELECT doc_id, y_true, CASE WHEN row_number() OVER (PARTITION BY y_true ORDER BY doc_id * 7919 % 10007, doc_id)
      <= round_even(0.8 * count(*) OVER (PARTITION BY y_true), 0) THEN 'train' ELSE 'test' END AS split FROM v_pred""",
)
def win_stratified_split(spark, d):
    df = V.v_pred(spark, d).select("doc_id", "y_true")
    return ordered.stratified_split(df, "y_true", "doc_id", shuffle=F.expr("doc_id * 7919 % 10007"))
