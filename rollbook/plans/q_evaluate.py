"""Evaluation and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollbook.functions import text, vectors
from rollbook.operators import evaluate, ordered, quality
from rollbook.plans import views as V
from rollbook.plans.registry import query

_CELLS = """cells AS (SELECT y_true AS y, y_pred AS p, count(*) AS n FROM v_pred GROUP BY ALL),
per AS (SELECT label, sum(CASE WHEN y = label AND p = label THEN n ELSE 0 END) AS tp,
    sum(CASE WHEN p = label THEN n ELSE 0 END) AS predicted, sum(CASE WHEN y = label THEN n ELSE 0 END) AS support
  FROM cells, (SELECT DISTINCT y_true AS label FROM v_pred UNION SELECT DISTINCT y_pred FROM v_pred) GROUP BY label),
scored AS (SELECT label, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
    CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f1, support, tp FROM per)"""


@query(
    "agg_label_counts",
    V.ctes(V.V_PRED)
    + """, s AS (SELECT y_true, CASE WHEN row_number() OVER (ORDER BY doc_id) <= round_even(0.7 * count(*) OVER (), 0)
      THEN 'train' ELSE 'test' END AS split FROM v_pred)
    SELECT split AS part, y_true, count(*) AS n FROM s GROUP BY ALL
    UNION ALL SELECT 'all', y_true, count(*) FROM s GROUP BY ALL""",
)
def agg_label_counts(spark, d):
    split = ordered.head_split(V.v_pred(spark, d), "doc_id")
    return evaluate.label_counts(split, "y_true", "split")


@query(
    "agg_confusion_matrix",
    V.ctes(V.V_PRED)
    + """SELECT l.y, count(CASE WHEN y_pred = 0 THEN 1 END) AS pred_0, count(CASE WHEN y_pred = 1 THEN 1 END) AS pred_1,
      count(CASE WHEN y_pred = 2 THEN 1 END) AS pred_2
    FROM (VALUES (0), (1), (2)) l(y) LEFT JOIN v_pred ON y_true = l.y GROUP BY 1""",
)
def agg_confusion_matrix(spark, d):
    return evaluate.confusion_matrix(V.v_pred(spark, d), "y_true", "y_pred", [0, 1, 2])


@query(
    "agg_class_report",
    V.ctes(V.V_PRED, _CELLS)
    + """SELECT CAST(label AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
      CAST(support AS BIGINT) AS support FROM scored
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM scored
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scored""",
)
def agg_class_report(spark, d):
    report = evaluate.class_report(V.v_pred(spark, d), "y_true", "y_pred")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "agg_accuracy_f1",
    V.ctes(V.V_PRED, _CELLS)
    + "SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(f1 * support) / sum(support), 6) AS f1 FROM scored",
)
def agg_accuracy_f1(spark, d):
    both = evaluate.accuracy_f1(V.v_pred(spark, d), "y_true", "y_pred")
    return both.withColumns({c: F.round(c, 6) for c in ("accuracy", "f1")})


_CURVE = """t AS (SELECT pb AS threshold, sum((y = 1)::INT) AS pos, sum((y <> 1)::INT) AS neg FROM v_score GROUP BY 1),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM t
  WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))"""


def _scores(spark, d):
    p = vectors.softmax(F.col("logits"))
    return V.v_score(spark, d).select("vec_id", "y", F.get(p, F.lit(1)).alias("score"))


@query(
    "agg_roc",
    V.ctes(V.V_SCORE, _CURVE)
    + """SELECT round(threshold, 6) AS threshold, round(fp / nn, 6) AS fpr, round(tp / np, 6) AS tpr,
      round(abs(fp / nn + tp / np - 1), 6) AS gap FROM c""",
)
def agg_roc(spark, d):
    roc = evaluate.roc_curve(_scores(spark, d), "score", F.col("y") == 1)
    return roc.select(*[F.round(c, 6).alias(c) for c in roc.columns])


@query(
    "agg_roc_auc",
    V.ctes(V.V_SCORE)
    + """, p AS (SELECT pb FROM v_score WHERE y = 1), n AS (SELECT pb FROM v_score WHERE y <> 1)
    SELECT round(avg(CASE WHEN p.pb > n.pb THEN 1.0 WHEN p.pb = n.pb THEN 0.5 ELSE 0 END), 6) AS auc FROM p, n""",
)
def agg_roc_auc(spark, d):
    return evaluate.roc_auc(_scores(spark, d), "score", F.col("y") == 1).select(
        F.round("auc", 6).alias("auc")
    )


@query(
    "agg_pr_curve",
    V.ctes(V.V_SCORE, _CURVE)
    + """SELECT round(threshold, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / np, 6) AS recall FROM c""",
)
def agg_pr_curve(spark, d):
    pr = evaluate.pr_curve(_scores(spark, d), "score", F.col("y") == 1)
    return pr.select(*[F.round(c, 6).alias(c) for c in pr.columns])


@query(
    "agg_misclassified",
    V.ctes(V.V_PRED)
    + """SELECT 'missed_relevant' AS kind, doc_id FROM v_pred WHERE y_true = 1 AND y_pred <> y_true
    UNION ALL SELECT 'false_relevant', doc_id FROM v_pred WHERE y_true = 0 AND y_pred <> y_true""",
)
def agg_misclassified(spark, d):
    return evaluate.misclassified(V.v_pred(spark, d), "doc_id", evaluate.article_errors("y_true", "y_pred"))


@query(
    "agg_misclassified_search",
    V.ctes(V.V_RESULT)
    + """, q AS (SELECT query * 100 + rank AS position, label AS t, query % 3 AS p FROM v_result)
    SELECT 'missed_relevant' AS kind, position FROM q WHERE t = 2 AND p = 0
    UNION ALL SELECT 'false_relevant', position FROM q WHERE p = 2 AND t <> p""",
)
def agg_misclassified_search(spark, d):
    r = V.v_result(spark, d).select(
        (F.col("query") * 100 + F.col("rank")).alias("position"),
        F.col("label").alias("t"),
        (F.col("query") % 3).alias("p"),
    )
    return evaluate.misclassified(r, "position", evaluate.search_errors("t", "p"))


@query(
    "agg_text_len_box",
    r"""WITH w AS (SELECT quality, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS n
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
    SELECT quality, count(*) AS texts, min(n) AS low, round(quantile_cont(n, 0.25), 6) AS q25, round(quantile_cont(n, 0.5), 6) AS q50,
      round(quantile_cont(n, 0.75), 6) AS q75, max(n) AS high FROM w GROUP BY 1""",
)
def agg_text_len_box(spark, d):
    docs = V.table(spark, d, "documents").select("doc_id", "text")
    labelled = docs.join(V.table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    box = evaluate.text_length_box(labelled, "text", "quality")
    return box.withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q75")})


# ---- data quality ------------------------------------------------------------------


def _checked(spark, d):
    """Classes with every checked column; the review columns depend on the supplier."""
    sched = text.schedule(F.col("schedule_text"))
    return V.v_class(spark, d).select(
        "term", "course_code", "course_title", "instructor", "call_number", "campus", "class_id",
        "department", "department_code", "points", "type",
        F.concat_ws(" ", "course_title", "course_code").alias("course_descr"),
        sched["days"].alias("scheduled_days"),
        F.coalesce(sched["start"], F.lit("")).alias("scheduled_time_start"),
        sched["end"].alias("scheduled_time_end"),
        F.coalesce(sched["location"], F.lit("To be announced")).alias("location"),
        F.when(F.col("supplier") % 5 == 0, "gold").alias("instructor_review_badge"),
        (F.col("supplier") % 12).alias("instructor_reviews_count"),
    )


CHECKED_SQL = """checked AS (SELECT *, course_title || ' ' || course_code AS course_descr, coalesce(t_start, '') AS start_,
  coalesce(room, 'To be announced') AS location, CASE WHEN supplier % 5 = 0 THEN 'gold' END AS badge, supplier % 12 AS reviews
  FROM v_class)"""


def _rule(name: str, col: str, good: str, required: int, extra: str = "", ok: str = "true") -> str:
    base = f"{col} IS NOT NULL {extra}"
    return f"""SELECT term, '{name}' AS "check", count(DISTINCT CASE WHEN {base} AND {good} THEN {col} END) AS observed,
      count(DISTINCT CASE WHEN {base} THEN {col} END) AS distinct_values, {required} AS required,
      (count(DISTINCT CASE WHEN {base} AND {good} THEN {col} END) >= {required} AND {ok}) AS ok FROM checked GROUP BY term"""


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _matches(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, '{pattern}')"


_ALL_TYPED = "count(CASE WHEN {c} IS NOT NULL AND try_cast({c} AS {t}) IS NULL THEN 1 END) = 0"

SUITE_SQL = "\nUNION ALL ".join(
    [
        _rule("course_code:regex", "course_code", _matches("course_code", quality.COURSE_CODE), 25),
        _rule("course_title:regex", "course_title", _matches("course_title", quality.COURSE_TITLE), 25),
        _rule("course_descr:unique", "course_descr", "true", 25),
        _rule("instructor:unique", "instructor", "true", 25),
        _rule("scheduled_time_start:regex", "start_", _matches("start_", quality.CLOCK_TIME), 2, "AND start_ <> ''"),
        _rule("scheduled_time_end:regex", "t_end", _matches("t_end", quality.CLOCK_TIME), 2, "AND t_end <> ''"),
        _rule("scheduled_days:regex", "days", _matches("days", quality.DAYS), 1),
        _rule("call_number:type", "call_number", "try_cast(call_number AS BIGINT) IS NOT NULL", 10,
              ok=_ALL_TYPED.format(c="call_number", t="BIGINT")),
        _rule("campus:in_set", "campus", f"campus IN {_in(quality.CAMPUSES)}", 1),
        _rule("class_id:regex", "class_id", _matches("class_id", quality.CLASS_ID), 25),
        _rule("department:in_set", "department", f"department IN {_in(quality.DEPARTMENTS)}", 1),
        _rule("department_code:in_set", "department_code", f"department_code IN {_in(quality.DEPARTMENT_CODES)}", 3),
        _rule("instructor_review_badge:in_set", "badge", f"badge IN {_in(quality.BADGES)}", 1),
        _rule("instructor_reviews_count:type", "reviews", "true", 10),
        _rule("location:in_set", "location", f"location IN {_in(quality.UNPLACED)}", 1),
        _rule("points:regex", "points", _matches("points", quality.POINTS), 4),
        _rule("type:in_set", "type", f"type IN {_in(quality.CLASS_TYPES)}", 1),
    ]
)


@query("dq_term_suite", V.ctes(V.V_CLASS, CHECKED_SQL) + SUITE_SQL)
def dq_term_suite(spark, d):
    return quality.run_checks(_checked(spark, d), quality.term_checks())


def _one(spark, d, check):
    return quality.run_checks(_checked(spark, d).select("term", check.column), [check])


@query(
    "dq_regex_coverage",
    V.ctes(V.V_CLASS, CHECKED_SQL) + _rule("points:regex", "points", _matches("points", "^[0-9]$"), 4),
)
def dq_regex_coverage(spark, d):
    return _one(spark, d, quality.regex_coverage("points", "^[0-9]$", 4))


@query(
    "dq_in_set",
    V.ctes(V.V_CLASS, CHECKED_SQL)
    + _rule("department_code:in_set", "department_code", "department_code IN ('Brand#1', 'Brand#2', 'Brand#99')", 3),
)
def dq_in_set(spark, d):
    return _one(spark, d, quality.in_set("department_code", ["Brand#1", "Brand#2", "Brand#99"]))


@query(
    "dq_type",
    V.ctes(V.V_CLASS, CHECKED_SQL)
    + _rule("points:type", "points", "try_cast(points AS INT) IS NOT NULL", 2, ok=_ALL_TYPED.format(c="points", t="INT")),
)
def dq_type(spark, d):
    return _one(spark, d, quality.typed("points", "int", 2))


@query(
    "dq_unique",
    V.ctes(V.V_CLASS, CHECKED_SQL) + _rule("instructor:unique", "instructor", "true", 88),
)
def dq_unique(spark, d):
    return _one(spark, d, quality.unique("instructor", 88))


@query(
    "dq_suite_result",
    V.ctes(V.V_CLASS, CHECKED_SQL, f"report AS ({SUITE_SQL})")
    + "SELECT count(DISTINCT term) AS groups, count_if(NOT ok) AS failed, count_if(NOT ok) = 0 AS passed FROM report",
)
def dq_suite_result(spark, d):
    return quality.suite_result(quality.run_checks(_checked(spark, d), quality.term_checks()))
