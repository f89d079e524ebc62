"""Whole jobs over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollbook.operators import filters, jobs, joins
from rollbook.plans import views as V
from rollbook.plans.q_pages import class_pages
from rollbook.plans.registry import query


@query(
    "job_crawl_merge",
    V.ctes(V.V_CLASS)
    + """, p AS (SELECT *, replace(department_code, '#', '_') AS code FROM v_class),
    k AS (SELECT instructor, count(DISTINCT department) AS departments, count(DISTINCT (term, code || ' ' || part)) AS taught
      FROM p WHERE instructor IS NOT NULL GROUP BY 1)
    SELECT term, call_number, code || ' ' || part AS course_code, code AS department_code, department,
      coalesce(p.instructor, '') AS instructor, departments, taught FROM p LEFT JOIN k ON p.instructor = k.instructor""",
)
def job_crawl_merge(spark, d):
    """Pages of the second crawl are parsed and merged with the stored classes of the first; every
    class then gets the totals of its person."""
    code = F.replace("department_code", F.lit("#"), F.lit("_"))
    old = V.v_class(spark, d).select(
        "term",
        code.alias("department_code"),
        F.concat(code, F.lit(" "), F.col("part").cast("string")).alias("course_code"),
        "call_number",
        "department",
        "instructor",
    )
    done = jobs.crawl_merge(class_pages(spark, d, classes=V.v_new(spark, d, spread=True)), old, columns=old.columns)
    totals = done.people.select(
        "name", F.size("departments").alias("departments"), F.size("classes").alias("taught")
    )
    full = joins.enrich(done.classes, totals, {"departments": "departments", "taught": "taught"})
    return full.select(
        "term", "call_number", "course_code", "department_code", "department",
        F.coalesce("instructor", F.lit("")).alias("instructor"), "departments", "taught",
    )


@query(
    "filter_refresh",
    V.ctes(V.V_USER, V.V_LAST_CHECK)
    + """, up AS (SELECT CAST(user_id AS VARCHAR) AS name, max(ts) AS last_update FROM events WHERE value > 90 GROUP BY 1),
    s AS (SELECT u.name, last_check, last_update, CAST(u.name AS BIGINT) % 2 = 0 AS linked FROM v_user u
      LEFT JOIN v_last_check c ON u.name = c.name LEFT JOIN up ON u.name = up.name),
    t AS (SELECT *, coalesce(last_check < TIMESTAMP '2024-01-28', true) AS search_due,
      coalesce(last_update < TIMESTAMP '2024-01-28', true) AS update_due FROM s)
    SELECT name, linked, update_due FROM t WHERE search_due AND NOT (linked AND NOT update_due)""",
)
def filter_refresh(spark, d):
    """People whose search is due, without those that have a link and a fresh update."""
    e = V.table(spark, d, "events").filter(F.col("value") > 90)
    updates = e.groupBy(F.col("user_id").cast("string").alias("name")).agg(F.max("ts").alias("last_update"))
    people = joins.with_last_check(V.v_user(spark, d), V.v_last_check(spark, d)).join(updates, "name", "left")
    linked, name = F.col("name").cast("bigint") % 2 == 0, F.col("name")
    days = (V.CHECK_DAYS, V.CHECK_DAYS)
    due = filters.needs_refresh(linked, F.col("last_check"), F.col("last_update"), name, V.AS_OF, *days)
    fresh = filters.stale(F.col("last_update"), name, V.AS_OF, *days)
    return people.filter(due).select("name", linked.alias("linked"), fresh.alias("update_due"))
