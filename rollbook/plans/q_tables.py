"""Projections, filters, joins, aggregations, sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollbook.functions import names as N
from rollbook.functions import terms, text
from rollbook.operators import columns, extract, filters, fuzzy, joins, merge, sampling
from rollbook.operators.stored import StoredTerms, buckets_for
from rollbook.plans import views as V
from rollbook.plans.registry import query
from rollbook.sources.scratch import released, scratch_dir, stored

BASIC = ("term", "course_code", "course_title", "call_number", "instructor", "department_code")
BASIC_SQL = ", ".join(BASIC)
LINK_MAP = {"link": "instructor_link"}
# repeatable shuffle that SQL can compute as well
PORTABLE = "{k} * 7919 % 10007"


def _class(spark, d, *cols):
    return V.v_class(spark, d).select(*(cols or BASIC))


# ---- projections -------------------------------------------------------------------


@query(
    "proj_reorder",
    V.ctes(V.V_CLASS)
    + "SELECT course_code, course_title, call_number, department_code, instructor, term FROM v_class",
)
def proj_reorder(spark, d):
    return columns.reorder(_class(spark, d), ["course_code", "course_title"])


@query(
    "proj_drop",
    V.ctes(V.V_CLASS) + "SELECT term, course_code, course_title, call_number, department_code FROM v_class",
)
def proj_drop(spark, d):
    return columns.drop_columns(_class(spark, d), ["instructor", "raw_content", "enrollment"])


@query(
    "proj_rename_subset",
    V.ctes(V.V_CLASS, V.V_INSTRUCTOR)
    + "SELECT name AS instructor, link AS instructor_link FROM v_instructor",
)
def proj_rename_subset(spark, d):
    return columns.rename_subset(V.v_instructor(spark, d), {"name": "instructor", **LINK_MAP})


@query(
    "proj_ensure_columns",
    V.ctes(V.V_CLASS)
    + f"SELECT {BASIC_SQL}, CAST(NULL AS VARCHAR) AS instructor_link, CAST(NULL AS BIGINT) AS reviews FROM v_class",
)
def proj_ensure_columns(spark, d):
    return columns.ensure_columns(
        _class(spark, d), {"term": "string", "instructor_link": "string", "reviews": "bigint"}
    )


# ---- filters -----------------------------------------------------------------------


@query(
    "filter_null_state",
    V.ctes(V.V_CLASS)
    + f"SELECT {BASIC_SQL} FROM v_class WHERE instructor IS NOT NULL AND instructor <> ''",
)
def filter_null_state(spark, d):
    return _class(spark, d).filter(filters.present(F.col("instructor")))


@query(
    "filter_stale",
    V.ctes(V.V_USER, V.V_LAST_CHECK)
    + """SELECT u.name, strftime(last_check, '%Y-%m-%d %H:%M:%S') AS last_check
    FROM v_user u LEFT JOIN v_last_check c ON u.name = c.name
    WHERE last_check IS NULL OR last_check < TIMESTAMP '2024-01-28 00:00:00'""",
)
def filter_stale(spark, d):
    people = joins.with_last_check(V.v_user(spark, d), V.v_last_check(spark, d))
    due = filters.stale(
        F.col("last_check"), F.col("name"), V.AS_OF, V.CHECK_DAYS, V.CHECK_DAYS
    )
    return people.filter(due).select(
        "name", F.date_format("last_check", "yyyy-MM-dd HH:mm:ss").alias("last_check")
    )


@query(
    "filter_affiliation",
    """SELECT c_custkey, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE (lower(c_mktsegment) LIKE '%house%' AND lower(c_mktsegment) NOT LIKE '%machine%')
       OR lower(n_name) LIKE '%nation_1%' OR lower(n_name) LIKE '%nation_7%'""",
)
def filter_affiliation(spark, d):
    c, n = V.table(spark, d, "customer"), V.table(spark, d, "nation")
    joined = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    hit = filters.affiliated(
        F.col("c_mktsegment"), F.col("n_name"), ["house"], ["machine"], ["Nation_1", "nation_7"]
    )
    return joined.filter(hit).select("c_custkey", "c_mktsegment", "n_name")


_CANDIDATE_SQL = """cand AS (
  SELECT p_partkey AS id, p_name AS name, lower(p_type || ' ' || p_name) AS own,
         p_name || CASE WHEN p_size % 2 = 0 THEN '' ELSE ' jr' END AS found,
         lower(p_name || ' ' || p_brand || ' ' || p_type) AS theirs FROM part)"""


@query(
    "filter_candidates",
    V.ctes(_CANDIDATE_SQL)
    + """SELECT id, name, found, round(jaro_winkler_similarity(lower(name), lower(found)), 6) AS name_similarity
    FROM cand WHERE len(list_intersect(list_distinct(string_split(own, ' ')), string_split(theirs, ' '))) >= 2
      AND jaro_winkler_similarity(lower(name), lower(found)) > 0.95
      AND name NOT IN (SELECT p_name FROM part WHERE p_retailprice < 901)""",
)
def filter_candidates(spark, d):
    p = V.table(spark, d, "part")
    found = F.concat("p_name", F.when(F.col("p_size") % 2 == 0, "").otherwise(" jr"))
    own = text.words(F.lower(F.concat_ws(" ", "p_type", "p_name")))
    theirs = text.words(F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type")))
    cand = p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        found.alias("found"),
        joins.shared_values(own, theirs).alias("overlap"),
    )
    pairs = cand.select("name", "found").distinct()
    scored = pairs.withColumn("name_similarity", N.str_similarity(F.col("name"), F.col("found")))
    linked = p.filter(F.col("p_retailprice") < 901).select(F.col("p_name").alias("name"))
    likely = filters.likely_candidates(cand.join(scored, ["name", "found"]), linked)
    return likely.select("id", "name", "found", F.round("name_similarity", 6).alias("name_similarity"))


@query(
    "filter_words_match",
    """SELECT doc_id, source FROM documents
    WHERE contains(lower(text), 'the') AND contains(lower(text), 'and') AND contains(lower(text), lower(lang))""",
)
def filter_words_match(spark, d):
    docs = V.table(spark, d, "documents")
    wanted = F.concat(F.lit("The  AND "), "lang")
    return docs.filter(N.words_match(wanted, F.col("text"))).select("doc_id", "source")


@query(
    "filter_nonempty_map",
    V.ctes(V.V_CLASS)
    + "SELECT term, call_number, CAST(seen_on AS VARCHAR) || '=' || seats AS history FROM v_class WHERE seats > 10",
)
def filter_nonempty_map(spark, d):
    seen = F.create_map(F.col("seen_on").cast("string"), F.col("seats").cast("string"))
    df = V.v_class(spark, d).select(
        "term", "call_number", F.map_filter(seen, lambda _, v: v.cast("int") > 10).alias("h")
    )
    return df.filter(filters.non_empty_map(F.col("h"))).select(
        "term", "call_number", terms.map_text(F.col("h")).alias("history")
    )


_LINK_SQL = r"""links AS (
  SELECT page_id, url, unnest(list_transform(regexp_extract_all(html, '<a [^>]*href="[^"]*"'),
         lambda x: regexp_extract(x, 'href="([^"]*)"', 1))) AS href FROM pages)"""


@query(
    "filter_links",
    V.ctes(_LINK_SQL)
    + r"""SELECT url, CASE WHEN href LIKE '%://%' THEN href
      ELSE regexp_extract(url, '^[a-z]+://[^/]*') || href END AS link
    FROM links WHERE contains(href, '/th')""",
)
def filter_links(spark, d):
    return extract.links_containing(V.table(spark, d, "pages").select("url", "html"), "/th")


# ---- joins -------------------------------------------------------------------------


@query(
    "join_left_coalesce",
    V.ctes(V.V_CLASS, V.V_INSTRUCTOR)
    + f"""SELECT {", ".join("v." + c for c in BASIC)},
      coalesce(CASE WHEN line = 1 THEN '/kept/' || call_number END, i.link) AS instructor_link
    FROM v_class v LEFT JOIN v_instructor i ON v.instructor = i.name""",
)
def join_left_coalesce(spark, d):
    """Rolled-up people give their links to the classes; links already there stay."""
    classes = V.v_class(spark, d).withColumn(
        "instructor_link", F.when(F.col("line") == 1, F.concat(F.lit("/kept/"), "call_number"))
    )
    people = merge.people_rollup(classes)
    known = V.table(spark, d, "supplier").select(
        F.col("s_name").alias("name"),
        F.when(
            F.col("s_suppkey") % 2 == 0, F.concat(F.lit("/people/"), F.col("s_suppkey").cast("string"))
        ).alias("link"),
    )
    linked = people.join(known, "name").select("name", "link")
    return joins.enrich(classes.select(*BASIC, "instructor_link"), linked, LINK_MAP)


_OVERLAY_SQL = """SELECT n.term, n.call_number, n.course_code, o.date, o.seen
    FROM v_enrollment_new n JOIN v_enrollment_old o ON n.term = o.term AND n.call_number = o.call_number
    UNION ALL
    SELECT term, call_number, course_code, date, seen FROM v_enrollment_new n WHERE NOT EXISTS (
      SELECT 1 FROM v_enrollment_old o
      WHERE n.term = o.term AND n.call_number = o.call_number AND n.date = o.date)"""


@query(
    "join_left_enrollment",
    V.ctes(V.V_CLASS, V.V_ENROLLMENT_OLD, V.V_ENROLLMENT_NEW) + _OVERLAY_SQL,
)
def join_left_enrollment(spark, d):
    merged = merge.overlay_enrollment(V.v_enrollment_new(spark, d), V.v_enrollment_old(spark, d))
    return merged.select("term", "call_number", "course_code", F.explode("enrollment").alias("date", "seen"))


@query(
    "join_left_last_check",
    V.ctes(V.V_USER, V.V_LAST_CHECK)
    + """SELECT u.name, strftime(last_check, '%Y-%m-%d %H:%M:%S') AS last_check
    FROM v_user u LEFT JOIN v_last_check c ON u.name = c.name""",
)
def join_left_last_check(spark, d):
    people = joins.with_last_check(V.v_user(spark, d), V.v_last_check(spark, d))
    return people.select("name", F.date_format("last_check", "yyyy-MM-dd HH:mm:ss").alias("last_check"))


@query(
    "join_anti_keep_old",
    V.ctes(V.V_CLASS, V.V_NEW)
    + """SELECT term, department_code, call_number, 'new' AS crawl FROM v_new
    UNION ALL SELECT term, department_code, call_number, 'old' FROM v_class o
    WHERE NOT EXISTS (SELECT 1 FROM v_new n WHERE n.term = o.term AND n.department_code = o.department_code)""",
)
def join_anti_keep_old(spark, d):
    cols = ("term", "department_code", "call_number")
    new = V.v_new(spark, d).select(*cols, F.lit("new").alias("crawl"))
    old = V.v_class(spark, d).select(*cols, F.lit("old").alias("crawl"))
    return merge.keep_old(new, old)


def _found_links(spark, d):
    """Links found per supplier and department; several per name, ordered by call number."""
    return V.v_class(spark, d).select(
        F.col("instructor").alias("name"),
        F.concat_ws("; ", "department", "course_title").alias("department"),
        F.concat(F.lit("/found/"), "part").alias("link"),
        "order_key",
        "line",
        "part",
    ).filter(F.col("name").isNotNull())


@query(
    "join_overlap_update",
    V.ctes(V.V_CLASS, V.V_INSTRUCTOR)
    + """, found AS (SELECT instructor AS name, department, '/found/' || part AS link, order_key, line, part
      FROM v_class WHERE instructor IS NOT NULL),
    hit AS (SELECT f.name, arg_max(f.link, (order_key, line, part)) AS link FROM found f JOIN v_instructor i
      ON f.name = i.name AND list_contains(i.departments, f.department) AND f.department <> 'PROMO' GROUP BY 1)
    SELECT i.id, i.name, coalesce(h.link, i.link) AS link FROM v_instructor i LEFT JOIN hit h ON i.name = h.name""",
)
def join_overlap_update(spark, d):
    people = V.v_instructor(spark, d).withColumn(
        "departments", F.array_remove("departments", "PROMO")
    )
    out = joins.overlap_update(people, _found_links(spark, d), ["order_key", "line", "part"])
    return out.select("id", "name", "link")


@query(
    "join_equi_update",
    V.ctes(V.V_CLASS, V.V_INSTRUCTOR)
    + """, upd AS (SELECT s_name AS name, arg_max((CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END,
        l_linenumber), (l_orderkey, l_linenumber, l_partkey)) AS u, count(*) AS n
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity > 25 GROUP BY 1)
    SELECT i.id, i.name, CASE WHEN n IS NULL THEN 'old' ELSE u[1] END AS badge,
      CASE WHEN n IS NULL THEN NULL ELSE CAST(u[2] AS BIGINT) END AS reviews
    FROM v_instructor i LEFT JOIN upd ON i.name = upd.name""",
)
def join_equi_update(spark, d):
    """The last review row per person wins; its missing badge clears the old one."""
    li, s = V.table(spark, d, "lineitem"), V.table(spark, d, "supplier")
    updates = li.filter(F.col("l_quantity") > 25).join(s, li["l_suppkey"] == s["s_suppkey"]).select(
        F.col("s_name").alias("name"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("badge"),
        F.col("l_linenumber").cast("bigint").alias("reviews"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )
    people = V.v_instructor(spark, d).select("id", "name", F.lit("old").alias("badge"))
    return joins.equi_update(
        people, updates, ["badge", "reviews"], ["l_orderkey", "l_linenumber", "l_partkey"]
    )


def tokens_sql(c: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({c}), '[^0-9a-z_]'), lambda x: len(x) > 1)"


def ordered_sql(c: str) -> str:
    return (
        f"CASE WHEN contains({c}, ',') THEN trim(split_part({c}, ',', 2)) || ' ' || split_part({c}, ',', 1)"
        f" ELSE {c} END"
    )


def match_sql(ct: str, ft: str, cw: str, fw: str) -> str:
    """Two names match, from their part lists and lower-cased ordered forms."""
    close = "len(list_filter({0}, lambda s: jaro_winkler_similarity({1}, s) >= 0.95)) > 0"
    return f"""(len(list_filter({ft}, lambda t: {close.format(ct, "t")})) >= 2
     OR (len({ft}) = 1 AND {close.format(ct, ft + "[1]")})
     OR jaro_winkler_similarity({cw}, {fw}) >= 0.97)"""


# brute force over all pairs
_MATCH_SQL = f"""side AS (SELECT name, foreign_name, lower({ordered_sql("foreign_name")}) AS fw, lower(name) AS cw,
    {tokens_sql("name")} AS ct, {tokens_sql(ordered_sql("foreign_name"))} AS ft FROM v_name),
matched AS (SELECT c.name, f.foreign_name AS found FROM side c, side f WHERE {match_sql("c.ct", "f.ft", "c.cw", "f.fw")})"""


@query(
    "join_fuzzy_name",
    V.ctes(V.V_NAME, _MATCH_SQL)
    + "SELECT found, min(name) AS first_match, count(*) > 1 AS several FROM matched GROUP BY found",
)
def join_fuzzy_name(spark, d):
    people = V.v_name(spark, d)
    found = people.select(F.col("foreign").alias("found"))
    return fuzzy.fuzzy_first(people.select("name"), "name", found, "found")


@query(
    "join_fuzzy_pairs",
    V.ctes(V.V_NAME, _MATCH_SQL) + "SELECT name, found FROM matched",
)
def join_fuzzy_pairs(spark, d):
    people = V.v_name(spark, d)
    found = people.select(F.col("foreign").alias("found"))
    return fuzzy.fuzzy_pairs(people.select("name"), "name", found, "found").select(
        F.col("c").alias("name"), F.col("f").alias("found")
    )


_HITS_SQL = f"""people AS (SELECT DISTINCT p_name || CASE WHEN p_size % 3 = 0 THEN ' x' ELSE '' END AS name FROM part),
hits AS (SELECT p_name AS query, p_partkey AS rank, '/part/' || p_partkey AS link,
    CASE WHEN p_size % 2 = 0 THEN split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1)
         ELSE split_part(p_name, ' ', 1) || ' ' || p_type END AS found FROM part
  UNION ALL SELECT p_name || ' x', p_partkey, '/odd/' || p_partkey, p_type FROM part WHERE p_size % 3 = 0),
asked AS (SELECT name, replace(name, ' x', '') AS short, {tokens_sql("name")} AS ct FROM people),
found AS (SELECT *, {tokens_sql(ordered_sql("found"))} AS ft, lower({ordered_sql("found")}) AS fw FROM hits),
one AS (SELECT name, arg_min((found, link), rank) AS b, count(*) AS n FROM asked JOIN found ON name = query
  WHERE {match_sql("ct", "ft", "lower(name)", "fw")} GROUP BY 1),
two AS (SELECT name, arg_min((found, link), rank) AS b, count(*) AS n FROM asked JOIN found ON short = query
  WHERE {match_sql("ct", "ft", "lower(name)", "fw")} AND name <> short AND name NOT IN (SELECT name FROM one) GROUP BY 1)"""


@query(
    "join_fuzzy_search",
    V.ctes(_HITS_SQL)
    + """SELECT name, b[1] AS found, b[2] AS link, n AS matches, 1 AS step FROM one
    UNION ALL SELECT name, b[1], b[2], n, 2 FROM two""",
)
def join_fuzzy_search(spark, d):
    p = V.table(spark, d, "part")
    initial = F.col("p_size") % 3 == 0
    full = F.concat("p_name", F.when(initial, " x").otherwise(""))
    parts = F.split("p_name", " ")
    a, b = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    found = F.when(F.col("p_size") % 2 == 0, F.concat(b, F.lit(", "), a)).otherwise(
        F.concat(a, F.lit(" "), "p_type")
    )
    key = F.col("p_partkey")
    hits = p.select(
        F.col("p_name").alias("query"),
        key.alias("rank"),
        found.alias("found"),
        F.concat(F.lit("/part/"), key.cast("string")).alias("link"),
    ).unionByName(
        p.filter(initial).select(
            full.alias("query"),
            key.alias("rank"),
            F.col("p_type").alias("found"),
            F.concat(F.lit("/odd/"), key.cast("string")).alias("link"),
        )
    )
    return fuzzy.search_hits(p.select(full.alias("name")), hits)


@query(
    "join_lookup_fallback",
    V.ctes(V.V_CLASS)
    + """, asked AS (SELECT l_orderkey, p_brand || ' ' || p_partkey AS course_code FROM lineitem
      JOIN part ON l_partkey = p_partkey),
    titles AS (SELECT course_code, arg_min(course_title, (order_key, line)) AS t FROM v_class
      WHERE type = 'LECTURE' AND seats > 40 GROUP BY 1)
    SELECT l_orderkey, a.course_code, coalesce(t, a.course_code) AS course_title
    FROM asked a LEFT JOIN titles t ON a.course_code = t.course_code""",
)
def join_lookup_fallback(spark, d):
    li, p = V.table(spark, d, "lineitem"), V.table(spark, d, "part")
    asked = li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        "l_orderkey",
        F.concat("p_brand", F.lit(" "), F.col("p_partkey").cast("string")).alias("course_code"),
    )
    known = V.v_class(spark, d).filter((F.col("type") == "LECTURE") & (F.col("seats") > 40))
    return joins.lookup_fallback(asked, known, "course_code", "course_title", ["order_key", "line"])


@query(
    "join_map_lookup",
    V.ctes(V.V_CLASS)
    + """, links AS (SELECT s_name AS instructor, '/supplier/' || max(s_suppkey) AS link FROM supplier
      WHERE s_acctbal > 0 GROUP BY 1)
    SELECT call_number, v.instructor, link FROM v_class v LEFT JOIN links l ON v.instructor = l.instructor""",
)
def join_map_lookup(spark, d):
    s = V.table(spark, d, "supplier").filter(F.col("s_acctbal") > 0)
    links = s.select(
        F.col("s_name").alias("instructor"),
        F.concat(F.lit("/supplier/"), F.col("s_suppkey").cast("string")).alias("link"),
        "s_suppkey",
    )
    return joins.map_lookup(
        _class(spark, d, "call_number", "instructor"), links, "instructor", "link", ["s_suppkey"]
    )


@query(
    "join_class_index",
    V.ctes(V.V_CLASS, V.V_INSTRUCTOR)
    + """SELECT name, id, term, course_code, call_number FROM v_instructor JOIN v_class ON instructor = name""",
)
def join_class_index(spark, d):
    people = V.v_instructor(spark, d).select("name", "id")
    return joins.class_index(people, _class(spark, d, "instructor", "term", "course_code", "call_number"))


_MERGED = ("term", "department_code", "course_code", "call_number")


def _second_crawl(spark, d):
    """The second crawl with one date per class."""
    even = F.col("line") % 2 == 0
    date = F.when(even, F.col("seen_on")).otherwise(F.date_add("seen_on", 7)).cast("string")
    seats = F.when(even, F.col("seats") + 1).otherwise(F.col("seats")).cast("string")
    return V.v_new(spark, d).select(
        *_MERGED, F.create_map(date, F.concat(seats, F.lit("/50"))).alias("enrollment")
    )


@query(
    "merge_term",
    V.ctes(V.V_CLASS, V.V_NEW, V.V_ENROLLMENT_OLD)
    + """, base AS (
      SELECT term, call_number, course_code, CAST(CASE WHEN line % 2 = 0 THEN seen_on ELSE seen_on + 7 END AS VARCHAR) AS date,
        CAST(CASE WHEN line % 2 = 0 THEN seats + 1 ELSE seats END AS VARCHAR) || '/50' AS seen FROM v_new
      UNION ALL SELECT term, call_number, course_code, NULL, NULL FROM v_class o WHERE NOT EXISTS (
        SELECT 1 FROM v_new n WHERE n.term = o.term AND n.department_code = o.department_code)),
    rows AS (SELECT row_number() OVER () AS id, * FROM base),
    laid AS (SELECT id, r.term, r.call_number, course_code, o.date, o.seen FROM rows r JOIN v_enrollment_old o
        ON r.term = o.term AND r.call_number = o.call_number
      UNION ALL SELECT id, term, call_number, course_code, date, seen FROM rows r WHERE date IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM v_enrollment_old o WHERE r.term = o.term AND r.call_number = o.call_number AND r.date = o.date)),
    ends AS (SELECT *, CAST(split_part(term, '-', 1) || CASE split_part(term, '-', 2) WHEN 'Spring' THEN '-05-20'
        WHEN 'Summer' THEN '-08-20' ELSE '-12-26' END AS DATE) AS stop FROM laid),
    flag AS (SELECT *, min(date) OVER (PARTITION BY id) AS first_date,
        count(CASE WHEN CAST(date AS DATE) <= stop THEN 1 END) OVER (PARTITION BY id) AS n_in FROM ends)
    SELECT term, call_number, course_code, date, seen FROM flag
    WHERE CAST(date AS DATE) <= stop OR (n_in = 0 AND date = first_date)""",
)
def merge_term(spark, d):
    """The whole merge: keep-old, history overlay, cut-off after the term."""
    new = _second_crawl(spark, d)
    merged = merge.merge_term(new, _class(spark, d, *_MERGED), V.v_enrollment_old(spark, d))
    # a plain explode infers a filter that would compute every history a second time
    dates = F.explode_outer("enrollment").alias("date", "seen")
    return merged.enrollment.select("term", "call_number", "course_code", dates).where("date IS NOT NULL")


@query(
    "merge_stored_terms",
    V.ctes(V.V_CLASS, V.V_NEW)
    + """, o AS (SELECT term, call_number, course_code, CAST(seen_on AS VARCHAR) AS date, max(seats) AS n FROM v_class GROUP BY ALL),
    n AS (SELECT term, call_number, course_code, CAST(CASE WHEN line % 2 = 0 THEN seen_on ELSE seen_on + 7 END AS VARCHAR) AS date,
        max(CASE WHEN line % 2 = 0 THEN seats + 1 ELSE seats END) AS n FROM v_new GROUP BY ALL),
    gone AS (SELECT term, call_number, course_code FROM v_class WHERE (term, department_code) NOT IN (SELECT (term, department_code) FROM v_new)),
    h AS (SELECT * FROM o WHERE (term, call_number, course_code) IN (SELECT (term, call_number, course_code) FROM n UNION ALL SELECT (term, call_number, course_code) FROM gone)
      UNION ALL SELECT * FROM n WHERE (term, call_number, course_code, date) NOT IN (SELECT (term, call_number, course_code, date) FROM o)),
    ends AS (SELECT *, CAST(date AS DATE) <= CAST(split_part(term, '-', 1) || CASE split_part(term, '-', 2) WHEN 'Spring' THEN '-05-20'
        WHEN 'Summer' THEN '-08-20' ELSE '-12-26' END AS DATE) AS inside FROM h),
    flag AS (SELECT *, min(date) OVER w AS low, bool_or(inside) OVER w AS any_in FROM ends WINDOW w AS (PARTITION BY term, call_number, course_code))
    SELECT term, call_number, course_code, date, n || '/50' AS seen FROM flag WHERE inside OR (NOT any_in AND date = low)""",
)
def merge_stored_terms(spark, d):
    """The merge over bucketed tables, histories by class: the first crawl is stored and the second
    merged into it twice, with nothing of the stored histories shuffled."""
    day = F.create_map(F.col("seen_on").cast("string"), F.concat(F.col("seats").cast("string"), F.lit("/50")))
    first = stored(V.v_class(spark, d).select(*_MERGED, day.alias("enrollment")), "first-crawl")
    kept = StoredTerms(spark, scratch_dir(spark, "terms"), first.schema, buckets_for(first.count()))
    known = kept.classes.terms(first)
    kept.classes.replace_terms(first, known)
    kept.enrollment.replace_terms(first, known)  # dates after the end of a term are still there
    released(first)
    second = stored(_second_crawl(spark, d), "crawl")
    for _ in range(2):
        kept.merge(second)
    released(second)
    return kept.histories()


# ---- aggregations ------------------------------------------------------------------


@query(
    "agg_instructor_rollup",
    V.ctes(V.V_CLASS)
    + """SELECT instructor AS name, array_to_string(list_sort(list(DISTINCT department)), ';') AS departments,
      array_to_string(list_sort(list(DISTINCT term || ' ' || course_code)), ';') AS classes
    FROM v_class WHERE instructor IS NOT NULL GROUP BY 1""",
)
def agg_instructor_rollup(spark, d):
    """Half of the classes come as the stored people, the rest as the new crawl."""
    classes = _class(spark, d, "instructor", "department", "term", "course_code", "type")
    previous = merge.people_rollup(classes.filter(F.col("type") == "LECTURE"))
    people = merge.people_rollup(classes.filter(F.col("type") != "LECTURE"), previous)
    lines = F.transform("classes", lambda c: F.concat_ws(" ", c["term"], c["course_code"]))
    return people.select(
        "name",
        F.array_join("departments", ";").alias("departments"),
        F.array_join(lines, ";").alias("classes"),
    )


@query(
    "agg_classes_by_term",
    V.ctes(V.V_CLASS) + "SELECT term, count(*) AS classes FROM v_class GROUP BY ROLLUP (term)",
)
def agg_classes_by_term(spark, d):
    return merge.classes_by_term(_class(spark, d, "term"))


@query(
    "agg_progress",
    V.ctes(V.V_USER, V.V_LAST_CHECK)
    + """, due AS (SELECT count(*) AS total, count_if(last_check IS NULL OR last_check < TIMESTAMP '2024-01-28') AS due
      FROM v_user u LEFT JOIN v_last_check c ON u.name = c.name)
    SELECT total, due, total - due AS done, least(due, 300) AS batch, round(least(due, 300) * 38.5 / 60, 6) AS minutes
    FROM due""",
)
def agg_progress(spark, d):
    people = joins.with_last_check(V.v_user(spark, d), V.v_last_check(spark, d))
    due = filters.stale(F.col("last_check"), F.col("name"), V.AS_OF, V.CHECK_DAYS, V.CHECK_DAYS)
    return sampling.progress(people, due).withColumn("minutes", F.round("minutes", 6))


@query(
    "agg_job_counters",
    """SELECT count_if(event_type = 'view') AS departments, count_if(event_type = 'click') AS classes,
      count_if(event_type = 'signup') AS searches, count_if(event_type = 'purchase' AND value > 50) AS matches
    FROM events""",
)
def agg_job_counters(spark, d):
    kind = F.col("event_type")
    return sampling.counters(
        V.table(spark, d, "events"),
        {
            "departments": kind == "view",
            "classes": kind == "click",
            "searches": kind == "signup",
            "matches": (kind == "purchase") & (F.col("value") > 50),
        },
    )


@query(
    "agg_fill_gain",
    V.ctes(V.V_CLASS, V.V_INSTRUCTOR)
    + """, j AS (SELECT CASE WHEN line = 1 THEN '/kept/' || call_number END AS old, i.link FROM v_class v
      LEFT JOIN v_instructor i ON v.instructor = i.name)
    SELECT 'instructor_link' AS field, count(old) AS n_before, count(coalesce(old, link)) AS n_after,
      count(coalesce(old, link)) - count(old) AS gain FROM j""",
)
def agg_fill_gain(spark, d):
    classes = V.v_class(spark, d).select(
        "instructor",
        F.when(F.col("line") == 1, F.concat(F.lit("/kept/"), "call_number")).alias("instructor_link"),
    )
    after = joins.enrich(classes, V.v_instructor(spark, d), LINK_MAP)
    return joins.fill_gain(classes, after, ["instructor_link"])


@query(
    "agg_link_counts",
    """SELECT count_if(event_type <> 'signup') AS searched, count_if(event_type = 'purchase') AS found,
      count_if(event_type = 'error') AS unsure FROM events""",
)
def agg_link_counts(spark, d):
    kind = F.col("event_type")
    return sampling.counters(
        V.table(spark, d, "events"),
        {"searched": kind != "signup", "found": kind == "purchase", "unsure": kind == "error"},
    )


# ---- sorts, limits, samples --------------------------------------------------------


@query(
    "sort_classes",
    V.ctes(V.V_CLASS) + "SELECT course_code, course_title, call_number, term FROM v_class ORDER BY 1, 2, 3",
)
def sort_classes(spark, d):
    return columns.sort_rows(_class(spark, d, "course_code", "course_title", "call_number", "term"))


@query(
    "sort_nested",
    """SELECT p_partkey, array_to_string(list_sort(string_split(p_name || ' ' || p_type, ' ')), ' ') AS flat,
      list_aggregate(list_transform(list_sort([string_split(p_name, ' '), string_split(p_type || ' ' || p_brand, ' ')]),
        lambda x: array_to_string(x, ' ')), 'string_agg', '|') AS nested,
      CASE WHEN p_size > 25 THEN p_type END AS nullable FROM part""",
)
def sort_nested(spark, d):
    p = V.table(spark, d, "part")
    flat = F.split(F.concat_ws(" ", "p_name", "p_type"), " ")
    nested = F.array(F.split("p_name", " "), F.split(F.concat_ws(" ", "p_type", "p_brand"), " "))
    lines = F.transform(text.sorted_list(nested), lambda x: F.array_join(x, " "))
    maybe = F.when(F.col("p_size") > 25, F.array("p_type"))
    return p.select(
        "p_partkey",
        F.array_join(text.sorted_list(flat), " ").alias("flat"),
        F.array_join(lines, "|").alias("nested"),
        F.array_join(text.sorted_list(maybe), " ").alias("nullable"),
    )


@query(
    "limit_test_run",
    V.ctes(V.V_CLASS)
    + "SELECT course_code, call_number, term FROM v_class ORDER BY course_code, call_number, term LIMIT 21",
)
def limit_test_run(spark, d):
    df = _class(spark, d, "course_code", "call_number", "term")
    return sampling.trial_run(df, ["course_code", "call_number", "term"])


@query(
    "limit_shuffled_batch",
    f"""SELECT c_custkey, c_name FROM customer ORDER BY {PORTABLE.format(k="c_custkey")}, c_custkey LIMIT 300""",
)
def limit_shuffled_batch(spark, d):
    c = V.table(spark, d, "customer").select("c_custkey", "c_name")
    return sampling.shuffled_batch(c, "c_custkey", shuffle=F.expr(PORTABLE.format(k="c_custkey")))


@query(
    "sample_label_rows",
    f"""SELECT conv_id, count(*) AS results FROM conversations GROUP BY 1
    HAVING ({PORTABLE.format(k="conv_id")}) % 101 < 10 OR count(*) = 1""",
)
def sample_label_rows(spark, d):
    c = V.table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("results"))
    return sampling.label_sample(
        c, "conv_id", F.col("results"), spread=F.expr(PORTABLE.format(k="conv_id"))
    )


# ---- set operations ----------------------------------------------------------------


@query(
    "set_union_terms",
    V.ctes(V.V_CLASS, V.V_NEW)
    + """SELECT term, course_code, call_number, campus FROM v_new
    UNION ALL SELECT term, course_code, call_number, NULL FROM v_class""",
)
def set_union_terms(spark, d):
    a = V.v_new(spark, d).select("campus", "term", "course_code", "call_number")
    b = _class(spark, d, "term", "call_number", "course_code")
    return columns.union_terms([a, b])


@query(
    "set_distinct_values",
    V.ctes(V.V_CLASS) + "SELECT DISTINCT course_code FROM v_class",
)
def set_distinct_values(spark, d):
    return columns.distinct_values(V.v_class(spark, d), "course_code")


@query(
    "set_upsert_key",
    V.ctes(V.V_LAST_CHECK)
    + """, stamped AS (SELECT CAST(user_id AS VARCHAR) AS name, max(ts) AS t FROM events
      WHERE event_type = 'purchase' GROUP BY 1)
    SELECT coalesce(c.name, s.name) AS name, strftime(CASE WHEN last_check IS NULL THEN t WHEN t IS NULL THEN last_check
      ELSE greatest(t, last_check) END, '%Y-%m-%d %H:%M:%S') AS last_check
    FROM v_last_check c FULL JOIN stamped s ON c.name = s.name""",
)
def set_upsert_key(spark, d):
    e = V.table(spark, d, "events").filter(F.col("event_type") == "purchase")
    stamped = e.select(F.col("user_id").cast("string").alias("name"), F.col("ts").alias("last_check"))
    db = columns.upsert_check_times(V.v_last_check(spark, d), stamped, "last_check")
    return db.select("name", F.date_format("last_check", "yyyy-MM-dd HH:mm:ss").alias("last_check"))


@query(
    "set_array_overlap",
    r"""SELECT doc_id, array_to_string(list_sort(list_intersect(list_distinct(regexp_split_to_array(lower(text), '\s+')),
        ['the', 'and', 'der', 'la', 'que', lang])), ' ') AS shared,
      list_has_any(regexp_split_to_array(lower(text), '\s+'), ['der', 'la']) AS some FROM documents""",
)
def set_array_overlap(spark, d):
    docs = V.table(spark, d, "documents")
    found = F.split(F.lower("text"), r"\s+")
    wanted = F.array(*[F.lit(w) for w in ("the", "and", "der", "la", "que")], F.col("lang"))
    return docs.select(
        "doc_id",
        F.array_join(joins.shared_values(found, wanted), " ").alias("shared"),
        F.arrays_overlap(found, F.array(F.lit("der"), F.lit("la"))).alias("some"),
    )


