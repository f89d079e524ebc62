"""Scalar functions on the views, each over the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollbook.functions import names as N
from rollbook.functions import terms, text, urls, vectors
from rollbook.functions.stems import stem_sql, word_tokens_sql
from rollbook.operators import features
from rollbook.plans import views as V
from rollbook.plans.q_tables import match_sql, ordered_sql, tokens_sql
from rollbook.plans.registry import query

_TERM_TEXT = "upper(split_part(term, '-', 2)) || split_part(term, '-', 1)"


def _term_text():
    return F.concat(F.upper(F.substring_index("term", "-", -1)), F.substring_index("term", "-", 1))


@query(
    "fn_split_term",
    V.ctes(V.V_CLASS)
    + """SELECT call_number, split_part(term, '-', 2) AS month, split_part(term, '-', 1) AS year FROM v_class""",
)
def fn_split_term(spark, d):
    return V.v_class(spark, d).select("call_number", terms.split_term(_term_text()).alias("t")).select(
        "call_number", "t.month", "t.year"
    )


@query("fn_normalize_term", V.ctes(V.V_CLASS) + "SELECT call_number, term FROM v_class")
def fn_normalize_term(spark, d):
    return V.v_class(spark, d).select("call_number", terms.normalize_term(_term_text()).alias("term"))


@query(
    "fn_term_end_date",
    V.ctes(V.V_CLASS)
    + """SELECT call_number, term, split_part(term, '-', 1) || CASE split_part(term, '-', 2) WHEN 'Spring' THEN '-05-20'
      WHEN 'Summer' THEN '-08-20' WHEN 'Fall' THEN '-12-26' END AS ends FROM v_class""",
)
def fn_term_end_date(spark, d):
    return V.v_class(spark, d).select(
        "call_number", "term", terms.term_end_date(F.col("term")).cast("string").alias("ends")
    )


@query(
    "fn_listing_url",
    """SELECT p_partkey, upper(split_part(p_name, ' ', 1)) || '_' || p_brand AS department_code,
      'Fall' || (2000 + p_size) AS term_text FROM part""",
)
def fn_listing_url(spark, d):
    url = F.concat(
        F.lit("https://dir.example.org/sel/"),
        F.upper(F.substring_index("p_name", " ", 1)),
        F.lit("_"),
        "p_brand",
        F.lit("_Fall"),
        (F.col("p_size") + 2000).cast("string"),
        F.lit(".html"),
    )
    return V.table(spark, d, "part").select("p_partkey", urls.listing_parts(url).alias("u")).select(
        "p_partkey", "u.department_code", "u.term_text"
    )


@query(
    "fn_url_tail",
    """SELECT page_id, l[len(l)] AS class_id, l[len(l) - 1] AS department_code
    FROM (SELECT page_id, list_filter(string_split(url, '/'), lambda x: x <> '') AS l FROM pages)""",
)
def fn_url_tail(spark, d):
    return V.table(spark, d, "pages").select("page_id", urls.url_tail(F.col("url")).alias("u")).select(
        "page_id", "u.class_id", "u.department_code"
    )


@query(
    "fn_url_join",
    r"""WITH b AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+:') AS scheme,
        regexp_extract(url, '^[a-z]+://[^/]*') AS root, regexp_extract(url, '^[a-z]+://[^/]*/([^?#]*/)?') AS dir FROM pages)
    SELECT page_id, 'absolute' AS kind, 'https://other.example.org/x' AS link FROM b
    UNION ALL SELECT page_id, 'host', scheme || '//cdn.example.org/y?z=1' FROM b
    UNION ALL SELECT page_id, 'path', root || '/a/c' FROM b
    UNION ALL SELECT page_id, 'relative', dir || 'next/p.html#top' FROM b
    UNION ALL SELECT page_id, 'up', root || '/q' FROM b""",
)
def fn_url_join(spark, d):
    hrefs = {
        "absolute": "https://other.example.org/x",
        "host": "//cdn.example.org/y?z=1",
        "path": "/a/./b/../c",
        "relative": "next/p.html#top",
        "up": "../../q",
    }
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(h).alias("href")) for k, h in hrefs.items()])
    rows = V.table(spark, d, "pages").select("page_id", "url", F.inline(kinds))
    return rows.select("page_id", "kind", urls.url_join(F.col("url"), F.col("href")).alias("link"))


@query(
    "fn_course_code",
    "SELECT p_partkey, p_brand || ' ' || CASE WHEN p_size > 5 THEN p_size::VARCHAR END AS code FROM part",
)
def fn_course_code(spark, d):
    number = F.when(F.col("p_size") > 5, F.col("p_size").cast("string"))
    return V.table(spark, d, "part").select(
        "p_partkey", text.course_code(F.col("p_brand"), number).alias("code")
    )


@query("fn_clean_instructor", "SELECT c_custkey, c_name AS name FROM customer")
def fn_clean_instructor(spark, d):
    raw = F.concat("c_name", F.lit(" - - \n e-mail, "), "c_mktsegment")
    return V.table(spark, d, "customer").select("c_custkey", text.clean_instructor(raw).alias("name"))


@query(
    "fn_schedule",
    V.ctes(V.V_CLASS) + "SELECT call_number, days, t_start AS start, t_end AS finish, room AS location FROM v_class",
)
def fn_schedule(spark, d):
    s = V.v_class(spark, d).select("call_number", text.schedule(F.col("schedule_text")).alias("s"))
    return s.select("call_number", "s.days", "s.start", F.col("s.end").alias("finish"), "s.location")


@query(
    "fn_split_strip_list",
    """SELECT p_partkey, p_name || '|' || p_brand || '|' || p_type AS parts FROM part""",
)
def fn_split_strip_list(spark, d):
    raw = F.concat("p_name", F.lit(" ,  "), "p_brand", F.lit(",\t"), "p_type", F.lit(" "))
    return V.table(spark, d, "part").select(
        "p_partkey", F.array_join(text.split_strip_list(raw), "|").alias("parts")
    )


@query(
    "fn_parse_enrollment",
    V.ctes(V.V_CLASS)
    + """SELECT call_number, CAST(seen_on AS VARCHAR) AS seen, seats AS cur, CASE WHEN line <> 7 THEN 50 END AS max
    FROM v_class""",
)
def fn_parse_enrollment(spark, d):
    e = V.v_class(spark, d).select(
        "call_number", terms.parse_enrollment(F.col("enrollment_text")).alias("e")
    )
    return e.select("call_number", F.col("e.date").cast("string").alias("seen"), "e.cur", "e.max")


@query(
    "fn_enrollment_map",
    V.ctes(V.V_CLASS)
    + """SELECT call_number, CAST(seen_on AS VARCHAR) || '=' || seats || '/' || CASE WHEN line <> 7 THEN '50' ELSE '?' END
      AS history FROM v_class""",
)
def fn_enrollment_map(spark, d):
    e = V.v_class(spark, d).select(
        "call_number", terms.parse_enrollment(F.col("enrollment_text")).alias("e")
    )
    history = terms.enrollment_map(F.col("e.date"), F.col("e.cur"), F.col("e.max"))
    return e.select("call_number", terms.map_text(history).alias("history"))


def _description():
    """Course text with codes joined by 'or', 'and' and words that contain them."""
    four = F.upper(F.substring("p_type", 1, 4))
    key = F.col("p_partkey")

    def code(shift: int):
        number = F.lpad(((key + shift) % 10000).cast("string"), 4, "0")
        return F.concat(four, F.lit(" W"), number)

    joiner = (
        F.when(F.col("p_size") % 4 == 0, ") or (")
        .when(F.col("p_size") % 4 == 1, ") and (")
        .when(F.col("p_size") % 4 == 2, ") needed for (")
        .otherwise("), standing, (")
    )
    return F.concat(
        F.lit("Or Prerequisites: ("), code(0), joiner, code(1), joiner, code(2), F.lit(") for and.")
    )


@query(
    "fn_prerequisites",
    f"""WITH t AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN ') or (' WHEN 1 THEN ') and (' WHEN 2 THEN ') needed for ('
        ELSE '), standing, (' END AS j, p_partkey AS k, upper(substr(p_type, 1, 4)) || ' W' AS w FROM part),
    s AS (SELECT p_partkey, 'Or Prerequisites: (' || w || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') || j
        || w || lpad(CAST((k + 1) % 10000 AS VARCHAR), 4, '0') || j || w || lpad(CAST((k + 2) % 10000 AS VARCHAR), 4, '0')
        || ') for and.' AS descr FROM t),
    m AS (SELECT p_partkey, regexp_extract_all(descr,
        '([A-Z]{{4}} [A-Z][A-Z]?[0-9]{{4}}|[A-Z][A-Z]?[0-9]{{4}}|[oO][rR]|[aA][nN][dD])') AS l FROM s),
    u AS (SELECT p_partkey, unnest(l) AS tok, generate_subscripts(l, 1) AS i FROM m),
    f AS (SELECT *, lower(tok) NOT IN ('or', 'and') AS is_code,
        lower(lag(tok) OVER (PARTITION BY p_partkey ORDER BY i)) AS before FROM u),
    n AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY i) AS c FROM f WHERE is_code),
    g AS (SELECT *, sum(CASE WHEN before = 'or' AND c > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY p_partkey ORDER BY i) AS grp
      FROM n),
    j AS (SELECT p_partkey, grp, string_agg(tok, '|' ORDER BY i) AS ors FROM g GROUP BY ALL)
    SELECT p_partkey, string_agg(ors, '&' ORDER BY grp) AS needs FROM j GROUP BY 1""",
)
def fn_prerequisites(spark, d):
    groups = text.prerequisites(_description())
    needs = F.array_join(F.transform(groups, lambda g: F.array_join(g, "|")), "&")
    return V.table(spark, d, "part").select("p_partkey", needs.alias("needs"))


_MAPS = """SELECT term, call_number, CAST(seen_on AS VARCHAR) AS a, CAST(seen_on + (line % 2) AS VARCHAR) AS b,
    CAST(seats AS VARCHAR) AS v FROM v_class"""


@query(
    "fn_map_overlay",
    V.ctes(V.V_CLASS)
    + f"""SELECT call_number, CASE WHEN a = b THEN a || '=old' ELSE a || '=old;' || b || '=' || v END AS history
    FROM ({_MAPS})""",
)
def fn_map_overlay(spark, d):
    a = F.col("seen_on").cast("string")
    b = F.date_add("seen_on", F.col("line") % 2).cast("string")
    old, new = F.create_map(a, F.lit("old")), F.create_map(b, F.col("seats").cast("string"))
    return V.v_class(spark, d).select(
        "call_number", terms.map_text(terms.map_overlay(new, old)).alias("history")
    )


@query(
    "fn_map_cutoff",
    V.ctes(V.V_CLASS)
    + """, e AS (SELECT call_number, seen_on AS a, seen_on - 60 AS b, CAST(split_part(term, '-', 1) ||
        CASE split_part(term, '-', 2) WHEN 'Spring' THEN '-05-20' WHEN 'Summer' THEN '-08-20' ELSE '-12-26' END AS DATE) AS stop
      FROM v_class)
    SELECT call_number, CASE WHEN a <= stop THEN CAST(b AS VARCHAR) || '=early;' || CAST(a AS VARCHAR) || '=late'
      ELSE CAST(b AS VARCHAR) || '=early' END AS history FROM e""",
)
def fn_map_cutoff(spark, d):
    late, early = F.col("seen_on").cast("string"), F.date_sub("seen_on", 60).cast("string")
    history = F.create_map(late, F.lit("late"), early, F.lit("early"))
    cut = terms.map_cutoff(history, terms.term_end_date(F.col("term")))
    return V.v_class(spark, d).select("call_number", terms.map_text(cut).alias("history"))


@query(
    "fn_flatten_join",
    """SELECT p_partkey, array_to_string(list_sort([p_name, p_brand, p_type]), chr(10)) AS flat,
      array_to_string(list_sort(list_concat(string_split(p_name, ' '), [p_type, p_brand])), chr(10)) AS nested,
      array_to_string(list_sort([p_type, p_brand]), ' ') || chr(10) || array_to_string(list_sort([p_name, p_brand]), ' ') AS pairs
    FROM part""",
)
def fn_flatten_join(spark, d):
    nested = F.array(F.split("p_name", " "), F.array("p_type", "p_brand"))
    pairs = F.array(
        F.struct(F.col("p_type").alias("a"), F.col("p_brand").alias("b")),
        F.struct(F.col("p_name").alias("a"), F.col("p_brand").alias("b")),
    )
    return V.table(spark, d, "part").select(
        "p_partkey",
        text.flatten_join(F.array("p_name", "p_brand", "p_type")).alias("flat"),
        text.flatten_join(nested, nested=True).alias("nested"),
        text.join_pairs(pairs, ["a", "b"]).alias("pairs"),
    )


@query(
    "fn_wiki_link",
    """SELECT c_custkey, 'https://en.wikipedia.org/wiki/' || replace(url_encode(replace(
      c_name || ' (' || c_mktsegment || ')*~é', ' ', '_')), '%20', '+') AS link FROM customer""",
)
def fn_wiki_link(spark, d):
    title = F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")*~é"))
    return V.table(spark, d, "customer").select("c_custkey", urls.article_link(title).alias("link"))


@query(
    "fn_query_url",
    """SELECT doc_id, 'https://api.example.org/w/api.php?q=' || replace(url_encode('University intitle:' || source || ' ' || text), '%20', '+') || '&redirects=' AS link FROM documents""",
)
def fn_query_url(spark, d):
    value = F.concat("source", F.lit(" "), "text")
    link = urls.query_url(
        "https://api.example.org/w/api.php?q=", value, "&redirects=", "University intitle:"
    )
    return V.table(spark, d, "documents").select("doc_id", link.alias("link"))


@query(
    "fn_remove_tags",
    "SELECT page_id, length(t) AS n, md5(t) AS digest FROM (SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS t FROM pages)",
)
def fn_remove_tags(spark, d):
    t = text.remove_tags(F.col("html"))
    return V.table(spark, d, "pages").select("page_id", F.length(t).alias("n"), F.md5(t).alias("digest"))


@query(
    "fn_digits_int",
    """SELECT e.event_id, coalesce(try_cast(regexp_replace(props, '[^0-9]', '', 'g') AS BIGINT), 0) AS n,
      coalesce(try_cast(regexp_replace(event_type, '[^0-9]', '', 'g') AS BIGINT), 0) AS none FROM events e""",
)
def fn_digits_int(spark, d):
    return V.table(spark, d, "events").select(
        "event_id",
        text.digits_int(F.col("props")).alias("n"),
        text.digits_int(F.col("event_type")).alias("none"),
    )


@query(
    "fn_parse_date_long",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders",
)
def fn_parse_date_long(spark, d):
    written = F.when(
        F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "MMMM d, yyyy")
    ).otherwise("some day")
    return V.table(spark, d, "orders").select(
        "o_orderkey", terms.parse_date_long(written).cast("string").alias("day")
    )


@query(
    "fn_split_at_marker",
    r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    m AS (SELECT doc_id, CASE WHEN len(lines) % 3 = 0 THEN lines
        ELSE list_concat(list_concat(lines[1:2], ['Workload:']), lines[3:]) END AS x FROM l),
    p AS (SELECT doc_id, x, coalesce(list_position(x, 'Workload:'), 0) AS pos FROM m)
    SELECT doc_id, md5(CASE WHEN pos > 0 THEN array_to_string(x[1:pos - 1], chr(10)) ELSE array_to_string(x, chr(10)) END) AS body,
      CASE WHEN pos > 0 THEN md5(array_to_string(x[pos + 1:], chr(10))) END AS workload FROM p""",
)
def fn_split_at_marker(spark, d):
    lines = F.split("text", "\n")
    marked = F.when(F.size(lines) % 3 == 0, lines).otherwise(
        F.concat(F.slice(lines, 1, 2), F.array(F.lit("Workload:")), F.slice(lines, F.lit(3), F.size(lines)))
    )
    parts = text.split_at_marker(marked)
    return V.table(spark, d, "documents").select(
        "doc_id", F.md5(parts["text"]).alias("body"), F.md5(parts["workload"]).alias("workload")
    )


@query(
    "fn_badge",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 1 THEN 'gold' WHEN p_size % 3 = 2 THEN 'silver' END AS badge FROM part""",
)
def fn_badge(spark, d):
    said = (
        F.when(F.col("p_size") % 3 == 1, " earned a Gold nugget")
        .when(F.col("p_size") % 3 == 2, " earned gold and Silver nuggets")
        .otherwise(" earned nothing")
    )
    return V.table(spark, d, "part").select(
        "p_partkey", text.badge(F.concat("p_name", said)).alias("badge")
    )


@query(
    "fn_award_line",
    """SELECT p_partkey, CASE WHEN p_size % 3 <> 0 AND p_size % 7 <> 0 THEN 1990 + p_size END AS year,
      CASE WHEN p_size % 3 <> 0 THEN p_name END AS name FROM part""",
)
def fn_award_line(spark, d):
    size = F.col("p_size")
    year = F.when(size % 7 == 0, "about ").otherwise((size + 1990).cast("string"))
    line = F.when(size % 3 == 0, F.concat(year, F.lit(" - "), "p_name")).otherwise(
        F.concat(year, F.lit(" -  "), "p_name", F.lit(", "), "p_type")
    )
    a = V.table(spark, d, "part").select("p_partkey", text.award_line(line).alias("a"))
    return a.select("p_partkey", "a.year", "a.name")


@query(
    "fn_drop_initials",
    """SELECT p_partkey, p_name AS short FROM part""",
)
def fn_drop_initials(spark, d):
    parts = F.split("p_name", " ")
    full = F.concat(F.get(parts, F.lit(0)), F.lit(" X  y "), F.get(parts, F.lit(1)), F.lit(" z"))
    return V.table(spark, d, "part").select("p_partkey", text.drop_initials(full).alias("short"))


@query(
    "fn_name_order",
    V.ctes(V.V_NAME) + f"SELECT name, {ordered_sql('foreign_name')} AS ordered FROM v_name",
)
def fn_name_order(spark, d):
    return V.v_name(spark, d).select("name", N.name_order(F.col("foreign")).alias("ordered"))


@query(
    "fn_name_tokens",
    r"""SELECT doc_id, md5(array_to_string(list_transform(list_filter(
      regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]'), lambda x: length(x) > 1), lambda x: replace(strip_accents(x), 'ß', 'ss')), ' ')) AS parts
    FROM documents""",
)
def fn_name_tokens(spark, d):
    return V.table(spark, d, "documents").select(
        "doc_id", F.md5(F.array_join(N.name_tokens(F.col("text")), " ")).alias("parts")
    )


@query(
    "fn_str_similarity",
    V.ctes(V.V_NAME)
    + """SELECT name, foreign_name AS other, round(jaro_winkler_similarity(lower(name), lower(foreign_name)), 6) AS similarity
    FROM v_name""",
)
def fn_str_similarity(spark, d):
    similarity = N.str_similarity(F.col("name"), F.col("foreign"))
    return V.v_name(spark, d).select(
        "name", F.col("foreign").alias("other"), F.round(similarity, 6).alias("similarity")
    )


@query(
    "fn_words_match2",
    f"""WITH q AS (SELECT DISTINCT p_name AS name, split_part(p_name, ' ', 2) || ', ' || lower(p_type) AS other FROM part),
    t AS (SELECT *, {tokens_sql("name")} AS ct, {tokens_sql(ordered_sql("other"))} AS ft,
      lower({ordered_sql("other")}) AS fw FROM q)
    SELECT name, other, {match_sql("ct", "ft", "lower(name)", "fw")} AS same FROM t""",
)
def fn_words_match2(spark, d):
    p = V.table(spark, d, "part")
    other = F.concat(F.substring_index("p_name", " ", -1), F.lit(", "), F.lower("p_type"))
    pairs = p.select(F.col("p_name").alias("name"), other.alias("other")).distinct()
    return pairs.withColumn("same", N.words_match2(F.col("name"), F.col("other")))


def _texts(spark, d):
    return V.table(spark, d, "part").select(
        "p_partkey",
        F.concat_ws(" ", "p_name", F.lower("p_type"), "p_name").alias("a"),
        F.concat_ws(" ", "p_type", "p_name").alias("b"),
    )


_TEXTS = """t AS (SELECT p_partkey, p_name || ' ' || lower(p_type) || ' ' || p_name AS a, p_type || ' ' || p_name AS b FROM part),
w AS (SELECT *, string_split(lower(a), ' ') AS wa, string_split(lower(b), ' ') AS wb FROM t),
o AS (SELECT *, list_sum(list_transform(list_intersect(list_distinct(wa), list_distinct(wb)), lambda x: least(
  len(list_filter(wa, lambda y: y = x)), len(list_filter(wb, lambda y: y = x))))) AS common FROM w)"""


@query(
    "fn_levenshtein_sim",
    V.ctes(_TEXTS)
    + "SELECT p_partkey, round(1.0 - levenshtein(a, b) / greatest(length(a), length(b))::DOUBLE, 6) AS similarity FROM t",
)
def fn_levenshtein_sim(spark, d):
    s = text.levenshtein_similarity(F.col("a"), F.col("b"))
    return _texts(spark, d).select("p_partkey", F.round(s, 6).alias("similarity"))


@query(
    "fn_jaccard_words",
    V.ctes(_TEXTS) + "SELECT p_partkey, round(common::DOUBLE / (len(wa) + len(wb) - common), 6) AS similarity FROM o",
)
def fn_jaccard_words(spark, d):
    s = text.jaccard_words(F.col("a"), F.col("b"))
    return _texts(spark, d).select("p_partkey", F.round(s, 6).alias("similarity"))


@query(
    "fn_sorensen_words",
    V.ctes(_TEXTS) + "SELECT p_partkey, round(2.0 * common::DOUBLE / (len(wa) + len(wb)), 6) AS similarity FROM o",
)
def fn_sorensen_words(spark, d):
    s = text.sorensen_words(F.col("a"), F.col("b"))
    return _texts(spark, d).select("p_partkey", F.round(s, 6).alias("similarity"))


@query(
    "fn_label_binarize",
    """SELECT vec_id, (label % 3 = 0)::INT AS is_0, (label % 3 = 1)::INT AS is_1, (label % 3 = 2)::INT AS is_2
    FROM embeddings""",
)
def fn_label_binarize(spark, d):
    bits = vectors.label_binarize(F.col("y"), [0, 1, 2])
    return V.v_score(spark, d).select(
        "vec_id", *[F.get(bits, F.lit(i)).alias(f"is_{i}") for i in range(3)]
    )


@query(
    "fn_dict_vector",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN k ELSE -1 END || ',' || CASE WHEN event_type = 'error' THEN k ELSE -1 END
      || ',' || CASE WHEN event_type = 'view' THEN k ELSE -1 END AS vec
    FROM (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
)
def fn_dict_vector(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    vec = vectors.dict_vector(F.create_map("event_type", k), ["view", "click", "error"], absent=-1)
    return V.table(spark, d, "events").select(
        "event_id", F.array_join(vec.cast("array<string>"), ",").alias("vec")
    )


@query(
    "fn_word_stems",
    "WITH words AS (SELECT DISTINCT word FROM (SELECT unnest("
    + word_tokens_sql("text")
    + ") AS word FROM documents)),\n"
    + stem_sql("words")
    + " SELECT word, stem FROM stems",
)
def fn_word_stems(spark, d):
    """Stem of every distinct word of the documents that is no stop word."""
    return features.stem_table(features.word_rows(V.table(spark, d, "documents"), "doc_id", "text", True))


@query(
    "fn_softmax_argmax",
    V.ctes(V.V_SCORE)
    + """SELECT vec_id, round(pa, 6) AS p0, round(pb, 6) AS p1, round(pc, 6) AS p2,
      CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS predicted FROM v_score""",
)
def fn_softmax_argmax(spark, d):
    p = V.v_score(spark, d).withColumn("p", vectors.softmax(F.col("logits")))
    return p.select(
        "vec_id",
        *[F.round(F.get("p", F.lit(i)), 6).alias(f"p{i}") for i in range(3)],
        vectors.argmax(F.col("p")).alias("predicted"),
    )
