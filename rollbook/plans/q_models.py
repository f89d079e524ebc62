"""Features, labelling and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollbook.functions.stems import stem_sql, word_tokens_sql
from rollbook.operators import evaluate, features, labelling, models
from rollbook.plans import views as V
from rollbook.plans.q_sources import _results
from rollbook.plans.q_tables import match_sql, ordered_sql, tokens_sql
from rollbook.plans.registry import query
from rollbook.sources.scratch import scratch_dir


@query(
    "ml_flatten_results",
    V.ctes(V.V_RESULT)
    + """SELECT 'person ' || query AS name, 'dep' AS department, rank, title, md5(snippet) AS digest, label AS labels
    FROM v_result""",
)
def ml_flatten_results(spark, d):
    flat = features.flatten_results(_results(spark, d))
    return flat.select("name", "department", "rank", "title", F.md5("snippet").alias("digest"), "labels")


_INPUT = f"""q AS (SELECT p_partkey, p_name AS name, p_type AS department, split_part(p_name, ' ', 2) || ', ' || lower(p_type) AS title,
  p_brand AS page FROM part),
t AS (SELECT *, {tokens_sql("name")} AS ct, {tokens_sql(ordered_sql("title"))} AS ft, lower({ordered_sql("title")}) AS fw FROM q)"""


@query(
    "ml_input_text",
    V.ctes(_INPUT)
    + f"""SELECT p_partkey, name || ' from departments of' || department || '[SEP]' || title || '[SEP]' || page AS search,
      name || ' [SEP] ' || department || ' [SEP] ' || CASE WHEN {match_sql("ct", "ft", "lower(name)", "fw")} THEN 'Yes' ELSE 'No' END
      || ' [SEP] ' || title || ' [SEP] ' || page AS article FROM t""",
)
def ml_input_text(spark, d):
    title = F.concat(F.substring_index("p_name", " ", -1), F.lit(", "), F.lower("p_type"))
    name, dep, page = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    return V.table(spark, d, "part").select(
        "p_partkey",
        features.search_input(name, dep, title, page).alias("search"),
        features.article_input(name, dep, title, page).alias("article"),
    )


_ANSWER = """CASE query % 7 WHEN 0 THEN 'n' WHEN 1 THEN 'm' WHEN 2 THEN 'm1' WHEN 3 THEN '0, 2' WHEN 4 THEN 'p' WHEN 5 THEN '1,m0'
  ELSE '9' END"""


def _answered(spark, d):
    query = F.substring_index("name", " ", -1).cast("int")
    given = F.array(*[F.lit(a) for a in ("n", "m", "m1", "0, 2", "p", "1,m0", "9")])
    blank = F.transform(
        "search_results", lambda r: r.withField("label", F.lit(None).cast("int"))
    )
    return (
        _results(spark, d)
        .withColumn("search_results", blank)
        .withColumn("answer", F.get(given, query % 7))
    )


_ANSWERED_SQL = f"""r AS (SELECT query, rank, count(*) OVER (PARTITION BY query) AS n, {_ANSWER} AS answer FROM v_result),
judged AS (SELECT *, CASE answer WHEN 'n' THEN true WHEN 'm' THEN n = 1 WHEN 'p' THEN n = 1 WHEN 'm1' THEN n > 1
    WHEN '0, 2' THEN n > 2 WHEN '9' THEN n > 9 ELSE false END AS valid FROM r),
given AS (SELECT *, CASE WHEN NOT valid THEN NULL WHEN answer = 'n' THEN 0 WHEN answer = 'm' THEN 2 WHEN answer = 'p' THEN 1
    WHEN answer = 'm1' THEN CASE WHEN rank = 1 THEN 2 ELSE 0 END
    WHEN answer = '0, 2' THEN CASE WHEN rank IN (0, 2) THEN 1 ELSE 0 END ELSE 0 END AS new_label FROM judged)"""


@query(
    "ml_apply_answers",
    V.ctes(V.V_RESULT, _ANSWERED_SQL)
    + "SELECT 'person ' || query AS name, rank, answer, new_label AS labels FROM given WHERE valid",
)
def ml_apply_answers(spark, d):
    done = labelling.apply_answers(_answered(spark, d), "search_results", "answer")
    valid = done.filter("valid")
    return valid.select("name", "answer", F.posexplode("search_results").alias("rank", "s")).select(
        "name", "rank", "answer", F.col("s.label").alias("labels")
    )


@query(
    "agg_label_stats",
    V.ctes(V.V_RESULT)
    + """SELECT count(DISTINCT query) AS queries, count(*) AS results, count_if(label = 0) AS irrelevant,
      count_if(label = 1) AS possible, count_if(label = 2) AS relevant FROM v_result""",
)
def agg_label_stats(spark, d):
    return labelling.search_label_stats(_results(spark, d), "search_results")


@query(
    "agg_label_stats_article",
    """SELECT count(*) AS total, count_if(quality > 0) AS relevant, count_if(quality = 0) AS irrelevant FROM labels""",
)
def agg_label_stats_article(spark, d):
    answered = V.table(spark, d, "labels").withColumn(
        "label", labelling.article_label(F.when(F.col("quality") == 1, "Y").otherwise("n"))
    )
    return labelling.article_label_stats(answered, "label")


@query(
    "ml_vocab_features",
    r"""WITH w AS (SELECT DISTINCT doc_id, unnest(list_filter(regexp_split_to_array(text, '[^\p{L}\p{N}_]+'), lambda x: x <> '')) AS word
      FROM documents),
    v AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS i FROM (SELECT DISTINCT word FROM w))
    SELECT doc_id, count(*) AS size, min(i) AS low, max(i) AS high, md5(string_agg(i::VARCHAR, ',' ORDER BY i)) AS indices
    FROM w JOIN v ON w.word = v.word GROUP BY 1""",
)
def ml_vocab_features(spark, d):
    words = features.word_rows(V.table(spark, d, "documents"), "doc_id", "text")
    f = features.vocabulary_features(words, "doc_id")
    return f.select(
        "doc_id", "size", F.array_min("indices").alias("low"), F.array_max("indices").alias("high"),
        F.md5(F.array_join(F.col("indices").cast("array<string>"), ",")).alias("indices"),
    )


@query(
    "ml_stem_overlap",
    f"""WITH own AS (SELECT p_name AS name, lower(p_type) AS text FROM part
      UNION SELECT p_name, text FROM benchmark JOIN part ON p_partkey = item_id + 1),
    cand AS (SELECT doc_id || ':' || p_name AS id, p_name AS name, text FROM documents JOIN part ON p_partkey = doc_id + 1),
    own_words AS (SELECT DISTINCT name, unnest({word_tokens_sql("text")}) AS word FROM own),
    cand_words AS (SELECT DISTINCT id, name, unnest({word_tokens_sql("text")}) AS word FROM cand),
    words AS (SELECT word FROM own_words UNION SELECT word FROM cand_words),
    {stem_sql("words")},
    own_stems AS (SELECT DISTINCT name, stem FROM own_words JOIN stems USING (word)),
    cand_stems AS (SELECT DISTINCT id, name, stem FROM cand_words JOIN stems USING (word)),
    shared AS (SELECT id, count(*) AS n, string_agg(stem, ' ' ORDER BY stem) AS overlap
      FROM cand_stems JOIN own_stems USING (name, stem) GROUP BY id)
    SELECT id, name, coalesce(n, 0)::INT AS shared, coalesce(overlap, '') AS overlap,
      round(jaro_winkler_similarity(lower(name), lower(name || ' x')), 6) AS name_similarity
    FROM cand LEFT JOIN shared USING (id)""",
)
def ml_stem_overlap(spark, d):
    """People are the part names; the document and the title of a person carry its key."""
    p, docs = V.table(spark, d, "part"), V.table(spark, d, "documents")
    people = p.select(F.col("p_name").alias("name"), F.lower("p_type").alias("department"))
    person = p.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))
    spoken = V.table(spark, d, "benchmark").withColumn("key", F.col("item_id") + 1)
    titles = spoken.join(person, "key").select("name", F.col("text").alias("title"))
    cand = docs.withColumn("key", F.col("doc_id") + 1).join(person, "key").select(
        F.concat_ws(":", "doc_id", "name").alias("id"), "name", F.concat("name", F.lit(" x")).alias("found"),
        F.col("text").alias("interests"),
    )
    out = features.stem_overlap(cand, people, titles)
    return out.select(
        "id", "name", F.size("overlap").alias("shared"), F.array_join("overlap", " ").alias("overlap"),
        F.round("name_similarity", 6).alias("name_similarity"),
    )


def _vectors(spark, d):
    e = V.table(spark, d, "embeddings").select("vec_id", "embedding", (F.col("label") % 3).cast("int").alias("label"))
    return models.with_vector(e, "embedding").drop("embedding")


def _train_test(df, key):
    part = F.pmod(F.xxhash64(key, F.lit(41)), F.lit(5))
    return df.filter(part != 0), df.filter(part == 0)


@query("ml_random_forest")
def ml_random_forest(spark, d):
    """Trained on four fifths; every vector is scored and the cells are counted."""
    df = _vectors(spark, d)
    train, _ = _train_test(df, "vec_id")
    scored = models.decide(models.random_forest(train).transform(df))
    return evaluate.confusion_matrix(scored, "label", "predicted", [0, 1, 2])


@query(
    "ml_gaussian_nb",
    """WITH e AS (SELECT vec_id, embedding, CAST(label % 3 AS INT) AS y, vec_id * 7919 % 10007 % 5 AS part FROM embeddings),
    x AS (SELECT vec_id, y, part, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS k FROM e),
    m AS (SELECT y AS c, k, count(*) AS n, sum(v) AS s, sum(v * v) AS q FROM x WHERE part <> 0 GROUP BY y, k),
    g AS (SELECT sum(q) / sum(n) - (sum(s) / sum(n)) ** 2 AS v FROM m GROUP BY k),
    p AS (SELECT c, k, s / n AS mean, q / n - (s / n) ** 2 + (SELECT max(v) * 1e-9 FROM g) AS var,
      ln(n / sum(n) OVER (PARTITION BY k)) AS prior FROM m),
    l AS (SELECT vec_id, y, c, max(prior) + sum(-0.5 * ln(2 * pi() * var) - (v - mean) ** 2 / (2 * var)) AS score
      FROM x JOIN p USING (k) GROUP BY vec_id, y, c),
    r AS (SELECT vec_id, y, arg_max(c, score) AS c FROM l GROUP BY vec_id, y)
    SELECT t.y, count(CASE WHEN c = 0 THEN 1 END) AS pred_0, count(CASE WHEN c = 1 THEN 1 END) AS pred_1,
      count(CASE WHEN c = 2 THEN 1 END) AS pred_2
    FROM (VALUES (0), (1), (2)) t(y) LEFT JOIN r ON r.y = t.y GROUP BY 1""",
)
def ml_gaussian_nb(spark, d):
    """Class moments of two halves of the training rows, added up; every vector is scored."""
    e = V.table(spark, d, "embeddings").select("vec_id", "embedding", (F.col("label") % 3).cast("int").alias("label"))
    train = e.filter(F.col("vec_id") * 7919 % 10007 % 5 != 0)
    halves = [models.class_moments(train.filter(F.col("vec_id") % 2 == k), "label", "embedding") for k in (0, 1)]
    model = models.moments_model(models.merge_moments(*halves))
    return evaluate.confusion_matrix(models.score_moments(e, model, "embedding"), "label", "predicted", [0, 1, 2])


@query("ml_one_vs_rest")
def ml_one_vs_rest(spark, d):
    """Scores per label, as precision and recall of the second label."""
    df = _vectors(spark, d)
    train, _ = _train_test(df, "vec_id")
    scored = models.score_one_vs_rest(models.one_vs_rest(train, [0, 1, 2]), df)
    pr = evaluate.pr_curve(scored, "score_1", F.col("label") == 1)
    return pr.select(*[F.round(c, 6).alias(c) for c in pr.columns])


def _labelled_docs(spark, d):
    docs = V.table(spark, d, "documents").select("doc_id", "text")
    return docs.join(V.table(spark, d, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")


@query("ml_weighted_classifier")
def ml_weighted_classifier(spark, d):
    df = _labelled_docs(spark, d)
    train, _ = _train_test(df, "doc_id")
    model = models.weighted_text_classifier(train, "text", "label", models.ARTICLE_WEIGHTS)
    report = evaluate.class_report(models.batch_infer(df, model), "label", "predicted")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("ml_batch_infer")
def ml_batch_infer(spark, d):
    """Every document scored with a model trained on the labelled ones."""
    df = _labelled_docs(spark, d)
    model = models.weighted_text_classifier(df, "text", "label", models.ARTICLE_WEIGHTS)
    docs = V.table(spark, d, "documents").select("doc_id", "text")
    return models.batch_infer(docs, model).select(
        "doc_id", "predicted", F.round(F.get("scores", F.lit(1)), 4).alias("score")
    )


@query("sink_model")
def sink_model(spark, d):
    """A saved and loaded model scores like the one in memory: the difference is zero."""
    df = _labelled_docs(spark, d)
    model = models.weighted_text_classifier(df, "text", "label", models.ARTICLE_WEIGHTS)
    path = scratch_dir(spark, "model")
    models.save_model(model, path)
    back = models.load_model(path)
    a = models.batch_infer(df, model).select("doc_id", "label", F.get("scores", F.lit(1)).alias("a"))
    b = models.batch_infer(df, back).select("doc_id", F.get("scores", F.lit(1)).alias("b"))
    return a.join(b, "doc_id").groupBy("label").agg(
        F.count("*").alias("n"), F.max(F.abs(F.col("a") - F.col("b"))).alias("difference")
    )
