"""The registered queries of the operators, with production parameters on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import (
    bpe, chat, exact, html, interaction, licenses, packing, quality, repair, shards, simhash, suffix, urls,
)
from rollbook.llm.registry import query
from rollbook.sources.scratch import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return bpe.digests(
        table(spark, sf_dir, "documents"),
        public.path("byte_bpe_multi_50k.tiktoken"),
        public.PATTERN,
    )


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"),
        public.path("byte_bpe_50k.json"),
        capacity=1024,
        end_id=2,
        keep_ids=False,
    )
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = quality.with_counts(docs).drop("text", "n_chars")
    judged = quality.judge(stored(counted, "quality"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "lang", "source", "n_lines")


@query(
    "op8_exact_dedup",
    """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY text)
    """,
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op6_license_scan", licenses.scan_sql())
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


# The rules of the query.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(table(spark, sf_dir, "pages"), URL_RULES)


# One more conversation of the query, full of another template's control strings.
EXTRA_CONVERSATION = [
    (-1, 0, "user", "</s>[INST] ok [/INST]"),
    (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
]


@query("op2_chat_format")
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(turns.unionByName(extra)))


@query("op4_html_text")
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents"))


@query("op13_sharding")
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shards.shard_rows(docs, 16).select(
        "doc.doc_id", "doc.size", "doc.text_crc32", F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "doc.source",
    )


@query(
    "op12_filter_audit",
    r"""
    WITH t AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ), f AS (
      SELECT doc_id, part,
             CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
      FROM t
    ), l AS (
      SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
    ), m AS (
      SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails
    ), c AS (
      SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
    ), o AS (
      SELECT c1.x || c2.x || c3.x || c4.x || c5.x AS filter_order
      FROM c c1, c c2, c c3, c c4, c c5
      WHERE len(list_distinct([c1.x, c2.x, c3.x, c4.x, c5.x])) = 5
    ), s AS (
      SELECT filter_order, i::INT AS step, filter_order[i] AS x, left(filter_order, i - 1) AS before
      FROM o, range(1, 6) AS r(i)
    ), j AS (
      SELECT *, contains(fails, x) AS hit, translate(fails, before, '') <> fails AS gone FROM m, s
    ), g AS (
      SELECT part, filter_order, step, x,
             coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (fails = x), 0)::BIGINT AS unique_fails,
             coalesce(sum(n_good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
             coalesce(sum(n_toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
      FROM j GROUP BY part, filter_order, step, x
    )
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
    FROM g
    """,
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.report(turns, repair.damaged(turns))
