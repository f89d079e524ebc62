"""Model inputs: flattened results, input texts, word features, stem overlap.

The corpus vocabulary is a table, never a driver-side list: word numbers come from the
two-level running count, so the vocabulary may outgrow any single machine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.names import str_similarity, words_match2
from rollbook.functions.stems import STOP_WORDS, stem_word, word_tokens
from rollbook.operators.ordered import running_totals
from rollbook.sources.scratch import stored

# Separators and clue words of the classifier inputs.
SEARCH_FROM, SEARCH_SEP = " from departments of", "[SEP]"
ARTICLE_SEP, CLUE_YES, CLUE_NO = " [SEP] ", "Yes", "No"


def flatten_results(df: DataFrame, results: str = "search_results") -> DataFrame:
    """One row per nested result with its rank, parent name and department."""
    item = F.col("_item")
    return df.select("name", "department", F.posexplode(results).alias("rank", "_item")).select(
        "name", "department", "rank", item["title"].alias("title"),
        item["snippet"].alias("snippet"), item["label"].alias("labels"),
    )


def search_input(name: Column, department: Column, title: Column, snippet: Column) -> Column:
    """Text the search classifier reads."""
    sep = F.lit(SEARCH_SEP)
    return F.concat(name, F.lit(SEARCH_FROM), department, sep, title, sep, snippet)


def article_input(name: Column, department: Column, title: Column, page: Column) -> Column:
    """Text the article classifier reads, with a clue whether name and title match."""
    clue = F.when(words_match2(name, title), CLUE_YES).otherwise(CLUE_NO)
    sep = F.lit(ARTICLE_SEP)
    return F.concat(name, sep, department, sep, clue, sep, title, sep, page)


def word_rows(df: DataFrame, key: str, text: str, remove_stop_words: bool = False) -> DataFrame:
    """Distinct (key, word) of a text column; repeats are dropped inside the row."""
    words = df.select(key, F.explode(F.array_distinct(word_tokens(F.col(text)))).alias("word"))
    return words.filter(~F.col("word").isin(*STOP_WORDS)) if remove_stop_words else words


def stem_table(words: DataFrame) -> DataFrame:
    """word -> stem for each distinct word, so a word is stemmed once.

    Few bytes and much work: a fixed number of tasks, which sizes alone would merge into one.
    """
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = words.select("word").distinct().repartition(parts, "word")
    return one.withColumn("stem", stem_word(F.col("word")))


def stem_rows(
    df: DataFrame, key: str, text: str, remove_stop_words: bool = False, prefix: str = ""
) -> DataFrame:
    """Distinct (key, stem) of a text column."""
    words = word_rows(df, key, text, remove_stop_words)
    stemmed = words.join(stem_table(words), "word")
    return stemmed.select(key, F.concat(F.lit(prefix), "stem").alias("stem")).distinct()


def vocabulary(words: DataFrame, word: str = "word") -> DataFrame:
    """(word, index): 0-based place of each distinct word in sorted order.

    Pieces are the first two code points of a word, so they are monotone in the word.
    """
    one = words.select(F.col(word).alias("word")).distinct()
    first, second = F.ascii("word"), F.ascii(F.substring("word", 2, 1))
    numbered = running_totals(
        one.withColumn("_bucket", first.cast("bigint") * F.lit(1 << 21) + second),
        [F.col("word")],
        {"index": F.lit(1).cast("bigint")},
    )
    return numbered.select("word", (F.col("index") - 1).alias("index"))


def vocabulary_features(words: DataFrame, key: str) -> DataFrame:
    """(key, indices, size): sparse presence vector of each text over the vocabulary."""
    vocab = vocabulary(words)
    placed = words.join(vocab, "word")
    return placed.groupBy(key).agg(
        F.array_sort(F.collect_list("index")).alias("indices"), F.count("*").alias("size")
    )


def stem_overlap(
    candidates: DataFrame, people: DataFrame, titles: DataFrame
) -> DataFrame:
    """Shared stems of a person's departments and class titles with a candidate's interests.

    `candidates`: id, name, found, interests (text). `people`: name, department.
    `titles`: name, title. All three may repeat names; stems meet in a join, so no list
    of a person's classes is ever built.
    """
    own = (
        people.select("name", F.col("department").alias("text"))
        .unionByName(titles.select("name", F.col("title").alias("text")))
        .distinct()
    )
    # few words and much text on the other side: only words whose stem some person has go further
    own_stems = stored(stem_rows(own, "name", "text", remove_stop_words=True), "stems")
    words = candidates.select(
        "id", "name", F.explode(F.array_distinct(word_tokens(F.col("interests")))).alias("word")
    ).where(~F.col("word").isin(*STOP_WORDS))
    known = stem_table(words).join(own_stems.select("stem").distinct(), "stem", "left_semi")
    shared = (
        words.join(stored(known, "known"), "word")
        .join(own_stems, ["name", "stem"])
        .groupBy("id")
        .agg(F.array_sort(F.collect_set("stem")).alias("overlap"))
    )
    pairs = candidates.select("name", "found").distinct()
    scored = pairs.withColumn("name_similarity", str_similarity(F.col("name"), F.col("found")))
    return (
        candidates.select("id", "name", "found")
        .join(shared, "id", "left")
        .withColumn("overlap", F.coalesce("overlap", F.array().cast("array<string>")))
        .join(scored, ["name", "found"])
    )
