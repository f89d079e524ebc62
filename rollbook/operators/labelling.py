"""Applying annotation answers to search results, and counting labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IRRELEVANT, POSSIBLE, RELEVANT = 0, 1, 2


def answer_labels(answer: Column, n_results: Column) -> Column:
    """Answer text -> struct(valid, labels): one label per result.

    'n' nothing fits; 'p' / 'm' the only result is possible / a match; 'mK' result K is
    the match; 'i,j' these are possible. Everything else is rejected.
    """
    parts = F.transform(F.split(answer, ","), lambda a: F.trim(a))
    first = F.get(parts, F.lit(0))
    alone = F.size(parts) == 1
    picked = F.transform(parts, lambda a: F.when(a.rlike(r"^\d+$"), a.try_cast("int")))
    all_picked = F.forall(picked, lambda i: i.isNotNull() & (i < n_results))
    match = F.when(first.rlike(r"^m\d+$"), F.regexp_extract(first, r"^m(\d+)$", 1).try_cast("int"))
    only = alone & first.isin("p", "m") & (n_results == 1)
    one = alone & F.coalesce(match < n_results, F.lit(False))
    none = alone & (first == "n")
    places = F.when(n_results > 0, F.sequence(F.lit(0), n_results - 1)).otherwise(
        F.array().cast("array<int>")
    )

    def label(i: Column) -> Column:
        return (
            F.when(none, IRRELEVANT)
            .when(only, F.when(first == "m", RELEVANT).otherwise(POSSIBLE))
            .when(one, F.when(i == match, RELEVANT).otherwise(IRRELEVANT))
            .when(F.array_contains(picked, i), POSSIBLE)
            .otherwise(IRRELEVANT)
        )

    valid = F.coalesce(none | only | one | all_picked, F.lit(False))
    return F.struct(valid.alias("valid"), F.transform(places, label).alias("labels"))


def apply_answers(
    df: DataFrame,
    results: str,
    answer: str,
    rule: Callable[[Column, Column], Column] = answer_labels,
    only_missing: bool = True,
) -> DataFrame:
    """Add `valid` and write the labels into the result structs of valid rows.

    `rule` gives struct(valid, labels) of an answer and the number of results. Labels that are
    there already stay, unless `only_missing` is off.
    """
    judged = df.withColumn("_judged", rule(F.col(answer), F.size(results)))
    old = lambda r: r["label"] if only_missing else F.lit(None)
    labelled = F.transform(
        F.arrays_zip(F.col(results).alias("r"), F.col("_judged.labels").alias("l")),
        lambda z: z["r"].withField("label", F.coalesce(old(z["r"]), z["l"])),
    )
    return (
        judged.withColumn("valid", F.col("_judged.valid"))
        .withColumn(results, F.when(F.col("valid"), labelled))
        .drop("_judged")
    )


def article_label(answer: Column) -> Column:
    """'y' -> 1, 'n' -> 0 in any case, other answers null."""
    a = F.lower(answer)
    return F.when(a == "y", 1).when(a == "n", 0)


def search_label_stats(df: DataFrame, results: str) -> DataFrame:
    """queries, results and results per label; counts inside the row, no explode."""

    def having(k: int) -> Column:
        return F.coalesce(
            F.sum(F.size(F.filter(results, lambda r: r["label"] == k))), F.lit(0)
        ).cast("bigint")

    return df.agg(
        F.count("*").alias("queries"),
        F.coalesce(F.sum(F.size(results)), F.lit(0)).cast("bigint").alias("results"),
        having(IRRELEVANT).alias("irrelevant"),
        having(POSSIBLE).alias("possible"),
        having(RELEVANT).alias("relevant"),
    )


def article_label_stats(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(label) > 0).alias("relevant"),
        F.count_if(F.col(label) == 0).alias("irrelevant"),
    )
