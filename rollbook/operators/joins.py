"""Enrichment and update joins.

No join here is forced to broadcast: Spark broadcasts a side only below its own size
threshold, and AQE re-plans and splits skewed partitions at run time. The side that is
looked up is made unique first, so a hot key on the other side stays linear.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import split_strip_list
from rollbook.operators.columns import ensure_columns, rename_subset


def one_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last row per key by `order` (updates are applied one after the other)."""
    rest = [c for c in df.columns if c != key]
    last = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(key, "_last.*")


def enrich(
    classes: DataFrame,
    people: DataFrame,
    mapping: Mapping[str, str],
    on: tuple[str, str] = ("instructor", "name"),
    dedupe_right: bool = False,
) -> DataFrame:
    """Fill empty class fields from people; a value already there wins.

    `mapping` is person field -> class field. People are unique by name; pass
    `dedupe_right` where that is not given, or class rows multiply.
    """
    left_key, right_key = on
    right = rename_subset(people, {right_key: left_key, **mapping})
    if dedupe_right:
        right = one_per_key(right, left_key, list(mapping.values()))
    fills = {f: f"_right_{f}" for f in mapping.values()}
    types = dict(right.dtypes)
    left = ensure_columns(classes, {f: types[f] for f in fills})
    joined = left.join(right.withColumnsRenamed(fills), left_key, "left")
    return joined.select(
        *[F.coalesce(c, fills[c]).alias(c) if c in fills else F.col(c) for c in left.columns]
    )


def fill_gain(before: DataFrame, after: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Filled values per field before and after enrichment, one pass over each table."""

    def counts(df: DataFrame, stage: str) -> DataFrame:
        typed = ensure_columns(df, {f: "string" for f in fields})
        one = typed.agg(*[F.count(f).alias(f) for f in fields])
        return one.select(
            F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n")) for f in fields]))
        ).withColumn("stage", F.lit(stage))

    both = counts(before, "before").unionByName(counts(after, "after"))
    pick = {s: F.sum(F.when(F.col("stage") == s, F.col("n"))) for s in ("before", "after")}
    return both.groupBy("field").agg(
        pick["before"].alias("n_before"),
        pick["after"].alias("n_after"),
        (pick["after"] - pick["before"]).alias("gain"),
    )


def with_last_check(people: DataFrame, checks: DataFrame, key: str = "name") -> DataFrame:
    """People with their last check time, null when never checked."""
    return people.join(checks, key, "left")


def overlap_update(
    people: DataFrame, links: DataFrame, order: Sequence[str], target: str = "link"
) -> DataFrame:
    """Set `target` where the name is equal and the departments overlap.

    `links` has name, department (joined by '; ') and `target`. Of several links for one
    person the last by `order` wins; unmatched people keep their value.
    """
    departments = links.withColumn("_deps", F.split("department", "; "))
    matched = (
        departments.join(people.select("name", "departments"), "name")
        .filter(F.arrays_overlap("_deps", "departments"))
        .groupBy("name")
        .agg(F.max_by(target, F.struct(*order)).alias("_new"))
    )
    return (
        people.join(matched, "name", "left")
        .withColumn(target, F.coalesce("_new", target))
        .drop("_new")
    )


def equi_update(
    people: DataFrame, updates: DataFrame, fields: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Overwrite fields by name; a matched null clears the old value, the last update wins."""
    last = one_per_key(updates.select("name", *fields, *[o for o in order if o not in fields]), "name", order)
    new = last.select(
        "name", F.lit(True).alias("_hit"), *[F.col(f).alias(f"_new_{f}") for f in fields]
    )
    types = dict(updates.dtypes)
    base = ensure_columns(people, {f: types[f] for f in fields})
    joined = base.join(new, "name", "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in fields
            else F.col(c)
            for c in base.columns
        ]
    )


def lookup_fallback(
    df: DataFrame, titles: DataFrame, code: str, title: str, order: Sequence[str]
) -> DataFrame:
    """Add the first title of each code; the code itself when no title is known.

    The title table is folded to one row per code first, so the join never multiplies.
    """
    first = titles.groupBy(code).agg(F.min_by(title, F.struct(*order)).alias("_title"))
    return (
        df.join(first, code, "left")
        .withColumn(title, F.coalesce("_title", code))
        .drop("_title")
    )


def map_lookup(df: DataFrame, links: DataFrame, name: str, link: str, order: Sequence[str]) -> DataFrame:
    """Exact name -> link lookup; the last entry of a repeated name counts."""
    table = links.groupBy(name).agg(F.max_by(link, F.struct(*order)).alias(link))
    return df.join(table, name, "left")


def class_index(people: DataFrame, classes: DataFrame) -> DataFrame:
    """Every class row of each person, as rows rather than one list per person."""
    return people.join(classes.withColumnRenamed("instructor", "name"), "name")


def shared_values(a: Column, b: Column) -> Column:
    """Set intersection of two arrays, sorted."""
    return F.array_sort(F.array_intersect(a, b))


def departments_of(text: Column) -> Column:
    """'A; B' -> array of departments."""
    return split_strip_list(text, ";")
