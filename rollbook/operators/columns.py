"""Projections and table-level set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Leading columns of a stored class file, and its sort order.
CLASS_FIRST = (
    "course_code", "course_title", "course_descr", "instructor", "scheduled_time_start",
    "scheduled_time_end",
)
CLASS_ORDER = ("course_code", "course_title", "call_number")
ENROLLMENT_ORDER = ("course_code", "call_number")


def reorder(df: DataFrame, first: Sequence[str] = CLASS_FIRST) -> DataFrame:
    """Named columns first, the others alphabetically."""
    return df.select(*first, *sorted(c for c in df.columns if c not in first))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns that may or may not be there."""
    return df.drop(*names)


def rename_subset(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep only the mapped columns under their new names; absent ones come as null text."""
    df = ensure_columns(df, {c: "string" for c in mapping})
    return df.select(*[F.col(a).alias(b) for a, b in mapping.items()])


def ensure_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add missing columns as typed nulls."""
    missing = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def union_terms(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate term tables, aligned by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column; only that column is read."""
    return df.select(column).distinct()


def sort_rows(df: DataFrame, order: Sequence[str] = CLASS_ORDER) -> DataFrame:
    """Total order over the cluster (range partitioned), nulls last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order])


def upsert_check_times(db: DataFrame, stamped: DataFrame, field: str, key: str = "name") -> DataFrame:
    """Add new keys, and stamp `field` of known keys with the later time.

    Both sides may repeat a key: the union is folded with partial aggregation, so a key
    that fills a third of the input is combined before the shuffle.
    """
    others = [c for c in db.columns if c not in (key, field)]
    merged = db.unionByName(stamped.select(key, field), allowMissingColumns=True)
    return merged.groupBy(key).agg(*[F.max(c).alias(c) for c in [field, *others]])
