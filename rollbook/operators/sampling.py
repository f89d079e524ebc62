"""Limits, samples, progress and counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a trial run; politeness limits of the profile look-up; sampling odds.
TRIAL_ROWS = 21
BATCH_ROWS = 300
WAIT_MIN, WAIT_MAX, WORK_SECONDS = 7, 60, 5
SAMPLE_OF, SAMPLE_BELOW = 101, 10


def trial_run(df: DataFrame, order: Sequence[str], rows: int = TRIAL_ROWS) -> DataFrame:
    """First rows of a trial run; a top-k, no full sort."""
    return df.orderBy(*order).limit(rows)


def shuffled_batch(
    df: DataFrame, key: str, rows: int = BATCH_ROWS, seed: int = 0, shuffle: Column | None = None
) -> DataFrame:
    """Rows of one run in a repeatable shuffled order; a top-k, no full sort."""
    spread = F.xxhash64(F.col(key), F.lit(seed)) if shuffle is None else shuffle
    return df.orderBy(spread, key).limit(rows)


def label_sample(
    df: DataFrame, key: str, results: Column, seed: int = 0, spread: Column | None = None
) -> DataFrame:
    """Rows for labelling: about 10 % of all, and every row with a single result."""
    value = F.xxhash64(F.col(key), F.lit(seed)) if spread is None else spread
    return df.filter((F.pmod(value, F.lit(SAMPLE_OF)) < SAMPLE_BELOW) | (results == 1))


def progress(df: DataFrame, due: Column, batch: int = BATCH_ROWS) -> DataFrame:
    """total, due, done, next batch and its minutes, in one pass."""
    seconds = WAIT_MIN + (WAIT_MAX - WAIT_MIN) / 2 + WORK_SECONDS
    counted = df.agg(F.count("*").alias("total"), F.count_if(due).alias("due"))
    size = F.least(F.col("due"), F.lit(batch).cast("bigint"))
    return counted.select(
        "total",
        "due",
        (F.col("total") - F.col("due")).alias("done"),
        size.alias("batch"),
        (size * seconds / 60).alias("minutes"),
    )


def counters(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Named counts in one row, from one pass."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def observed(df: DataFrame, name, conditions: Mapping[str, Column]) -> DataFrame:
    """The same counts as a side result of whatever action runs on `df`."""
    return df.observe(name, *[F.count_if(c).alias(n) for n, c in conditions.items()])
