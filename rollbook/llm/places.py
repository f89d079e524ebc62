"""Dense places of rows in a global order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.sources.scratch import stored

_IN_PART = 33  # monotonically_increasing_id has the partition above these bits


def in_order(df: DataFrame, *keys, name: str, at: str = "at") -> DataFrame:
    """df in a stored table, sorted by keys, with the long column `at` from 0 without gaps.

    Rows are range-partitioned, so a key that very many rows share is only split if later keys tell
    its rows apart.  One count per partition gives the starts; nothing else is folded.
    """
    part = F.shiftright(F.col("__m"), _IN_PART)
    ranged = df.orderBy(*keys).withColumn("__m", F.monotonically_increasing_id())
    ranged = stored(ranged, name)
    counts = ranged.groupBy(part.alias("__p")).agg(F.count("*").alias("__c"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("__p").alias("__q"), F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__s")
    )
    # one row per partition of the sorted table
    placed = ranged.join(F.broadcast(starts), part == F.col("__q"))
    offset = F.col("__m") - F.shiftleft(part, _IN_PART)
    return placed.select(*df.columns, (F.col("__s") + offset).alias(at))
