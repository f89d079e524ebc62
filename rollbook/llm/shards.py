"""Shards that all have the mixture of the corpus, by proportional stratified interleaving.

The rows of every source are shuffled by a seeded hash and ranked.  Row r of n (from 0) gets the
fractional rank (r + u) / n, where u in [0, 1) is drawn per source, so that the few rows of small
sources do not all fall on the same fraction.  Sorted by fractional rank, any stretch of the corpus
holds each source in proportion, to a row or two; it is cut into shards of equal counts.

Both sorts are range-partitioned on keys that end with the row itself: a source, or copies of one
row, may hold any share of the table.  Shards follow the law `rows`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.places import in_order
from rollbook.sources.scratch import stored

SEED = 20
_BITS = 60


def seeded(value: Column, seed: int) -> Column:
    """A long below 2 ** 60 that any engine with md5 can repeat; null counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 10).cast("long")


def shard_rows(
    docs: DataFrame,
    n_shards: int,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """(doc, shard, slot): doc is the whole row of docs as a struct, shard 0 to n_shards - 1, slot
    its place there from 0 without gaps.

    Counts of shards differ by one at most.  The order depends on ids, sources and the seed; equal
    ids of one source are ordered by their place in the table, so only rows with a null or repeated
    id may change places between runs.  A null source is a source of its own.  Repeated rows stay
    and are dealt like any others; texts are not read; no column name of docs can clash; no rows
    give no rows.  docs is stored once; sorts carry ids and sources only.
    """
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    whole = stored(whole.withColumn("row", F.monotonically_increasing_id()), "rows")
    thin = whole.select(
        "row",
        F.col(f"doc.`{source_col}`").alias("source"),
        seeded(F.col(f"doc.`{id_col}`"), seed).alias("shuffled"),
    )
    ranked = in_order(thin, "source", "shuffled", "row", name="ranked")
    sources = ranked.groupBy(F.col("source").alias("s")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    draw = seeded(F.col("s"), seed) / F.lit(float(1 << _BITS))
    sources = sources.withColumn("u", draw)
    shares = ranked.join(sources, F.col("source").eqNullSafe(F.col("s"))).select(
        "row", "source", ((F.col("at") - F.col("first") + F.col("u")) / F.col("n")).alias("share")
    )
    mixed = in_order(shares, "share", "source", "row", name="mixed")
    total = max(mixed.count(), 1)
    # shard k holds the places from ceil(k * total / n_shards) on
    shard = F.expr(f"at * {n_shards} div {total}")
    first = F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")
    placed = mixed.select("row", "at", shard.cast("int").alias("shard"))
    placed = placed.select("row", "shard", (F.col("at") - first).alias("slot"))
    return whole.join(placed, "row").select("doc", "shard", "slot")


def mixture(sharded: DataFrame, source_col: str = "source") -> DataFrame:
    """(shard, source, n_rows, expected): what each shard holds of each source."""
    counts = sharded.groupBy("shard", F.col(f"doc.`{source_col}`").alias("source")).agg(
        F.count("*").alias("n_rows")
    )
    shards = counts.groupBy(F.col("shard").alias("k")).agg(F.sum("n_rows").alias("held"))
    sources = counts.groupBy(F.col("source").alias("s")).agg(F.sum("n_rows").alias("all"))
    total = sharded.count()
    joined = counts.join(shards, F.col("shard") == F.col("k")).join(
        sources, F.col("source").eqNullSafe(F.col("s"))
    )
    return joined.select("shard", "source", "n_rows", (F.col("held") * F.col("all") / total).alias("expected"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard below path with doc and slot, its files sorted by slot.

    Each shard is split over several tasks by ranges of its slots.
    """
    ranged = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").parquet(path)
