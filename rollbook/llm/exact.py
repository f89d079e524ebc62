"""Exact dedup by deterministic block naming.

Texts are cut into fixed-size blocks; the distinct blocks, sorted, become integer names; then
adjacent pairs of names are sorted and named in turn until each document is one name.  Equal
names mean equal texts by construction, whatever any hash does.

Only documents that share length and checksum with another one can have a copy; they alone are
named, all others are their own identity.  Names are counters over a stored sorted table: every
reader sees the same ones, also after executors are lost.  Only built-in functions run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.sources.scratch import stored

BLOCK_BYTES = 4096


def _named(distinct: DataFrame, label: str) -> DataFrame:
    """Distinct rows with the integer `name`, increasing in sorted order, in a stored table.

    The order is that of a hash and then of the rows, so the range partitioner samples hashes and
    not whole blocks.
    """
    ranged = distinct.withColumn("__h", F.xxhash64(*distinct.columns)).repartitionByRange("__h")
    in_order = ranged.sortWithinPartitions("__h", *distinct.columns).drop("__h")
    return stored(in_order.withColumn("name", F.monotonically_increasing_id()), label)


def _blocks(size: int):
    """The blocks of a binary column `body`, at least one."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / size)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substring(F.col("body"), i * size + 1, F.lit(size)),
    )


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, n_bytes, name) of docs (row, n_bytes, body): equal pairs mean equal bodies.

    One row per input row; `row` must be unique and not null.  Rounds: the logarithm of the number
    of blocks of the longest body, which is the only figure that comes to the driver.
    """
    pieces = docs.select("row", "n_bytes", F.posexplode(_blocks(block_bytes)).alias("at", "block"))
    pieces = stored(pieces, "blocks")
    names = _named(pieces.select("block").distinct(), "block-names")
    level = stored(pieces.join(names, "block").select("row", "n_bytes", "at", "name"), "level")
    while (level.agg(F.max("at")).first()[0] or 0) > 0:
        side = lambda k: F.max(F.when(F.col("at") % 2 == k, F.col("name")))
        pairs = level.groupBy("row", "n_bytes", F.floor(F.col("at") / 2).alias("at")).agg(
            side(0).alias("left"), F.coalesce(side(1), F.lit(-1)).alias("right")
        )
        pairs = stored(pairs, "pairs")
        names = _named(pairs.select("left", "right").distinct(), "pair-names")
        level = stored(
            pairs.join(names, ["left", "right"]).select("row", "n_bytes", "at", "name"), "level"
        )
    return level.select("row", "n_bytes", "name")


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """(n_bytes, check, text_sha256, body) of each row, with the whole row as `whole`."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), text.alias("text")).select(
        "whole",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.xxhash64("text").alias("check"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
        F.col("text").cast("binary").alias("body"),
    )


def _judged(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(single, copies): rows (whole, id, text_sha256) without an equal text, and the others with
    keep_id, group_size and kept."""
    keyed = _keyed(docs, text_col)
    sums = keyed.groupBy("n_bytes", "check").agg(F.count("*").alias("n")).where("n > 1")
    alike = stored(sums.select("n_bytes", "check"), "alike")
    single = keyed.join(alike, ["n_bytes", "check"], "left_anti")
    candidates = keyed.join(alike, ["n_bytes", "check"], "left_semi")
    candidates = stored(
        candidates.withColumn("row", F.monotonically_increasing_id()), "candidates"
    )
    named = identities(candidates.select("row", "n_bytes", "body"), block_bytes)
    named = candidates.select("row", F.col(f"whole.`{id_col}`").alias("id")).join(named, "row")
    named = stored(named, "named")
    groups = named.groupBy("n_bytes", "name").agg(
        F.max(F.struct("id", "row")).alias("last"), F.count("*").alias("group_size")
    )
    verdicts = named.join(groups, ["n_bytes", "name"]).select(
        "row",
        F.col("last.id").alias("keep_id"),
        "group_size",
        (F.col("last.row") == F.col("row")).alias("kept"),
    )
    return single, candidates.join(verdicts, "row")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(<id_col>, keep_id, group_size, kept, text_sha256), one row per row of docs.

    Equal texts form a group, null counting as empty; the row with the largest id stays, a null id
    being the smallest, and of rows with that id any one.  Other columns are left out; no rows
    give no rows.
    """
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    single, copies = _judged(slim, "id", "text", block_bytes)
    own = F.col("whole.id")
    single = single.select(
        own.alias("id"),
        own.alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    copies = copies.select(own.alias("id"), "keep_id", "group_size", "kept", "text_sha256")
    return single.unionByName(copies).withColumnRenamed("id", id_col)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of docs that stay, with all their columns: one of every group of equal texts."""
    single, copies = _judged(docs, id_col, text_col, block_bytes)
    return single.select("whole.*").unionByName(copies.where("kept").select("whole.*"))
