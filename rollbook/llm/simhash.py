"""SimHash near-dedup with multi-index hashing.

Fingerprints are 64-bit majority votes over shingle hashes.  Two fingerprints that differ in two
bits or fewer have a common point at one bit or none from each: so each fingerprint enumerates the
ball of radius one within every segment of its bits, the index groups what lands on the same point,
and the links it yields are verified on the complete distance.  A point has at most 65
fingerprints, whatever the data; they are folded into one mask of flipped bits instead of a list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.components import components
from rollbook.sources.scratch import stored

SEED = 42
SHINGLE_WORDS = 3
SEGMENT_BITS = 16
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
VOTES_AT_ONCE = 1 << 16


def shingle_hashes(text: str | None, shingle_words: int) -> np.ndarray:
    """Hashes of all shingles of a whole text; fewer words are one shingle."""
    words = (text or "").encode().translate(LOWER).split()  # splits at \x20, \x09-\x0D
    joined, k = b" ".join(words), max(1, min(shingle_words, len(words)))
    ends = np.cumsum([len(w) + 1 for w in words or [b""]])
    starts = np.concatenate([[0], ends[:-1]])[: len(ends) - k + 1]
    hash_of = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), (ends[k - 1 :] - 1).tolist())
    return np.array([hash_of(joined[a:b], SEED) for a, b in spans], "<u8")


def voted(hashes: np.ndarray) -> int:
    """The unsigned fingerprint of shingle hashes, repeats included: bits set in over half of them."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), VOTES_AT_ONCE):
        bits = np.unpackbits(hashes[i : i + VOTES_AT_ONCE].view(np.uint8), bitorder="little")
        votes += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little"), "little")


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of a whole text; zero for a text without words."""
    if not (text or "").strip(" \t\n\x0b\f\r"):
        return 0
    return voted(shingle_hashes(text, shingle_words))


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """(<id_col>, fp): fp is the fingerprint as a signed long; one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), shingle_words) for t in batch.column(1)]
            fp = pa.array(np.array(made, "<u8").view("<i8"), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], names=["id", "fp"])

    pick = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return pick.mapInArrow(run, f"id {kind}, fp bigint").withColumnRenamed("id", id_col)


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fps (column fp) at two or fewer differing bits.

    Fingerprints on a common point are linked to the least of them, not pairwise.
    """
    segments = F.sequence(F.lit(0), F.lit(64 // SEGMENT_BITS - 1))
    ball = F.flatten(
        F.transform(
            segments,
            lambda s: F.transform(
                F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1)),
                lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), s * SEGMENT_BITS + i),
            ),
        )
    )
    # 65 rows come of each: spread them first, since the table itself is small enough for few tasks
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fps = fps.repartition(parts, "fp")
    flips = fps.select("fp", F.explode(F.concat(F.array(F.lit(0).cast("long")), ball)).alias("flip"))
    points = flips.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("point")).agg(
        F.bit_or("flip").alias("flipped"), F.max((F.col("flip") == 0).cast("int")).alias("own")
    )
    shared = points.where(F.bit_count("flipped") + F.col("own") > 1)
    flipped = F.transform(
        F.filter(ball, lambda f: f.bitwiseAND(F.col("flipped")) != 0),
        lambda f: F.col("point").bitwiseXOR(f),
    )
    own = F.when(F.col("own") == 1, F.array("point")).otherwise(F.array().cast("array<bigint>"))
    members = shared.select(F.concat(own, flipped).alias("members"))
    pairs = members.select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    return pairs.where((F.col("a") != F.col("b")) & near).distinct()


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """(<id_col>, fingerprint, component_id), one row per row of docs.

    component_id is the least id that a chain of links (two or fewer differing bits) reaches.
    Null and empty texts have fingerprint zero and are linked like any other; a null id takes part
    but names a component only if no other id does (then component_id is null).  Other columns
    are left out; no rows give no rows.
    """
    made = fingerprints(docs, id_col, text_col, shingle_words)
    rows = stored(made.select(F.col(id_col).alias("id"), "fp"), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = components(links(classes.select("fp")))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(of_class, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
