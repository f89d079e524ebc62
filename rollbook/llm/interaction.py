"""How filters overlap: what each removes alone, after others, and on average over all orders.

Every document gets one bit per filter it fails.  Failing ids are kept as sorted posting lists per
part, filter and range of ids; ranges are bounded, so a part of any size is split over tasks.  For
each set of filters that may run first, the union of their lists is merged, and what another
filter removes after them is the difference of its list; both gallop, so they cost what the lists
interleave, not their ids.  Ranges do not share ids, so sizes are summed over them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.sources.scratch import stored

FILTERS = "ABCDE"
RANGE_BITS = 15  # ids of a posting list differ in these bits only
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"#$%&*|"
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of a code point after its first


def gallop(ids: Sequence[int], x: int, lo: int) -> int:
    """The first place from lo on that holds x or more: steps double, then the last one is halved."""
    step, hi = 1, lo
    while hi < len(ids) and ids[hi] < x:
        lo, hi, step = hi + 1, hi + step, step * 2
    return bisect_left(ids, x, lo, min(hi, len(ids)))


def union(lists: Sequence[Sequence[int]]) -> list[int]:
    """Sorted different ids of sorted lists, each without repeats: a k-way merge that copies runs."""
    live = [(ids, 0) for ids in lists if len(ids)]
    out: list[int] = []
    while len(live) > 1:
        live.sort(key=lambda x: x[0][x[1]])
        (ids, at), (other, o) = live[0], live[1]
        stop = gallop(ids, other[o], at)
        out += ids[at:stop]
        if stop < len(ids) and ids[stop] == other[o]:  # the other list brings it
            stop += 1
        live[:1] = [(ids, stop)] if stop < len(ids) else []
    for ids, at in live:
        out += ids[at:]
    return out


def difference(ids: Sequence[int], gone: Sequence[int]) -> list[int]:
    """The ids of a sorted list that a second one does not hold."""
    out, at, g = [], 0, 0
    while at < len(ids):
        g = gallop(gone, ids[at], g)
        if g == len(gone):
            break
        if gone[g] == ids[at]:
            at, g = at + 1, g + 1
            continue
        stop = gallop(ids, gone[g], at)
        out += ids[at:stop]
        at = stop
    return out + list(ids[at:])


def common(ids: Sequence[int], others: Sequence[int]) -> int:
    """How many ids two sorted lists share."""
    n, a, b = 0, 0, 0
    while a < len(ids) and b < len(others):
        if ids[a] == others[b]:
            n, a, b = n + 1, a + 1, b + 1
        elif ids[a] < others[b]:
            a = gallop(ids, others[b], a)
        else:
            b = gallop(others, ids[a], b)
    return n


def text_fails(text: str | None) -> tuple[int, bytes]:
    """The bits of filters A to D that a text fails, and the digest that E compares.

    Words are runs without ASCII white space, which is what splitting bytes gives.
    """
    raw = (text or "").encode()
    words = raw.split()
    points = len(raw.translate(None, _FOLLOWING))
    capitals = len(raw) - len(raw.translate(None, _UPPER))
    bits = len(words) < 50
    bits |= (100 * len(set(words)) < 65 * len(words)) << 1
    bits |= (100 * capitals > 5 * points) << 2
    bits |= (len(raw) != len(raw.translate(None, _MARKS))) << 3
    return int(bits), hashlib.sha256(raw).digest()


def failures(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """(row, id, part, bits) per row of docs, stored: bit k is set if the row fails filter k of ABCDE.

    A null text is empty, a null part the empty one.  E fails if a smaller id has the same text
    anywhere; a null id has none smaller and counts for no other, and rows of the least id of a
    text all pass it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [text_fails(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([b for b, _ in judged], pa.int32()),
                    pa.array([d for _, d in judged], pa.binary()),
                ],
                names=["id", "part", "bits", "digest"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    pick = docs.select(
        docs[id_col].alias("id"),
        F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
        docs[text_col].cast("string").alias("text"),
    )
    judged = pick.mapInArrow(run, f"id {kind}, part string, bits int, digest binary")
    judged = stored(judged.withColumn("row", F.monotonically_increasing_id()), "judged")
    # joined on text and id, so copies of one text do not meet in one task
    least = judged.groupBy("digest").agg(F.min("id").alias("id")).where("id IS NOT NULL")
    least = least.withColumn("least", F.lit(True))
    repeated = F.col("id").isNotNull() & F.col("least").isNull()
    marked = judged.join(least, ["digest", "id"], "left").select(
        "row", "id", "part", F.when(repeated, F.col("bits") + 16).otherwise(F.col("bits")).alias("bits")
    )
    return stored(marked, "failures")


def postings(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, ids, n, a, b, c, d, e, good, toxic) per part and range `ids` of rows: the sorted rows
    that fail each filter, that are labelled quality 1 or toxic 1 and fail any, and how many there are.

    Labels of one id count together; rows of a null id and ids without labels are neither.
    """
    marks = labels.groupBy(labels[id_col].alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    rows = failed.join(marks, "id", "left")
    listed = lambda wanted: F.sort_array(F.collect_list(F.when(wanted, F.col("row"))))
    fails = [
        listed(F.col("bits").bitwiseAND(1 << k) != 0).alias(name.lower())
        for k, name in enumerate(FILTERS)
    ]
    return rows.groupBy("part", F.shiftright("row", RANGE_BITS).alias("ids")).agg(
        F.count("*").alias("n"),
        *fails,
        listed((F.col("bits") != 0) & F.col("good")).alias("good"),
        listed((F.col("bits") != 0) & F.col("toxic")).alias("toxic"),
    )


def _after(lists: list[list[int]], good: list[int], toxic: list[int]):
    """(before, filter, failing, removed, good_lost, toxic_lost) for every set `before` of filters
    and every other filter."""
    for before in range(1 << len(lists)):
        gone = union([ids for k, ids in enumerate(lists) if before >> k & 1])
        for k, ids in enumerate(lists):
            if not before >> k & 1:
                left = difference(ids, gone)
                yield before, k, len(ids), len(left), common(left, good), common(left, toxic)


def steps(posted: DataFrame) -> DataFrame:
    """(part, n, before, filter, failing, removed, good_lost, toxic_lost) per part, set of earlier
    filters (bits) and filter (its place in ABCDE)."""
    names = ["before", "filter", "failing", "removed", "good_lost", "toxic_lost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(c)[i].as_py() for c in range(batch.num_columns)]
                made = list(zip(*_after(row[2:7], row[7], row[8])))
                n = len(made[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row[0]] * n, pa.string()),
                        pa.array([row[1]] * n, pa.int64()),
                        *[pa.array(c, pa.int64()) for c in made],
                    ],
                    names=["part", "n", *names],
                )

    pick = posted.select("part", "n", *[f.lower() for f in FILTERS], "good", "toxic")
    sizes = pick.mapInArrow(run, "part string, n long, " + ", ".join(f"{c} long" for c in names))
    sums = [F.sum(c).alias(c) for c in ("n", *names[2:])]
    return sizes.groupBy("part", *names[:2]).agg(*sums)


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """Every order of the five filters, step by step and part by part.

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley); counts are rows of the part, so repeated rows count each.  shapley is the sum of what
    the filter removes over all 120 orders.  Other columns are not read; no rows give no rows.
    """
    spark = docs.sparkSession
    failed = failures(docs.select(id_col, text_col, part_col), id_col, text_col, part_col)
    sizes = stored(steps(postings(failed, labels, id_col)), "steps")
    m = len(FILTERS)
    # orders in which exactly the filters of `before` come before a filter
    orders = {
        s: factorial(s.bit_count()) * factorial(m - 1 - s.bit_count()) for s in range((1 << m) - 1)
    }
    weight = F.create_map(*[F.lit(x) for kv in orders.items() for x in kv])
    per_filter = Window.partitionBy("part", "filter")
    others = F.expr(f"{(1 << m) - 1} - shiftleft(1, cast(filter AS int))")
    # 80 rows per part and 16 per window
    sizes = sizes.withColumns(
        {
            "shapley": F.sum(F.col("removed") * weight[F.col("before").cast("int")]).over(per_filter),
            "unique_fails": F.sum(F.when(F.col("before") == others, F.col("removed"))).over(per_filter),
        }
    )
    walk = []
    for order in permutations(range(m)):
        name = "".join(FILTERS[k] for k in order)
        walk += [(name, i + 1, sum(1 << k for k in order[:i]), k) for i, k in enumerate(order)]
    plan = spark.createDataFrame(walk, "filter_order string, step int, before long, filter long")
    # 600 rows whatever the data
    rows = sizes.join(F.broadcast(plan), ["before", "filter"])
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - F.sum("removed").over(so_far)).alias("kept"),
        "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )
