"""Order-dependent operators that never put one whole group into one task.

A group that fills a third of the table would stall a plain `Window.partitionBy(key)`.
Every operator here either folds with partial aggregation (`min`, `max_by`) and joins the
small result back, or cuts each group into (key, bucket) pieces along its order: a window
runs inside each piece, and a second, much smaller window carries one summary row per
piece forward. Both forms are exact for any data; only the speed depends on the buckets.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEFORE = (Window.unboundedPreceding, -1)
UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where null equals null; the key columns come from the left."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


_BORDER_SAMPLE = 4096  # text values that are looked at for borders; only speed depends on it


def _text_buckets(df: DataFrame, order: str, buckets: int) -> DataFrame:
    """Borders for a text column from values chosen by hash; a null comes before all texts."""
    value = F.col(order)
    seen = df.select(value.alias("v")).filter(value.isNotNull())
    rows = seen.orderBy(F.xxhash64("v")).limit(_BORDER_SAMPLE).collect()
    values = sorted({r["v"].encode() for r in rows})  # Spark compares texts as bytes
    step = max(1, -(-len(values) // buckets))
    cuts = [v.decode() for v in values[step::step]]

    def place(low: int, high: int) -> Column:
        """Number of cuts[low:high] that are not above the value, found by halving."""
        if low == high:
            return F.lit(float(low))
        middle = (low + high) // 2
        return F.when(value < cuts[middle], place(low, middle)).otherwise(place(middle + 1, high))

    return df.withColumn("_bucket", F.when(value.isNull(), F.lit(-1.0)).otherwise(place(0, len(cuts))))


def quantile_buckets(df: DataFrame, order: str, buckets: int = 256) -> DataFrame:
    """Add `_bucket`, monotone in `order`, with about equally many rows in each.

    One cheap pass over the single column finds at most `buckets` cut points, the only
    thing that reaches the driver. The cuts are then literals, so every later use agrees.
    """
    if df.schema[order].dataType.typeName() == "string":
        return _text_buckets(df, order, buckets)
    number = df.withColumn("_order", F.col(order).cast("double"))
    shares = [i / buckets for i in range(1, buckets)]
    found = number.approxQuantile("_order", shares, 0.5 / buckets)
    cuts = sorted({c for c in found if math.isfinite(c)}) or [0.0]
    splits = [-float("inf"), *cuts, float("inf")]
    return (
        Bucketizer(splits=splits, inputCol="_order", outputCol="_bucket", handleInvalid="keep")
        .transform(number)
        .drop("_order")
    )


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, Column],
    group: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Exact running sums along `order` (inclusive) plus `<name>_total` per group.

    Needs `_bucket`, monotone in `order` (`descending` when the order runs downwards).
    The carry table has one row per group and bucket, so its window stays small.
    """
    piece = [*group, "_bucket"]
    per_piece = df.groupBy(*piece).agg(*[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()])
    walk = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    so_far = Window.partitionBy(*group).orderBy(walk).rowsBetween(*BEFORE)
    whole = Window.partitionBy(*group)
    carry = per_piece.select(
        *piece,
        *[F.coalesce(F.sum(f"_s_{n}").over(so_far), F.lit(0)).alias(f"_c_{n}") for n in sums],
        *[F.sum(f"_s_{n}").over(whole).alias(f"{n}_total") for n in sums],
    )
    inside = Window.partitionBy(*piece).orderBy(*order).rowsBetween(*UP_TO_HERE)
    local = df.withColumns({f"_l_{n}": F.sum(c).over(inside) for n, c in sums.items()})
    out = join_null_safe(local, carry, piece, "inner")
    return out.withColumns({n: F.col(f"_l_{n}") + F.col(f"_c_{n}") for n in sums}).drop(
        "_bucket", *[f"_l_{n}" for n in sums], *[f"_c_{n}" for n in sums]
    )


def positions(
    df: DataFrame, order: str, group: Sequence[str] = (), ties: Sequence[str] = (), buckets: int = 256
) -> DataFrame:
    """Add 1-based `position` along `order` and the group size `position_total`."""
    return running_totals(
        quantile_buckets(df, order, buckets),
        [F.col(order), *[F.col(t) for t in ties]],
        {"position": F.lit(1).cast("bigint")},
        group,
    )


def previous_in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, value: Column, out: str
) -> DataFrame:
    """Add `out`: struct(value) of the row before within `keys`; null on the first row."""
    piece = [*keys, "_bucket"]
    cut = df.withColumn("_bucket", bucket).withColumn("_v", F.struct(value.alias("value")))
    local = cut.withColumn(out, F.lag("_v").over(Window.partitionBy(*piece).orderBy(*order)))
    ends = cut.groupBy(*piece).agg(F.max_by("_v", F.struct(*order)).alias("_end"))
    carry = ends.select(
        *piece, F.lag("_end").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_carry")
    )
    joined = join_null_safe(local, carry, piece, "left")
    return joined.withColumn(out, F.coalesce(out, "_carry")).drop("_bucket", "_v", "_carry")


def latest_snapshot(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last version per key, folded map-side before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(*keys, "_last.*")


def fingerprint(content: Column) -> Column:
    """Content digest, so that page bodies stay out of the comparison shuffle."""
    return F.sha2(content, 256)


def change_detect(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    content: str,
    bucket: Column | None = None,
) -> DataFrame:
    """Versions that differ from the version before them; the first is always kept.

    Equal neighbours are never kept, so "differs from the last kept one" is the same as
    "differs from the row before". Default pieces: one key and one day.
    """
    bucket = F.date_trunc("day", F.col(ts)) if bucket is None else bucket
    digest = fingerprint(F.col(content))
    seen = previous_in_order(df, keys, [ts, tie], bucket, digest, "_previous")
    changed = F.col("_previous").isNull() | ~F.col("_previous.value").eqNullSafe(digest)
    return seen.filter(changed).drop("_previous")


def one_per_minute(df: DataFrame, keys: Sequence[str], ts: str, tie: str) -> DataFrame:
    """Of several versions in one minute the last one stays (they share a file name)."""
    stamped = df.withColumn("minute", F.date_trunc("minute", F.col(ts)))
    return latest_snapshot(stamped, [*keys, "minute"], [ts, tie])


def first_relevant(
    df: DataFrame, keys: Sequence[str], rank: str, label: str, relevant: int = 2
) -> DataFrame:
    """Walk results by rank: possible ones before the first relevant one, and that one."""
    stop = df.filter(F.col(label) == relevant).groupBy(*keys).agg(F.min(rank).alias("_stop"))
    walked = join_null_safe(df.filter(F.col(label) > 0), stop, keys, "left")
    return walked.filter(F.col("_stop").isNull() | (F.col(rank) <= F.col("_stop"))).drop("_stop")


def candidates_until_found(
    df: DataFrame, keys: Sequence[str], rank: str, hit: Column, maybe: Column
) -> DataFrame:
    """First hit by rank is 'found'; name matches before it (or without it) are 'unsure'."""
    stop = df.filter(hit).groupBy(*keys).agg(F.min(rank).alias("_stop"))
    walked = join_null_safe(df.filter(hit | maybe), stop, keys, "left")
    before = F.col("_stop").isNull() | (F.col(rank) < F.col("_stop"))
    kind = F.when(F.col(rank) == F.col("_stop"), "found").when(before & maybe, "unsure")
    return walked.withColumn("kind", kind).filter(F.col("kind").isNotNull()).drop("_stop")


def first_match(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Lowest-ordered match per key with the number of matches."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"), F.count("*").alias("matches")
    )
    return best.select(*keys, "_first.*", "matches")


def carry_skip(
    df: DataFrame,
    batch: Sequence[str],
    position: str,
    name: str,
    answer: str,
    piece_rows: int = 100_000,
) -> DataFrame:
    """Add `auto_false`: the last 'na' answer before this row was about the same name."""
    mark = F.when(F.col(answer) == "na", F.struct(F.col(position), F.col(name).alias("name")))
    piece = [*batch, "_bucket"]
    cut = df.withColumn("_bucket", F.floor(F.col(position) / piece_rows)).withColumn("_na", mark)
    inside = Window.partitionBy(*piece).orderBy(position).rowsBetween(*BEFORE)
    before = Window.partitionBy(*batch).orderBy("_bucket").rowsBetween(*BEFORE)
    carry = (
        cut.groupBy(*piece)
        .agg(F.max("_na").alias("_end"))
        .select(*piece, F.max("_end").over(before).alias("_carry"))
    )
    local = cut.withColumn("_last", F.max("_na").over(inside))
    out = join_null_safe(local, carry, piece, "left")
    said = F.coalesce("_last", "_carry")["name"]
    return out.withColumn("auto_false", F.coalesce(said == F.col(name), F.lit(False))).drop(
        "_bucket", "_na", "_last", "_carry"
    )


def head_split(
    df: DataFrame, order: str, share: float = 0.7, ties: Sequence[str] = ()
) -> DataFrame:
    """First `share` of the rows by position is 'train', the rest 'test'."""
    numbered = positions(df, order, ties=ties)
    train = F.col("position") <= F.bround(F.col("position_total") * F.lit(share))
    return numbered.withColumn("split", F.when(train, "train").otherwise("test")).drop(
        "position", "position_total"
    )


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    share: float = 0.8,
    seed: int = 41,
    shuffle: Column | None = None,
) -> DataFrame:
    """Split each label's rows in the same proportion, in a repeatable shuffled order."""
    spread = F.xxhash64(F.col(key), F.lit(seed)) if shuffle is None else shuffle
    numbered = positions(df.withColumn("_spread", spread), "_spread", [label], [key])
    train = F.col("position") <= F.bround(F.col("position_total") * F.lit(share))
    return numbered.withColumn("split", F.when(train, "train").otherwise("test")).drop(
        "_spread", "position", "position_total"
    )
