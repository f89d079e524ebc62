"""Quality rules with thresholds that follow the data.

Each (language, source) group gets its own fences: a quantile sketch per group and metric, merged
from partial sketches before the shuffle, gives quartiles, and a document is rejected beyond
median +- width * max(distance to a quartile, least spread).  The fences are joined back and filter.
A group's quartiles are blended with those of its language, and these with those of everything, by
the number of documents behind them, so a small group leans on its parent and no size is a switch.
Only built-in functions run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.higher import let
from rollbook.sources.scratch import stored

SPACE = "[\\x20\\x09-\\x0D]+"
SPACES, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Fence:
    """A metric, the least spread assumed for it and the sides that reject."""

    metric: str
    least_spread: float
    low: bool = False
    high: bool = True


FENCES = (
    Fence("word_length", 0.5, low=True),
    Fence("symbols_per_word", 0.04),
    Fence("dup_line_share", 0.08),
    Fence("repeat_share", 0.07),  # times WIDTH it lies below the half at which base_failed begins
)
WIDTH = 6.0
PRIOR_DOCS = 20  # at this many documents a group and the level above weigh the same
QUARTILES = (0.25, 0.5, 0.75)
ACCURACY = 1000  # of a sketch: rank error at most 1 / ACCURACY


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def repeat_words(w: Column) -> Column:
    """Words in windows of three words that occur twice or more in the array.

    Hashes only prove that nothing repeats; where two agree, the windows themselves are sorted.
    """
    starts = F.sequence(F.lit(0), F.size(w) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
    windows = F.sort_array(
        F.transform(
            starts,
            lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("t"), i.alias("i")),
        )
    )

    def repeated(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["t"] == x["t"]))
            | ((j + 1 < F.size(s)) & (s[F.least(j + 1, F.size(s) - 1)]["t"] == x["t"])),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        last = F.size(at) - 1
        steps = F.transform(
            at,
            lambda p, k: F.when(
                k < last, F.least(F.lit(3), at[F.least(k + 1, last)] - p)
            ).otherwise(F.lit(3)),
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    unique = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return (
        F.when(F.size(w) < 4, F.lit(0))
        .when(unique, F.lit(0))
        .otherwise(let(let(windows, repeated), covered))
        .cast("long")
    )


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines of whole texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counts = let(
        F.struct(words(text).alias("w"), lines.alias("l")),
        lambda x: F.struct(
            F.size(x["w"]).cast("long").alias("n_words"),
            F.size(x["l"]).cast("long").alias("n_lines"),
            (F.size(x["l"]) - F.size(F.array_distinct(x["l"]))).cast("long").alias("n_dup_lines"),
            repeat_words(x["w"]).alias("n_repeat_words"),
        ),
    )
    without = lambda drop: F.length(F.translate(text, drop, "")).cast("long")
    out = docs.withColumn("__c", counts)
    return out.withColumns(
        {k: F.col(f"__c.{k}") for k in ("n_words", "n_lines", "n_dup_lines", "n_repeat_words")}
        | {"word_chars": without(SPACES), "n_symbols": F.length(text) - without(SYMBOLS)}
    ).drop("__c")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _metrics() -> dict[str, Column]:
    """Of a row's counts; null where there is nothing to divide by."""
    n, lines = F.col("n_words"), F.col("n_lines")
    return {
        "word_length": F.when(n > 0, F.col("word_chars") / n),
        "symbols_per_word": F.when(n > 0, F.col("n_symbols") / n),
        "dup_line_share": F.when(lines > 0, F.col("n_dup_lines") / lines),
        "repeat_share": F.when(n > 0, F.col("n_repeat_words") / n),
    }


def thresholds(
    counted: DataFrame, by=("lang", "source"), fences=FENCES, width=WIDTH, prior=PRIOR_DOCS
) -> DataFrame:
    """Per group of `by`: low_<metric> and high_<metric>, from the documents that pass the base rules.

    The sketches of a group, of all groups with the same first columns of `by`, and of everything
    come out of one rollup.  Each quartile of n documents is blended with the blended one of the
    level above: w * own + (1 - w) * above with w = n^2 / (n^2 + prior^2).  The square lets go of the
    level above soon, since a source may differ much from its language.  A side's reach is measured
    on the other side of the median, which what it rejects does not widen.
    """
    metrics = _metrics()
    sketches = [
        F.percentile_approx(metrics[f.metric], list(QUARTILES), ACCURACY).alias(f.metric)
        for f in fences
    ]
    marked = counted.where(~base_failed()).withColumns({f"__g{c}": F.struct(c) for c in by})
    keys = [f"__g{c}" for c in by]
    levels = marked.rollup(*keys).agg(F.count("*").alias("__n"), *sketches)
    levels = stored(levels, "fences")
    squared = F.col("__n").cast("double") * F.col("__n")
    weight = squared / (squared + prior**2)
    out = None
    for k in range(len(by) + 1):
        level = levels.where(F.col(keys[k]).isNull()) if k < len(by) else levels
        if k:
            level = level.where(F.col(keys[k - 1]).isNotNull())
        level = level.select(*keys[:k], weight.alias("__w"), F.struct(*metrics).alias("__own"))
        if out is None:
            out = level.withColumnRenamed("__own", "__q").drop("__w")
            continue
        # the overall level is one row
        level = level.join(out, keys[: k - 1]) if k > 1 else level.crossJoin(F.broadcast(out))
        blended = [
            F.transform(
                F.arrays_zip(F.col(f"__own.{m}").alias("own"), F.col(f"__q.{m}").alias("above")),
                lambda x: F.col("__w") * x["own"] + (1 - F.col("__w")) * x["above"],
            ).alias(m)
            for m in metrics
        ]
        out = level.select(*keys[:k], F.struct(*blended).alias("__q"))
    limits = []
    for f in fences:
        q = F.col(f"__q.{f.metric}")
        below = width * F.greatest(q[2] - q[1], F.lit(f.least_spread))
        above = width * F.greatest(q[1] - q[0], F.lit(f.least_spread))
        limits += [
            (q[1] - below if f.low else F.lit(None).cast("double")).alias(f"low_{f.metric}"),
            (q[1] + above if f.high else F.lit(None).cast("double")).alias(f"high_{f.metric}"),
        ]
    return out.select(*[F.col(f"{g}.{c}").alias(c) for g, c in zip(keys, by)], *limits)


def judge(
    counted: DataFrame,
    by=("lang", "source"),
    fences=FENCES,
    width: float = WIDTH,
    limits: DataFrame | None = None,
) -> DataFrame:
    """Add base_failed and kept to rows of `with_counts`, which should be a stored table.

    Null languages and sources are a group like any other.  Rows are judged one by one, so
    repeated ids and rows stay as they are, and no rows give no rows.  `limits` are the `thresholds`
    of the rows if they are known; then rows are read once and need not be stored.
    """
    limits = thresholds(counted, by, fences, width) if limits is None else limits
    limits = limits.select(
        *[F.col(c).alias(f"__{c}") for c in by],
        F.struct(*[c for c in limits.columns if c not in by]).alias("__limits"),
    )
    same = [counted[c].eqNullSafe(F.col(f"__{c}")) for c in by]
    metrics, inside = _metrics(), F.lit(True)
    for f in fences:
        value = metrics[f.metric]
        inside &= F.coalesce(value >= F.col(f"__limits.low_{f.metric}"), F.lit(True))
        inside &= F.coalesce(value <= F.col(f"__limits.high_{f.metric}"), F.lit(True))
    return (
        counted.join(limits, same, "left")
        .withColumns({"base_failed": base_failed()})
        .withColumn("kept", ~F.col("base_failed") & inside)
        .drop("__limits", *[f"__{c}" for c in by])
    )


def quality(
    docs: DataFrame, text_col: str = "text", by=("lang", "source"), width: float = WIDTH
) -> DataFrame:
    """docs with counts, base_failed and kept; the counts are stored once in the shared folder.

    Null and empty texts have no words and fail the base rules.  Columns of docs that are named
    like a count are replaced.  Select what you need first: what docs carries is stored with it.
    """
    return judge(stored(with_counts(docs, text_col), "quality"), by, width=width)
