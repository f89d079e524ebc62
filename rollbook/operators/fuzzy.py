"""Joining two name columns without comparing all pairs, and without losing a pair.

Two spellings match when two of their parts are equal or similar (one, when the foreign
spelling has a single part), or when the whole names are very similar. Equal parts have
similarity 1, so two joins decide everything:

* parts: the distinct parts of both sides are paired by similarity once. Then each side
  emits keys made of *two* parts; a joined key is already a match, so a part that a third
  of all names hold ('maria') builds no candidates on its own.
* whole names: keys that hold what two similar names have in common exactly (`similar_pairs`).

Both sides are reduced to distinct spellings first. `fuzzy_first` answers "first match,
and is there more than one" from `min` and `max` per key, so even a key shared by very
many names is folded instead of paired.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import names as N
from rollbook.functions.higher import exploded, let
from rollbook.sources.scratch import stored

# Jaro-Winkler adds 0.1 per equal leading letter, at most 4.
_PREFIX_WEIGHT = 0.1
_EPS = 1e-9


def _budget(threshold: float, prefix: int) -> float:
    """Largest da/|a| + db/|b| of a pair that shares at most `prefix` leading letters.

    da and db are the letters of each side without a partner in the other. From
    JW = J + p(1 - J) with p = 0.1 * prefix follows J >= (threshold - p) / (1 - p), and
    from J <= (ma/|a| + mb/|b| + 1) / 3 follows the sum <= 3 (1 - J).
    """
    p = _PREFIX_WEIGHT * prefix
    return 3.0 * (1.0 - (threshold - p) / (1.0 - p)) + _EPS


def _letters(c: Column) -> Column:
    return F.array_sort(F.filter(F.split(c, ""), lambda x: x != ""))


def _count_of(c: Column, letter: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, letter, F.lit("")))


# The keys are written as SQL text: as nested Columns they take seconds to put together.
_NONE = "cast(array() AS array<string>)"


def _let(name: str, value: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _without_one(text: str) -> str:
    """The text without one of its letters, once per different result."""
    cut = f"concat(substring({text}, 1, i - 1), substring({text}, i + 1))"
    return f"if(length({text}) > 0, array_distinct(transform(sequence(1, length({text})), i -> {cut})), {_NONE})"


def _without_two(text: str) -> str:
    return f"array_distinct(flatten(transform({_without_one(text)}, y -> {_without_one('y')})))"


def _tagged(tag: str, texts: str) -> str:
    return f"transform({texts}, z -> concat('{tag}', z))"


def _close_keys(rest: str, ordered: str, gap: str, most: str, longer_role: bool) -> str:
    """Keys of one string for pairs that at most `most` <= 2 letters and moves keep apart.

    rest is the text behind the common start, whose letters are partners of each other, `ordered`
    the same letters sorted.  A pair has da letters of the longer and db of the shorter side without
    a partner, da - db = gap, and what is left of `most` are half moves.  Without a half move the
    partners stand in one order on both sides, so the texts without the other letters are equal;
    else their sorted letters are.
    """
    one = lambda tag, text: f"array(concat('{tag}', {text}))"
    moved = f"if({most} = 2, {_tagged('p', _without_one(rest))}, {_NONE})"
    same = f"if({most} = 0, {one('e', rest)}, concat({one('s', ordered)}, {moved}))"
    if longer_role:
        by_one = f"if({most} = 1, {_tagged('u', _without_one(rest))}, {_tagged('t', _without_one(ordered))})"
        by_two = f"if({most} = 2, {_tagged('v', _without_two(rest))}, {_NONE})"
        return f"concat({same}, if({most} >= 1, {by_one}, {_NONE}), {by_two})"
    by_one = f"if({most} = 1, {one('u', rest)}, {one('t', ordered)})"
    return (
        f"CASE WHEN {gap} > {most} THEN {_NONE} WHEN {gap} = 0 THEN {same} "
        f"WHEN {gap} = 1 THEN {by_one} ELSE {one('v', rest)} END"
    )


def _class_keys(letters: str, classes: str, start: str) -> str:
    """Keys of two classes of letters each."""
    parts = (
        f"transform(sequence(0, {classes} - 1), "
        f"k -> array_join(filter({letters}, x -> pmod(ascii(x), {classes}) = k), ''))"
    )
    pair = f"concat_ws('|', {start}, cast(i AS string), cast(j AS string), p, q)"
    pairs = f"flatten(transform(ps, (p, i) -> transform(slice(ps, i + 2, size(ps)), (q, j) -> {pair})))"
    return _let("ps", parts, pairs)


def _block_keys(value: str, letters: str, longer_role: bool, threshold: float) -> Column:
    """Array of exact block keys of one string, from the columns that hold it and its letters.

    For a pair let M be the longer length and D the most letters that can lack a partner, half
    moves included. For D <= 2 see `_close_keys`. Else the alphabet is cut into D + 2 classes; D
    letters spoil at most D of them, so at least two classes have equal letters on both sides.
    Key: (prefix family, prefix, M, what is equal). The shorter side does not know M and emits the
    keys of each possible M.
    """

    def family(prefix: int, worst: int) -> str:
        budget = _budget(threshold, worst)
        n = f"length({value})"
        top = f"greatest({n}, cast(floor({n} / {1.0 - budget!r}D) AS int))"
        lengths = f"array({n})" if longer_role else f"sequence({n}, {top})"
        most = f"cast(floor({budget!r}D * m) AS int)"
        start = f"concat('{prefix}|', substring({value}, 1, {prefix}), '|', cast(m AS string))"
        close = _close_keys("w.rest", "w.ordered", f"(m - {n})", "w.most", longer_role)
        close = f"transform({close}, c -> concat_ws('|', w.start, c))"
        keys = f"if(w.most <= 2, {close}, {_class_keys(letters, '(w.most + 2)', 'w.start')})"
        rest = f"substring({value}, {prefix + 1})"
        known = (
            f"named_struct('rest', {rest}, 'most', {most}, 'start', {start}, "
            f"'ordered', array_join(array_sort(split({rest}, '')), ''))"
        )
        of_lengths = f"flatten(transform({lengths}, m -> {_let('w', known, keys)}))"
        return f"if({n} >= {prefix}, {of_lengths}, {_NONE})"

    return F.expr(f"concat({family(0, 0)}, {family(1, 3)}, {family(4, 4)})")


def similar_pairs(
    left: DataFrame, right: DataFrame, threshold: float, wanted: Column | None = None
) -> DataFrame:
    """All pairs (a, b) of two distinct-value tables with Jaro-Winkler >= threshold.

    Lossless blocking (`_block_keys`), a letter-count check, and the similarity itself only for what
    is left. No block key is capped. Further columns of
    the tables, which must be unique per value, come along for `wanted`, a condition that spares
    pairs the scoring.
    """
    extra = [*left.columns[1:], *right.columns[1:]]
    # few bytes and much work per row: a fixed number of tasks, which sizes alone would merge
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def prepared(df: DataFrame, out: str) -> DataFrame:
        one = df.withColumnRenamed(df.columns[0], out).filter(F.length(out) > 0).distinct()
        return one.repartition(parts, out).withColumn(f"_l{out}", _letters(F.col(out)))

    def blocked(df: DataFrame, c: str, longer_role: bool) -> DataFrame:
        keys = _block_keys(c, f"_l{c}", longer_role, threshold)
        rest = [x for x in df.columns if x in extra]
        return _spread(exploded(df, F.array_distinct(keys), "_key").select(c, *rest, "_key"))

    a, b = prepared(left, "a"), prepared(right, "b")
    a_longer = blocked(a, "a", True).join(blocked(b, "b", False), "_key")
    b_longer = blocked(a, "a", False).join(blocked(b, "b", True), "_key")
    la, lb = F.length("a"), F.length("b")
    both = a_longer.filter(la >= lb).unionByName(b_longer.filter(la < lb))
    if wanted is not None:
        both = both.filter(wanted)
    # a pair may share several keys
    once = both.select("a", "b").repartition(parts, "a", "b").distinct()
    shared = F.aggregate(
        F.array_distinct(_letters(F.col("a"))),
        F.lit(0),
        lambda acc, x: acc
        + F.least(_count_of(F.col("a"), x), _count_of(F.col("b"), x)),
    )
    least = 2.0 - _budget(threshold, 4)
    pairs = once.filter(let(shared, lambda m: m / la + m / lb >= least))
    # a filter on a column would compute it a second time
    reached = F.filter(F.array(N.jaro_winkler_of(F.col("a"), F.col("b"))), lambda s: s >= threshold)
    return exploded(pairs.select("a", "b"), reached, "similarity")


def _spread(df: DataFrame) -> DataFrame:
    """A table that joins never broadcast: keys shrink so well on disk and in a shuffle that Spark
    takes hundreds of megabytes of them for a few and collects them on the driver."""
    return df.hint("merge")


def _spellings(df: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct spellings with their ordered form and parts."""
    one = df.select(F.col(column).alias(out)).filter(F.col(out).isNotNull()).distinct()
    ordered = N.name_order(F.col(out))
    parts = one.select(
        out, F.lower(ordered).alias("whole"), N.name_tokens(ordered).alias("parts")
    )
    return stored(parts, "spellings")


def _two(x: Column, y: Column) -> Column:
    """Key of two parts, independent of their order."""
    return F.concat_ws("\u0001", F.least(x, y), F.greatest(x, y))


def _pair_keys(parts: Column) -> Column:
    """Keys of all two-part choices of an array, a part with itself included."""
    return F.array_distinct(
        F.flatten(
            F.transform(
                parts,
                lambda p, i: F.transform(
                    F.slice(parts, i + 1, F.size(parts)), lambda q: _two(p, q)
                ),
            )
        )
    )


def _keyed(catalogue: DataFrame, foreign: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(catalogue spelling, key) and (foreign spelling, key); equal keys are matches."""
    c_parts = catalogue.select("c", F.array_distinct("parts").alias("parts"))
    c_keys = exploded(c_parts, _pair_keys(F.col("parts")), "key").select("c", "key").unionByName(
        c_parts.select("c", F.explode("parts").alias("key"))
    )

    # foreign parts keep their multiplicity: a repeated part counts twice
    f_parts = foreign.select("f", F.size("parts").alias("n"), F.posexplode("parts").alias("at", "part"))
    vocabulary = c_parts.select(F.explode("parts").alias("part"))
    close = similar_pairs(f_parts.select("part"), vocabulary, N.TOKEN_SIMILARITY).select(
        F.col("a").alias("part"), F.col("b").alias("known")
    )
    options = stored(f_parts.join(_spread(close), "part").select("f", "n", "at", "known"), "options")
    alone = options.filter(F.col("n") == 1).select("f", F.col("known").alias("key"))
    first = options.filter(F.col("n") > 1).select("f", "at", "known")
    second = first.select("f", F.col("at").alias("at2"), F.col("known").alias("known2"))
    both = first.join(_spread(second), "f").filter(F.col("at") < F.col("at2"))
    f_keys = alone.unionByName(both.select("f", _two(F.col("known"), F.col("known2")).alias("key")))
    f_keys = f_keys.distinct()
    return c_keys, f_keys


def _whole_pairs(
    catalogue: DataFrame, foreign: DataFrame, bounds: DataFrame | None = None
) -> DataFrame:
    """(c, f) with similar whole names; a pair whose c lies within the bounds (f, low, high) that
    are known already may be left out, since it changes neither end."""
    f_wholes, c_wholes, wanted = foreign.select("whole"), catalogue.select("whole"), None
    if bounds is not None:
        # a bound counts only if every spelling of the whole name has it
        f_wholes = foreign.join(_spread(bounds), "f", "left").groupBy("whole").agg(
            F.when(F.count("low") == F.count("*"), F.max("low")).alias("low"),
            F.when(F.count("low") == F.count("*"), F.min("high")).alias("high"),
        )
        c_wholes = catalogue.groupBy("whole").agg(F.min("c").alias("c_low"), F.max("c").alias("c_high"))
        within = (F.col("low") <= F.col("c_low")) & (F.col("c_high") <= F.col("high"))
        wanted = ~F.coalesce(within, F.lit(False))
    close = similar_pairs(f_wholes, c_wholes, N.NAME_SIMILARITY, wanted)
    return (
        close.select(F.col("a").alias("f_whole"), F.col("b").alias("c_whole"))
        .join(_spread(foreign.select("f", F.col("whole").alias("f_whole"))), "f_whole")
        .join(_spread(catalogue.select("c", F.col("whole").alias("c_whole"))), "c_whole")
        .select("c", "f")
    )


def fuzzy_pairs(catalogue: DataFrame, name: str, foreign: DataFrame, other: str) -> DataFrame:
    """Every matching pair of spellings (c, f)."""
    c, f = _spellings(catalogue, name, "c"), _spellings(foreign, other, "f")
    c_keys, f_keys = _keyed(c, f)
    return _spread(c_keys).join(f_keys, "key").select("c", "f").unionByName(_whole_pairs(c, f)).distinct()


def fuzzy_first(catalogue: DataFrame, name: str, foreign: DataFrame, other: str) -> DataFrame:
    """Per foreign spelling: first matching catalogue name, and whether there are several."""
    c, f = _spellings(catalogue, name, "c"), _spellings(foreign, other, "f")
    c_keys, f_keys = _keyed(c, f)
    ends = [F.min("c").alias("low"), F.max("c").alias("high")]
    by_key = f_keys.join(_spread(c_keys.groupBy("key").agg(*ends)), "key")
    by_parts = by_key.groupBy("f").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    by_parts = stored(by_parts, "part-matches")
    whole = _whole_pairs(c, f, by_parts).groupBy("f").agg(*ends)
    merged = (
        by_parts.unionByName(whole)
        .groupBy("f")
        .agg(F.min("low").alias("first_match"), F.max("high").alias("_high"))
    )
    return merged.select(
        F.col("f").alias(other), "first_match", (F.col("first_match") != F.col("_high")).alias("several")
    )


def matching_hits(df: DataFrame, name: str, found: str) -> DataFrame:
    """Rows whose two spellings match; each distinct pair is compared once."""
    pairs = df.select(name, found).distinct()
    good = pairs.filter(N.words_match2(F.col(name), F.col(found)))
    return df.join(good, [name, found], "left_semi")


def search_hits(people: DataFrame, hits: DataFrame) -> DataFrame:
    """First matching hit per person; misses are looked up again without initials.

    `people`: name. `hits`: query, rank, found, link (what a search for `query` returned).
    """
    from rollbook.functions.text import drop_initials

    def first_hits(df: DataFrame, step: int) -> DataFrame:
        good = matching_hits(df, "name", "found")
        best = good.groupBy("name").agg(
            F.min_by(F.struct("found", "link"), "rank").alias("_first"), F.count("*").alias("matches")
        )
        return best.select("name", "_first.*", "matches", F.lit(step).alias("step"))

    one = people.select("name").distinct()
    hits = stored(hits.select("query", "rank", "found", "link"), "hits")
    first = stored(first_hits(one.join(hits, one["name"] == hits["query"]), 1), "first")
    missed = one.join(first.select("name"), "name", "left_anti").withColumn(
        "short", drop_initials(F.col("name"))
    )
    again = missed.filter(F.col("short") != F.col("name"))
    second = first_hits(again.join(hits, again["short"] == hits["query"]), 2)
    return first.unionByName(second)
