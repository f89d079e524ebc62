"""Person-name functions, all of them column expressions; `jaro_winkler` states one in plain Python."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.higher import let

# When two name parts, and two whole names, count as the same.
TOKEN_SIMILARITY = 0.95
NAME_SIMILARITY = 0.97
# Latin letters that do not decompose into a base letter and a mark.
LATIN_LIGATURES = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ĳ": "ij"}
LATIN_STROKES = {"ø": "o", "đ": "d", "ł": "l", "ð": "d", "ħ": "h", "ı": "i", "ŧ": "t", "ŋ": "n"}


def _latin_folds() -> tuple[str, str]:
    """Accented Latin letters and their base letters, derived from Unicode decomposition."""
    source, target = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        ch = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if base != ch and len(base) == 1:
            source.append(ch)
            target.append(base)
    for ch, base in LATIN_STROKES.items():
        source += [ch, ch.upper()] if len(ch.upper()) == 1 and ch != "ı" else [ch]
        target += [base, base.upper()] if len(ch.upper()) == 1 and ch != "ı" else [base]
    return "".join(source), "".join(target)


_FOLD_FROM, _FOLD_TO = _latin_folds()


def fold_accents(c: Column) -> Column:
    """Latin letters without accents; other scripts stay as they are."""
    out = F.translate(F.regexp_replace(c, r"\p{M}+", ""), _FOLD_FROM, _FOLD_TO)
    for ch, base in LATIN_LIGATURES.items():
        out = F.replace(out, F.lit(ch), F.lit(base))
    return out


def name_order(c: Column) -> Column:
    """'Last, First' -> 'First Last' with single blanks; other names stay as they are."""
    parts = F.split(c, ",", 2)
    swapped = F.concat(F.get(parts, F.lit(1)), F.lit(" "), F.get(parts, F.lit(0)))
    return F.when(
        c.contains(","), F.regexp_replace(F.regexp_replace(swapped, r"^\s+|\s+$", ""), r"\s+", " ")
    ).otherwise(c)


def name_tokens(c: Column) -> Column:
    """Lower-cased word parts longer than one letter, accents folded."""
    parts = F.split(F.lower(c), r"[^\p{L}\p{N}_]")
    return F.transform(F.filter(parts, lambda w: F.length(w) > 1), fold_accents)


def words_match(search: Column, text: Column) -> Column:
    """Every word of `search` occurs somewhere in `text`, ignoring case."""
    body = F.lower(text)
    parts = F.filter(F.split(F.lower(search), r"\s+"), lambda w: w != "")
    return F.forall(parts, lambda w: F.contains(body, w))


def jaro_winkler(a: str, b: str) -> float:
    """Standard Jaro-Winkler similarity (prefix weight 0.1, at most 4, above 0.7 only)."""
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    reach = max(max(la, lb) // 2 - 1, 0)
    used = [False] * lb
    hits = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(lb, i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                hits.append(ch)
                break
    m = len(hits)
    if not m:
        return 0.0
    other = [b[j] for j in range(lb) if used[j]]
    half_moves = sum(x != y for x, y in zip(hits, other)) // 2
    score = (m / la + m / lb + (m - half_moves) / m) / 3.0
    if score > 0.7:
        prefix = 0
        for x, y in zip(a[:4], b[:4]):
            if x != y:
                break
            prefix += 1
        score += 0.1 * prefix * (1.0 - score)
    return score


# for SQL text, which cannot call a column expression
@F.pandas_udf(T.DoubleType())
def _jaro_winkler_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [None if x is None or y is None else jaro_winkler(x, y) for x, y in zip(a, b)],
        dtype="float64",
    )


_TAKEN = "\uffff"  # in place of a letter that has a partner; no character of any text


def _letters(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def _partners(a: Column, b: Column, reach: Column) -> Column:
    """(rest, hits): b with the letters taken that those of a, in order, find within `reach` places,
    each the first that is free; hits are the letters of a that found one."""
    start = F.struct(b.alias("rest"), F.lit("").alias("hits"))

    def step(state: Column, x: Column) -> Column:
        first = F.greatest(x["at"] - reach, F.lit(0)) + 1
        found = F.call_function("locate", x["letter"], state["rest"], first)
        return let(
            found,
            lambda p: F.when(
                (p > 0) & (p <= x["at"] + reach + 1),
                F.struct(
                    F.overlay(state["rest"], F.lit(_TAKEN), p, F.lit(1)).alias("rest"),
                    F.concat(state["hits"], x["letter"]).alias("hits"),
                ),
            ).otherwise(state),
        )

    placed = F.transform(_letters(a), lambda x, i: F.struct(x.alias("letter"), i.alias("at")))
    return F.aggregate(placed, start, step)


_STEPS = (32, 16, 8, 4, 2, 1)


def _common_start(a: Column, b: Column) -> Column:
    """How many of the first 63 letters are the same in both texts, up to the first that is not."""
    shorter = F.least(F.length(a), F.length(b))

    def step(n: Column, k: Column) -> Column:
        same = F.substring(a, n + 1, k) == F.substring(b, n + 1, k)
        return F.when((n + k <= shorter) & same, n + k).otherwise(n)

    return F.aggregate(F.array(*[F.lit(k) for k in _STEPS]), F.lit(0), step)


def _jaro(a: Column, b: Column, start: Column) -> Column:
    """Jaro similarity of two texts that are not empty and have their first `start` letters in common.

    These are partners of each other, so only the letters behind them are compared.
    """
    la, lb = F.length(a), F.length(b)
    ends = F.struct(
        F.substring(a, start + 1, la).alias("a"),
        F.substring(b, start + 1, lb).alias("b"),
        F.greatest(F.floor(F.greatest(la, lb) / 2).cast("int") - 1, F.lit(0)).alias("reach"),
    )

    def score(b_end: Column, found: Column) -> Column:
        taken = F.filter(
            _letters(b_end), lambda x, i: F.substring(found["rest"], i + 1, F.lit(1)) == _TAKEN
        )
        moved = F.size(F.filter(F.zip_with(_letters(found["hits"]), taken, lambda x, y: x != y), lambda d: d))
        m = F.length(found["hits"]) + start
        orderly = (m - F.floor(moved / 2)) / m
        return F.when(m == 0, F.lit(0.0)).otherwise((m / la + m / lb + orderly) / 3.0)

    return let(ends, lambda e: let(_partners(e["a"], e["b"], e["reach"]), lambda f: score(e["b"], f)))


def jaro_winkler_of(a: Column, b: Column) -> Column:
    """`jaro_winkler` as a column expression; null if either is null."""

    def boosted(start: Column, jaro: Column) -> Column:
        up = 0.1 * F.least(start, F.lit(4)) * (1.0 - jaro)
        return F.when(jaro > 0.7, jaro + up).otherwise(jaro)

    def similarity(start: Column) -> Column:
        return let(_jaro(a, b, start), lambda jaro: boosted(start, jaro))

    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(a == b, F.lit(1.0))
        .when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0))
        .otherwise(let(_common_start(a, b), similarity))
    )


def str_similarity(a: Column, b: Column) -> Column:
    """Jaro-Winkler on lower-cased text."""
    return let(F.struct(F.lower(a).alias("a"), F.lower(b).alias("b")), lambda x: jaro_winkler_of(x["a"], x["b"]))


def _at_least(a: Column, b: Column, threshold: float) -> Column:
    """Similarity of at least a threshold above 0.7; lengths that cannot reach it are not compared."""
    # with all letters of the shorter in the longer and four equal first ones
    ratio = 3.0 * (threshold - 0.4) / 0.6 - 2.0
    la, lb = F.length(a), F.length(b)
    possible = F.least(la, lb) >= F.greatest(la, lb) * (ratio - 1e-9)
    return (a == b) | (possible & (jaro_winkler_of(a, b) >= threshold))


def _same_person(x: Column) -> Column:
    """Of a struct (text, search, text_parts, search_parts)."""
    parts, known = x["text_parts"], x["search_parts"]

    def enough(hits: Column) -> Column:
        return (hits >= 2) | ((hits == 1) & (F.size(parts) == 1))

    shared = F.size(F.array_intersect(parts, known))
    close = F.size(
        F.filter(parts, lambda t: F.exists(known, lambda s: _at_least(t, s, TOKEN_SIMILARITY)))
    )
    return enough(shared) | enough(close) | _at_least(x["search"], x["text"], NAME_SIMILARITY)


def words_match2(search: Column, text: Column) -> Column:
    """Two name spellings denote one person (pass the catalogue name first).

    Two shared parts are enough, or one when `text` has one part; then the same with
    similar parts; then very similar whole names. Not symmetric. For joining two name
    columns use `operators.fuzzy`, which does not compare all pairs.
    """
    s, t = name_order(search), name_order(text)
    sides = F.struct(
        F.lower(t).alias("text"),
        F.lower(s).alias("search"),
        name_tokens(t).alias("text_parts"),
        name_tokens(s).alias("search_parts"),
    )
    return F.when(text.isNotNull() & search.isNotNull(), let(sides, _same_person))


def register(spark) -> None:
    """Make the Python-backed functions usable from SQL text."""
    from rollbook.functions.stems import porter_stem_udf

    spark.udf.register("jaro_winkler", _jaro_winkler_udf)
    spark.udf.register("porter_stem", porter_stem_udf)
