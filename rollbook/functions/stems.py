"""Porter (1980) suffix stripping as a column expression, as SQL text and as a plain function.

A stem's measure is the number of its vowel-consonant changes.  The algorithm only asks whether it
is at least one or at least two, which a regular expression reads from the front of the stem: runs
of consonants and vowels have one reading, since `y` is a vowel after a consonant only.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.higher import let

# Suffix tables of the published algorithm (suffix, replacement).
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

# Common English words that carry no topic.
STOP_WORDS = tuple(
    """a about above after again against all am an and any are as at be because been before
    being below between both but by can did do does doing down during each few for from further
    had has have having he her here hers herself him himself his how i if in into is it its
    itself just me more most my myself no nor not now of off on once only or other our ours
    ourselves out over own same she should so some such than that the their theirs them
    themselves then there these they this those through to too under until up very was we were
    what when where which while who whom why will with you your yours yourself yourselves""".split()
)


def _shape(word: str) -> str:
    """Consonant/vowel pattern of a word, 'y' after a consonant being a vowel."""
    out = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and out[-1:] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _ends_cvc(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _swap(word: str, table: tuple[tuple[str, str], ...]) -> str:
    best = max((s for s, _ in table if word.endswith(s)), key=len, default=None)
    if best is not None:
        stem = word[: len(word) - len(best)]
        if _measure(stem) > 0:
            return stem + dict(table)[best]
    return word


def porter_stem(word: str) -> str:
    """Stem of one word; words of one or two letters stay as they are."""
    w = word.lower()
    if len(w) <= 2:
        return w
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]

    trimmed = None
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and "v" in _shape(w[:-2]):
        trimmed = w[:-2]
    elif w.endswith("ing") and "v" in _shape(w[:-3]):
        trimmed = w[:-3]
    if trimmed is not None:
        w = trimmed
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_consonant(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _ends_cvc(w):
            w += "e"

    if w.endswith("y") and "v" in _shape(w[:-1]):
        w = w[:-1] + "i"
    w = _swap(_swap(w, STEP2), STEP3)

    best = max((s for s in STEP4 if w.endswith(s)), key=len, default=None)
    if best is not None:
        stem = w[: len(w) - len(best)]
        if _measure(stem) > 1 and (best != "ion" or stem[-1:] in ("s", "t")):
            w = stem

    if w.endswith("e"):
        stem = w[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _ends_cvc(stem)):
            w = stem
    if _measure(w) > 1 and _double_consonant(w) and w.endswith("l"):
        w = w[:-1]
    return w


# Runs of letters: a vowel run starts with a vowel or with a y after a consonant.
_CONSONANTS, _VOWELS = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_TO_VOWEL = f"^(?:{_CONSONANTS}{_VOWELS}|[aeiou]+)"
ONE_CHANGE = f"{_TO_VOWEL}[^aeiou]"
TWO_CHANGES = f"{_TO_VOWEL}{_CONSONANTS}{_VOWELS}[^aeiou]"
HAS_VOWEL = f"^(?:[aeiou]|{_CONSONANTS}[aeiouy])"
# consonant, vowel, consonant of a word with one change
ONE_CVC = f"^{_CONSONANTS}[aeiouy][^aeiouwxy]$"
# a doubled y is a consonant by the parity of its run
DOUBLE_Y = "(?:(?:^|[aeiou])y|[^aeiouy])(?:yy)+$"


def _cut(word: Column, n: int) -> Column:
    return F.left(word, F.length(word) - n)


def _doubled(word: Column, but: str = "") -> Column:
    """Ends with a doubled consonant that is none of `but`."""
    last = F.right(word, F.lit(1))
    same = (F.length(word) > 1) & (last == F.substring(word, -2, 1))
    return same & (word.rlike(f"[^aeiouy{but}]$") | word.rlike(DOUBLE_Y))


def _longest(word: Column, suffixes, then) -> Column:
    """`then(suffix)` of the longest suffix of the word, else the word."""
    out = None
    for suffix in sorted(suffixes, key=len, reverse=True):
        ends = word.endswith(suffix)
        out = F.when(ends, then(suffix)) if out is None else out.when(ends, then(suffix))
    return out.otherwise(word)


def _plural(w: Column) -> Column:
    one = w.endswith("s") & ~w.endswith("ss")
    return F.when(w.endswith("sses") | w.endswith("ies"), _cut(w, 2)).when(one, _cut(w, 1)).otherwise(w)


def _past(w: Column) -> Column:
    def mended(t: Column) -> Column:
        short = t.rlike(ONE_CVC)
        add = t.endswith("at") | t.endswith("bl") | t.endswith("iz")
        drop = _doubled(t, "lsz")
        return F.when(add, F.concat(t, F.lit("e"))).when(drop, _cut(t, 1)).when(short, F.concat(t, F.lit("e"))).otherwise(t)

    return (
        F.when(w.endswith("eed"), F.when(_cut(w, 3).rlike(ONE_CHANGE), _cut(w, 1)).otherwise(w))
        .when(w.endswith("ed") & _cut(w, 2).rlike(HAS_VOWEL), let(_cut(w, 2), mended))
        .when(w.endswith("ing") & _cut(w, 3).rlike(HAS_VOWEL), let(_cut(w, 3), mended))
        .otherwise(w)
    )


def _final_y(w: Column) -> Column:
    return F.when(w.endswith("y") & _cut(w, 1).rlike(HAS_VOWEL), F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)


def _swapped(table: tuple[tuple[str, str], ...]):
    def step(w: Column) -> Column:
        def then(suffix: str) -> Column:
            stem = _cut(w, len(suffix))
            return F.when(stem.rlike(ONE_CHANGE), F.concat(stem, F.lit(dict(table)[suffix]))).otherwise(w)

        return _longest(w, dict(table), then)

    return step


def _stripped(w: Column) -> Column:
    def then(suffix: str) -> Column:
        stem = _cut(w, len(suffix))
        fits = stem.rlike(TWO_CHANGES)
        if suffix == "ion":
            fits &= stem.endswith("s") | stem.endswith("t")
        return F.when(fits, stem).otherwise(w)

    return _longest(w, STEP4, then)


def _final_e(w: Column) -> Column:
    stem = _cut(w, 1)
    drop = stem.rlike(TWO_CHANGES) | (stem.rlike(ONE_CHANGE) & ~stem.rlike(ONE_CVC))
    return F.when(w.endswith("e") & drop, stem).otherwise(w)


def _final_ll(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(TWO_CHANGES), _cut(w, 1)).otherwise(w)


STEPS = (_plural, _past, _final_y, _swapped(STEP2), _swapped(STEP3), _stripped, _final_e, _final_ll)


def stem_word(word: Column) -> Column:
    """Stem of a word, as `porter_stem`; a null word has none."""

    def after(w: Column, steps) -> Column:
        return let(steps[0](w), lambda v: after(v, steps[1:])) if steps else w

    lower = F.lower(word)
    return F.when(F.length(lower) <= 2, lower).otherwise(let(lower, lambda w: after(w, STEPS)))


def stem_sql(words: str) -> str:
    """CTEs (for DuckDB) over a CTE `words` (word); the last one, `stems`, has (word, stem)."""

    def cut(n: int) -> str:
        return f"left(w, length(w) - {n})"

    def has(text: str, pattern: str) -> str:
        return f"regexp_matches({text}, '{pattern}')"

    def longest(suffixes, then) -> str:
        ordered = sorted(suffixes, key=len, reverse=True)
        return "CASE " + " ".join(f"WHEN suffix(w, '{s}') THEN {then(s)}" for s in ordered) + " ELSE w END"

    def swap(table) -> str:
        return longest(dict(table), lambda s: f"CASE WHEN {has(cut(len(s)), ONE_CHANGE)} THEN {cut(len(s))} || '{dict(table)[s]}' ELSE w END")

    def strip(s: str) -> str:
        more = f" AND regexp_matches({cut(3)}, '[st]$')" if s == "ion" else ""
        return f"CASE WHEN {has(cut(len(s)), TWO_CHANGES)}{more} THEN {cut(len(s))} ELSE w END"

    double = f"(right(w, 1) = left(right(w, 2), 1) AND length(w) > 1 AND ({has('w', '[^aeiouylsz]$')} OR {has('w', DOUBLE_Y)}))"
    short, one, two = has("w", ONE_CVC), has(cut(1), ONE_CHANGE), has(cut(1), TWO_CHANGES)
    steps = (
        f"CASE WHEN suffix(w, 'sses') OR suffix(w, 'ies') THEN {cut(2)} WHEN suffix(w, 's') AND NOT suffix(w, 'ss') THEN {cut(1)} ELSE w END",
        f"CASE WHEN suffix(w, 'eed') THEN CASE WHEN {has(cut(3), ONE_CHANGE)} THEN {cut(1)} ELSE w END "
        f"WHEN suffix(w, 'ed') AND {has(cut(2), HAS_VOWEL)} THEN '+' || {cut(2)} "
        f"WHEN suffix(w, 'ing') AND {has(cut(3), HAS_VOWEL)} THEN '+' || {cut(3)} ELSE w END",
        "ltrim(w, '+')",
        f"CASE WHEN NOT trimmed THEN w WHEN {has('w', '(?:at|bl|iz)$')} THEN w || 'e' WHEN {double} THEN {cut(1)} WHEN {short} THEN w || 'e' ELSE w END",
        f"CASE WHEN suffix(w, 'y') AND {has(cut(1), HAS_VOWEL)} THEN {cut(1)} || 'i' ELSE w END",
        swap(STEP2), swap(STEP3), longest(STEP4, strip),
        f"CASE WHEN suffix(w, 'e') AND ({two} OR ({one} AND NOT {has(cut(1), ONE_CVC)})) THEN {cut(1)} ELSE w END",
        f"CASE WHEN suffix(w, 'll') AND {has('w', TWO_CHANGES)} THEN {cut(1)} ELSE w END",
    )
    ctes = [f"stem_0 AS (SELECT word, lower(word) AS w, false AS trimmed FROM {words})"]
    for k, step in enumerate(steps):
        ctes.append(f"stem_{k + 1} AS (SELECT word, {step} AS w, trimmed OR prefix(w, '+') AS trimmed FROM stem_{k})")
    ctes.append(
        "stems AS (SELECT word, CASE WHEN length(lower(word)) <= 2 THEN lower(word) ELSE w END AS stem "
        f"FROM stem_{len(steps)})"
    )
    return ",\n".join(ctes)


@F.pandas_udf(T.StringType())
def porter_stem_udf(words: pd.Series) -> pd.Series:
    known = {w: porter_stem(w) for w in words.dropna().unique()}
    return words.map(known)


def word_tokens(c: Column, remove_stop_words: bool = False) -> Column:
    """Words of a text, case kept; stop words are dropped by exact spelling."""
    tokens = F.filter(F.split(c, r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    if remove_stop_words:
        tokens = F.filter(tokens, lambda w: ~w.isin(*STOP_WORDS))
    return tokens


def word_tokens_sql(text: str) -> str:
    """`word_tokens` without stop words, for DuckDB."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"list_filter(regexp_split_to_array({text}, '[^\p{{L}}\p{{N}}_]+'), lambda x: x <> '' AND x NOT IN ({stops}))"
