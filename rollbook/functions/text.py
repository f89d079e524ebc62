"""Scalar text functions on Columns (all JVM-side, no Python per row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions.higher import let

# Course-code pattern, and the connectives that join codes.
PREREQUISITE_PATTERN = (
    r"([A-Z]{4} [A-Z][A-Z]?[0-9]{4}|[A-Z][A-Z]?[0-9]{4}|[oO][rR]|[aA][nN][dD])"
)
PREREQUISITE_PATTERN_WHOLE_WORDS = (
    r"([A-Z]{4} [A-Z][A-Z]?[0-9]{4}|[A-Z][A-Z]?[0-9]{4}|\b[oO][rR]\b|\b[aA][nN][dD]\b)"
)
# Fixed value: the line that separates a review from its workload note.
WORKLOAD_MARKER = "Workload:"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def words(c: Column) -> Column:
    """White-space separated words, without empty ones."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def course_code(department_code: Column, number: Column) -> Column:
    """'DEPT NUMBER'; null when either part is null."""
    return F.concat(department_code, F.lit(" "), number)


def clean_instructor(c: Column) -> Column:
    """First line of the field without trailing blanks and hyphens; '' stays ''."""
    return F.regexp_replace(F.trim(F.substring_index(c, "\n", 1)), r"[\s-]+$", "")


def schedule(c: Column) -> Column:
    """'TR 4:10pm-5:25pm\\nRoom' -> struct(days, start, end, location).

    A missing or malformed time part gives null times.
    """
    lines = F.split(c, "\n")
    first = words(F.get(lines, F.lit(0)))
    times = F.split(F.get(first, F.lit(1)), "-")
    whole = F.size(times) == 2
    return F.struct(
        F.get(first, F.lit(0)).alias("days"),
        F.when(whole, F.get(times, F.lit(0))).alias("start"),
        F.when(whole, F.get(times, F.lit(1))).alias("end"),
        F.get(lines, F.lit(1)).alias("location"),
    )


def split_strip_list(c: Column, sep: str = ",") -> Column:
    """Comma list -> trimmed array; null and '' give null."""
    return F.when(c != "", F.transform(F.split(c, sep), strip))


def prerequisites(c: Column, whole_words: bool = False) -> Column:
    """Course text -> AND of ORs of course codes.

    A connective before a code decides whether the code opens a new OR-list or joins
    the last one; after each code the default is AND again. By default 'or' and 'and'
    also count inside longer words ('for', 'standing').
    """
    pattern = PREREQUISITE_PATTERN_WHOLE_WORDS if whole_words else PREREQUISITE_PATTERN
    found = F.regexp_extract_all(c, F.lit(pattern), F.lit(1))
    start = F.struct(
        F.array().cast("array<array<string>>").alias("groups"), F.lit(False).alias("joining")
    )

    def step(state: Column, token: Column) -> Column:
        groups, joining = state["groups"], state["joining"]
        kind = F.lower(token)
        is_code = ~kind.isin("or", "and")
        grown = F.when(
            joining,
            F.transform(
                groups,
                lambda g, i: F.when(
                    i == F.size(groups) - 1, F.concat(g, F.array(token))
                ).otherwise(g),
            ),
        ).otherwise(F.concat(groups, F.array(F.array(token))))
        return F.struct(
            F.when(is_code, grown).otherwise(groups).alias("groups"),
            ((kind == "or") & (F.size(groups) > 0)).alias("joining"),
        )

    return F.aggregate(found, start, step, lambda state: state["groups"])


def flatten_join(c: Column, nested: bool = False, sep: str = "\n") -> Column:
    """Sorted list as one text; `nested` flattens a list of lists first."""
    return F.array_join(F.array_sort(F.flatten(c) if nested else c), sep)


def join_pairs(c: Column, fields: Sequence[str], sep: str = "\n") -> Column:
    """Array of structs as lines; the parts of each struct are sorted within the line."""
    return F.array_join(
        F.transform(c, lambda p: F.array_join(F.array_sort(F.array(*[p[f] for f in fields])), " ")),
        sep,
    )


def remove_tags(c: Column) -> Column:
    """Text without markup tags."""
    return F.regexp_replace(c, r"<[^>]*>", "")


def digits_int(c: Column) -> Column:
    """All digits of a text as one number; none gives 0."""
    return F.coalesce(F.regexp_replace(c, r"\D", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def split_at_marker(lines: Column, marker: str = WORKLOAD_MARKER) -> Column:
    """Lines -> struct(text, workload) around the first line equal to `marker`."""

    def cut(x: Column) -> Column:
        at = F.array_position(x, F.lit(marker)).cast("int")
        before = F.when(at > 0, F.slice(x, F.lit(1), at - 1)).otherwise(x)
        after = F.slice(x, at + 1, F.greatest(F.size(x) - at, F.lit(0)))
        return F.struct(
            F.array_join(before, "\n").alias("text"),
            F.when(at > 0, F.array_join(after, "\n")).alias("workload"),
        )

    return let(lines, cut)


def badge(c: Column) -> Column:
    """Gold or silver named in the text; silver wins when both are named."""
    up = F.upper(c)
    return F.when(up.contains("SILVER"), "silver").when(up.contains("GOLD"), "gold")


def award_line(c: Column) -> Column:
    """'YYYY - Name, rest' -> struct(year, name); null without ',' or without '-'."""
    head = F.substring_index(c, ",", 1)
    parts = F.split(head, "-", 2)
    usable = c.contains(",") & head.contains("-")
    return F.when(
        usable,
        F.struct(
            F.trim(F.get(parts, F.lit(0))).try_cast("int").alias("year"),
            strip(F.get(parts, F.lit(1))).alias("name"),
        ),
    )


def drop_initials(c: Column) -> Column:
    """Text without its one-character words."""
    return F.array_join(F.filter(words(c), lambda w: F.length(w) > 1), " ")


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; two empty texts are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / longest)


def _word_overlap(a: Column, b: Column, as_set: bool) -> tuple[Column, Column, Column, Column]:
    wa, wb = words(F.lower(a)), words(F.lower(b))
    if as_set:
        wa, wb = F.array_distinct(wa), F.array_distinct(wb)
    shared = F.aggregate(
        F.array_intersect(wa, wb),
        F.lit(0),
        lambda acc, w: acc
        + F.least(
            F.size(F.filter(wa, lambda x: x == w)), F.size(F.filter(wb, lambda x: x == w))
        ),
    )
    return shared, F.size(wa), F.size(wb), wa == wb


def jaccard_words(a: Column, b: Column, as_set: bool = False) -> Column:
    """Word overlap / union of two texts; repeated words count unless `as_set`."""
    shared, na, nb, same = _word_overlap(a, b, as_set)
    return F.when(same, F.lit(1.0)).otherwise(shared / (na + nb - shared))


def sorensen_words(a: Column, b: Column, as_set: bool = False) -> Column:
    """2 x word overlap / summed sizes; repeated words count unless `as_set`."""
    shared, na, nb, same = _word_overlap(a, b, as_set)
    return F.when(same, F.lit(1.0)).otherwise(2.0 * shared / (na + nb))


def sorted_list(c: Column) -> Column:
    """Sort a list column; lists of lists compare element by element, null stays null."""
    return F.array_sort(c)
