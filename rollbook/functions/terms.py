"""Terms, dates and enrollment histories as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions.higher import let

# The enrollment sentence, and the month-day on which each term ends.
ENROLLMENT_PATTERN = r"^(\d+) [^\d]+(\((\d+)[^\d]+\))?[^\d]+"
ENROLLMENT_DATE_PATTERN = (
    r"as of\s*\d{1,2}:\d{2}[AaPp][Mm] [A-Za-z]+, ([A-Za-z]+ \d{1,2}, \d{4})\s*$"
)
TERM_ENDS = {"spring": (5, 20), "summer": (8, 20), "fall": (12, 26)}
LONG_DATE_FORMAT = "MMMM d, yyyy"

_TERM = r"([\p{L}\p{N}_]+)(\p{Nd}{4})"


def _group(c: Column, pattern: str, i: int) -> Column:
    """Capture group, or null where the pattern or the group did not match."""
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))


def split_term(c: Column) -> Column:
    """'SPRING2020' -> struct('Spring', '2020')."""
    return F.struct(
        F.initcap(_group(c, _TERM, 1)).alias("month"), _group(c, _TERM, 2).alias("year")
    )


def normalize_term(c: Column) -> Column:
    """'SPRING2020' -> '2020-Spring'; null when it is no term."""
    parts = split_term(c)
    return F.concat(parts["year"], F.lit("-"), parts["month"])


def term_end_date(term: Column) -> Column:
    """Rough last day of 'YYYY-Month'; null (no cut-off) for other terms."""
    year = F.substring_index(term, "-", 1).try_cast("int")

    def of(season: Column) -> Column:
        end = F.lit(None).cast("date")
        for name, (month, day) in TERM_ENDS.items():
            end = F.when(season == name, F.make_date(year, F.lit(month), F.lit(day))).otherwise(end)
        return end

    return let(F.lower(F.get(F.split(term, "-", 2), F.lit(1))), of)


def parse_date_long(c: Column) -> Column:
    """'May 20, 2021' -> date; null when unreadable."""
    return F.try_to_date(F.trim(c), LONG_DATE_FORMAT)


def parse_enrollment(c: Column) -> Column:
    """'N students (M max) as of 12:04PM Thursday, May 20, 2021' -> struct(date, cur, max)."""
    cur = _group(c, ENROLLMENT_PATTERN, 1)
    date_text = F.when(cur.isNotNull(), _group(c, ENROLLMENT_DATE_PATTERN, 1))
    return F.struct(
        parse_date_long(date_text).alias("date"),
        cur.try_cast("int").alias("cur"),
        _group(c, ENROLLMENT_PATTERN, 3).try_cast("int").alias("max"),
    )


def enrollment_map(date: Column, cur: Column, maximum: Column) -> Column:
    """One-entry history {ISO date: 'cur/max'} with '?' for unknown; null date gives {}."""
    unknown = F.lit("?")
    entry = F.create_map(
        date.cast("string"),
        F.concat(
            F.coalesce(cur.cast("string"), unknown),
            F.lit("/"),
            F.coalesce(maximum.cast("string"), unknown),
        ),
    )
    return F.when(date.isNotNull(), entry).otherwise(empty_history())


def empty_history() -> Column:
    return F.create_map().cast("map<string,string>")


def map_overlay(new: Column, old: Column) -> Column:
    """Union of two histories; on the same key the old value wins; null counts as empty."""

    def joined(sides: Column) -> Column:
        new_, old_ = sides["new"], sides["old"]
        only = F.map_filter(new_, lambda k, _: ~F.map_contains_key(old_, k))
        none = lambda m: m.isNull() | (F.size(m) == 0)
        both = F.when(none(old_), new_).when(none(new_), old_).otherwise(F.map_concat(only, old_))
        return F.coalesce(both, empty_history())

    return let(F.struct(new.alias("new"), old.alias("old")), joined)


def map_cutoff(history: Column, end: Column) -> Column:
    """Drop dates after `end`; if nothing stays, keep the earliest. Unreadable dates stay.

    So a history of one date stays as it is, and its date need not be read.
    """

    def cut(of: Column) -> Column:
        dates = of["history"]

        def keep(k: Column, _v: Column) -> Column:
            return F.coalesce(~(k.try_cast("date") > of["end"]), F.lit(True))

        earliest = lambda: let(
            F.array_min(F.map_keys(dates)), lambda first: F.map_filter(dates, lambda k, _: k == first)
        )
        return let(
            F.map_filter(dates, keep), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(earliest())
        )

    several = let(F.struct(history.alias("history"), end.alias("end")), cut)
    return F.when(F.size(history) == 1, history).otherwise(several)


def map_text(m: Column) -> Column:
    """A map as one comparable text: entries sorted by key, 'k=v' joined by ';'."""
    return F.array_join(
        F.transform(
            F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
        ),
        ";",
    )
