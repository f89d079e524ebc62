"""Data-quality checks on the distinct non-null values of columns.

A suite is one job: the checked columns are turned into (group, column, value) rows, made
distinct by digest with map-side folding. The report has
one row per group and check: observed, required, ok.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules a stored term must meet.
COURSE_CODE = r"^[\w_]{4} (\w{1,3}\d{2,4}|\dX+)\w{0,2}_?$"
COURSE_TITLE = r"^...+$"
CLOCK_TIME = r"^\d{1,2}:\d{2}(am|pm)$"
DAYS = r"^(M|T|W|R|F|S|U){1,7}$"
CLASS_ID = r"^[\w\d]{5,6}-\d{5}-[\w\d]{3}$"
POINTS = r"^\d{1,2}(\.\d)?(-\d{1,2}(\.\d)?)?$"
CAMPUSES = ("Morningside", "Barnard College", "Presbyterian Hospital")
DEPARTMENTS = ("Electrical Engineering", "Computer Science", "Physics")
DEPARTMENT_CODES = ("ANTH", "COMS", "PHYS", "HIST", "POLI", "RUSS")
BADGES = ("gold", "silver")
UNPLACED = ("To be announced",)
UNPLACED_EXEMPT_TERMS = ("2021-Fall",)
CLASS_TYPES = ("DISCUSSION", "LECTURE", "SEMINAR")


@dataclass(frozen=True)
class Check:
    """One rule on one column; `good` says which distinct values count."""

    name: str
    column: str
    required: int
    kind: str
    arg: object = None
    exceptions: tuple[str, ...] = ()
    exempt: tuple[str, ...] = ()

    def considered(self, v: Column) -> Column:
        return ~v.isin(*self.exceptions) if self.exceptions else F.lit(True)

    def good(self, v: Column) -> Column:
        if self.kind == "regex":
            return v.rlike(f"(?U){self.arg}")  # letters and digits of every script
        if self.kind == "in_set":
            return v.isin(*self.arg)
        if self.kind == "type":
            return v.try_cast(str(self.arg)).isNotNull()
        return F.lit(True)


def regex_coverage(
    column: str, pattern: str, required: int, exceptions: Sequence[str] = (), name: str | None = None
) -> Check:
    """At least `required` distinct values match; other values are ignored."""
    return Check(name or f"{column}:regex", column, required, "regex", pattern, tuple(exceptions))


def in_set(
    column: str,
    expected: Sequence[str],
    required: int | None = None,
    exempt: Sequence[str] = (),
    name: str | None = None,
) -> Check:
    """At least `required` of the expected values occur (default: all of them)."""
    n = len(expected) if required is None else required
    if not 0 < n <= len(expected):
        raise ValueError(f"{column}: required must be between 1 and {len(expected)}")
    return Check(name or f"{column}:in_set", column, n, "in_set", tuple(expected), (), tuple(exempt))


def typed(column: str, sql_type: str, required: int, name: str | None = None) -> Check:
    """Every distinct value has the type, and there are at least `required`."""
    return Check(name or f"{column}:type", column, required, "type", sql_type)


def unique(column: str, required: int, name: str | None = None) -> Check:
    """At least `required` distinct values."""
    return Check(name or f"{column}:unique", column, required, "unique")


def term_checks(
    badge_column: str = "instructor_review_badge", count_column: str = "instructor_reviews_count"
) -> list[Check]:
    """The rules of a stored term; enrichment columns are named by the caller."""
    return [
        regex_coverage("course_code", COURSE_CODE, 25),
        regex_coverage("course_title", COURSE_TITLE, 25),
        unique("course_descr", 25),
        unique("instructor", 25),
        regex_coverage("scheduled_time_start", CLOCK_TIME, 2, [""]),
        regex_coverage("scheduled_time_end", CLOCK_TIME, 2, [""]),
        regex_coverage("scheduled_days", DAYS, 1),
        typed("call_number", "bigint", 10),
        in_set("campus", CAMPUSES, 1),
        regex_coverage("class_id", CLASS_ID, 25),
        in_set("department", DEPARTMENTS, 1),
        in_set("department_code", DEPARTMENT_CODES, 3),
        in_set(badge_column, BADGES, 1),
        typed(count_column, "double", 10),
        in_set("location", UNPLACED, exempt=UNPLACED_EXEMPT_TERMS),
        regex_coverage("points", POINTS, 4),
        in_set("type", CLASS_TYPES, 1),
    ]


def checked_values(df: DataFrame, checks: Sequence[Check], by: str = "term") -> DataFrame:
    """(by, column, d1, d2, n_bits, g_bits): the distinct values of every group and checked column,
    known by digests, with the checks that count them and those that they pass.

    Each rule runs once per distinct value. Columns that are only counted go into the shuffle as
    digests, those with rules as texts. The values of a group do not depend on other groups, so a
    stored table of them is kept up to date by replacing the groups that changed, and rows that
    came to a group by adding theirs (`merge_values`).
    """
    columns = sorted({c.column for c in checks if c.column in df.columns})
    cells = []
    for k, name in enumerate(columns):
        value = F.col(name).cast("string")
        counted = all(c.kind == "unique" and not c.exceptions for c in checks if c.column == name)
        digest = (F.xxhash64(value), F.xxhash64(F.lit(1), value)) if counted else (F.lit(0), F.lit(0))
        cells.append(
            F.struct(
                F.lit(k).alias("column"),
                (F.lit(None).cast("string") if counted else value).alias("value"),
                digest[0].cast("bigint").alias("d1"),
                digest[1].cast("bigint").alias("d2"),
                value.isNotNull().alias("some"),
            )
        )
    if not cells:
        no = F.lit(0).cast("bigint")
        cells = [F.struct(F.lit(-1).alias("column"), F.lit(None).cast("string").alias("value"), no.alias("d1"), no.alias("d2"), F.lit(False).alias("some"))]
    # a null is one value that no check counts, so a group of nothing else is there too
    values = df.select(by, F.inline(F.array(*cells))).distinct()
    value, bits = F.col("value"), {"n_bits": F.lit(0).cast("bigint"), "g_bits": F.lit(0).cast("bigint")}
    for k, name in enumerate(columns):
        own = {"n_bits": F.lit(0).cast("bigint"), "g_bits": F.lit(0).cast("bigint")}
        for i, c in enumerate(checks):
            if c.column == name:
                # a value that is only counted is not there as a text
                mine = F.col("some") & F.coalesce(value.isNull() | c.considered(value), F.lit(False))
                good = F.coalesce(mine & (value.isNull() | c.good(value)), F.lit(False))
                own["n_bits"] += F.when(mine, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0))
                own["g_bits"] += F.when(good, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0))
        bits = {n: F.when(F.col("column") == k, own[n]).otherwise(bits[n]) for n in bits}
    digests = {
        "d1": F.when(value.isNull(), F.col("d1")).otherwise(F.xxhash64(value)),
        "d2": F.when(value.isNull(), F.col("d2")).otherwise(F.xxhash64(F.lit(1), value)),
    }
    return values.select(by, "column", *[x.alias(n) for n, x in (digests | bits).items()])


def merge_values(*parts: DataFrame) -> DataFrame:
    """The checked values of tables whose rows belong together, from those of each."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.distinct()


def run_checks(df: DataFrame, checks: Sequence[Check], by: str = "term") -> DataFrame:
    """Report (by, check, observed, distinct_values, required, ok) for every group."""
    return report_values(checked_values(df, checks, by), checks, by)


def report_values(values: DataFrame, checks: Sequence[Check], by: str = "term") -> DataFrame:
    """The report of `checked_values`, or of several of them merged."""
    aggs = []
    for i in range(len(checks)):
        bit = F.lit(1 << i).cast("bigint")
        aggs.append(F.count_if(F.col("n_bits").bitwiseAND(bit) != 0).alias(f"n{i}"))
        aggs.append(F.count_if(F.col("g_bits").bitwiseAND(bit) != 0).alias(f"g{i}"))
    counted = values.groupBy(by).agg(*aggs)

    rows = []
    for i, c in enumerate(checks):
        n, good = F.col(f"n{i}"), F.col(f"g{i}")
        ok = good >= c.required
        if c.kind == "type":
            ok = ok & (good == n)
        exempt = F.col(by).isin(*c.exempt) if c.exempt else F.lit(False)
        rows.append(
            F.struct(
                F.lit(c.name).alias("check"),
                good.alias("observed"),
                n.alias("distinct_values"),
                F.lit(c.required).alias("required"),
                (ok | exempt).alias("ok"),
            )
        )
    return counted.select(by, F.inline(F.array(*rows)))


def suite_result(report: DataFrame, by: str = "term") -> DataFrame:
    """Whether all checks of all groups hold, and there is at least one group."""
    return report.agg(
        F.count_distinct(by).alias("groups"),
        F.count_if(~F.col("ok")).alias("failed"),
        ((F.count_if(~F.col("ok")) == 0) & (F.count_distinct(by) > 0)).alias("passed"),
    )


