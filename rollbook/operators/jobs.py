"""Whole jobs, composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rollbook.operators import extract, merge
from rollbook.sources import scratch
from rollbook.sources.scratch import stored


# What the merge, the histories and the people of a crawl are keyed by or made of.
MERGED = ("term", "department_code", "course_code", "call_number", "department", "instructor")


@dataclass(frozen=True)
class Crawl:
    classes: DataFrame
    enrollment: DataFrame
    people: DataFrame


def crawl_merge(
    pages: DataFrame,
    old_classes: DataFrame | None = None,
    old_enrollment: DataFrame | None = None,
    previous_people: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> Crawl:
    """Class pages (term, url, html) -> class rows -> merge with what is stored -> people.

    Pages are parsed once into a stored table, and so are the merged classes; people are those of the
    merged classes and the people known before.  `columns` are the class columns that the caller reads (default: all);
    besides those that the merge and the people need, no other is parsed out of the pages.  New
    histories are there if `enrollment` is one of them.
    """
    records = extract.class_records(pages, carry=["term"]).drop("raw_content")
    if columns is not None:
        records = records.select(*[c for c in records.columns if c in MERGED or c in columns])
    merged = merge.merge_term(
        stored(records, "records"),
        old_classes,
        old_enrollment,
        dedupe_right=True,
        history_keys=("term", "call_number", "course_code"),
    )
    classes = scratch.stored(merged.classes, "merged")
    return Crawl(classes, merged.enrollment, merge.people_rollup(classes, previous_people))
