"""Explicit schemas; nothing is inferred, so `points` and `call_number` stay text."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _S) for n in names]


CLASS_FIELDS = (
    "class_id", "link", "course_code", "section_key", "instructor", "course_title",
    "course_subtitle", "course_descr", "department", "department_code", "scheduled_days",
    "scheduled_time_start", "scheduled_time_end", "location", "points", "type", "call_number",
    "campus", "method_of_instruction",
)

HISTORY = T.MapType(_S, _S)

LISTING = T.StructType(_strings("department_code", "term_month", "term_year", "raw_content"))

CLASS = T.StructType(
    _strings(*CLASS_FIELDS)
    + [
        T.StructField("prerequisites", T.ArrayType(T.ArrayType(_S))),
        T.StructField("open_to", T.ArrayType(_S)),
        T.StructField("enrollment", HISTORY),
    ]
)

ENROLLMENT = T.StructType(
    _strings("call_number", "course_code") + [T.StructField("enrollment", HISTORY)]
)

PERSON = T.StructType(
    _strings("name")
    + [
        T.StructField("departments", T.ArrayType(_S)),
        T.StructField("classes", T.ArrayType(T.StructType(_strings("term", "course_code")))),
    ]
)

REVIEW = T.StructType(
    [T.StructField("course_codes", T.ArrayType(T.StructType(_strings("c", "t"))))]
    + _strings("text", "workload")
    + [T.StructField("publish_date", T.DateType())]
    + [T.StructField(f"{n}_count", T.LongType()) for n in ("agree", "disagree", "funny")]
)

SCHOLAR = T.StructType(
    _strings("scholar_id")
    + [T.StructField("interests", T.ArrayType(_S))]
    + [
        T.StructField(n, T.IntegerType())
        for n in ("citedby", "citedby5y", "hindex", "hindex5y", "i10index", "i10index5y")
    ]
    + [T.StructField("cites_per_year", T.MapType(T.IntegerType(), T.IntegerType()))]
)

SEARCH_RESULTS = T.StructType(
    _strings("name", "department", "course_descr")
    + [
        T.StructField(
            "search_results",
            T.ArrayType(
                T.StructType(_strings("title", "snippet") + [T.StructField("label", T.IntegerType())])
            ),
        )
    ]
)

ARTICLE = T.StructType(
    _strings("name", "department", "course_descr", "wiki_title", "wiki_page")
    + [T.StructField("label", T.IntegerType())]
)

LAST_CHECK = T.StructType(_strings("name") + [T.StructField("last_check", T.LongType())])

SEARCH_PAYLOAD = T.StructType(
    [
        T.StructField(
            "query",
            T.StructType(
                [T.StructField("search", T.ArrayType(T.StructType(_strings("title", "snippet"))))]
            ),
        )
    ]
)

ARTICLE_PAYLOAD = T.StructType(
    [
        T.StructField(
            "query",
            T.StructType(
                [T.StructField("pages", T.MapType(_S, T.StructType(_strings("title", "extract"))))]
            ),
        )
    ]
)
