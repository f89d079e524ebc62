"""Checked values can be stored per term and merged; every rule runs once per distinct value."""

import random

from rollbook.operators import quality

CHECKS = [
    quality.regex_coverage("points", "^[0-9]$", 2, exceptions=["9"]),
    quality.typed("points", "bigint", 3),
    quality.in_set("kind", ["A", "B"]),
    quality.unique("note", 4),
]
SCHEMA = "term string, points string, kind string, note string"


def rows(rnd, terms, n):
    pick = lambda *x: rnd.choice([None, *x])
    return [(rnd.choice(terms), pick("1", "2", "9", "x", ""), pick("A", "B", "C"), pick(*"abcdefg")) for _ in range(n)]


def plain(data):
    out = {}
    for term in {r[0] for r in data}:
        points, kinds, notes = ({r[k] for r in data if r[0] == term} - {None} for k in (1, 2, 3))
        digits = {p for p in points - {"9"} if p in list("0123456789")}
        numbers = {p for p in points if p.isdigit()}
        out[term] = {
            "points:regex": (len(digits), len(points - {"9"}), len(digits) >= 2),
            "points:type": (len(numbers), len(points), len(numbers) >= 3 and numbers == points),
            "kind:in_set": (len(kinds & {"A", "B"}), len(kinds), {"A", "B"} <= kinds),
            "note:unique": (len(notes), len(notes), len(notes) >= 4),
        }
    return out


def shown(report):
    out = {}
    for r in report.collect():
        out.setdefault(r.term, {})[r.check] = (r.observed, r.distinct_values, r.ok)
    return out


def test_merged_parts_report_like_the_whole(spark):
    rnd = random.Random(2)
    first, second = rows(rnd, ["s", "t", None], 30), rows(rnd, ["t", "u"], 20) + [("w", None, None, None)]
    frames = [spark.createDataFrame(x, SCHEMA) for x in (first, second)]
    whole = frames[0].unionByName(frames[1])
    assert shown(quality.run_checks(whole, CHECKS)) == plain(first + second)
    parts = [quality.checked_values(f, CHECKS) for f in frames]
    assert shown(quality.report_values(quality.merge_values(*parts), CHECKS)) == plain(first + second)
    # a term that is crawled again replaces its values alone
    again = [r for r in second if r[0] == "t"]
    kept = parts[0].where("term <=> 's' OR term IS NULL")
    changed = quality.checked_values(spark.createDataFrame(again, SCHEMA), CHECKS)
    now = [r for r in first if r[0] != "t"] + again
    assert shown(quality.report_values(quality.merge_values(kept, changed), CHECKS)) == plain(now)


def test_no_rows_and_missing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.run_checks(empty, CHECKS).count() == 0
    other = spark.createDataFrame([("s", 1)], "term string, x int")
    assert {r.observed for r in quality.run_checks(other, CHECKS).collect()} == {0}
