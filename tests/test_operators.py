import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rollbook.functions import names as N
from rollbook.operators import evaluate, extract, filters, fuzzy, joins, labelling, merge, ordered, quality

RNG = random.Random(11)


# ---- fuzzy -------------------------------------------------------------------------


def _names(n):
    first = "Tolva Tolvah Enni Hennie Orb Oreb Ku Mei Ruñela Runela Iré Ba-Lin Balin".split()
    last = "Vask Vasck Tordáns Tordans Quellira Quelira Dorn Pim Oc Reth OcReth Sabor-Tunel".split()
    out = set()
    while len(out) < n:
        f, m, s = RNG.choice(first), RNG.choice(["", "V ", "Ku "]), RNG.choice(last)
        name = f"{f} {m}{s}" if RNG.random() < 0.6 else f"{s}, {f} {m}".strip()
        if RNG.random() < 0.3:
            i = RNG.randrange(len(name))
            name = name[:i] + RNG.choice("abcdé ") + name[i + RNG.randint(0, 1) :]
        out.add(name if RNG.random() < 0.95 else RNG.choice(first))
    return sorted(out)


def test_fuzzy_join_equals_brute_force(spark):
    c = spark.createDataFrame([(x,) for x in _names(120)], "name string")
    f = spark.createDataFrame([(x,) for x in _names(120)], "award string")
    all_pairs = c.crossJoin(f).filter(N.words_match2(F.col("name"), F.col("award")))
    want = {tuple(r) for r in all_pairs.select("name", "award").collect()}
    assert {tuple(r) for r in fuzzy.fuzzy_pairs(c, "name", f, "award").collect()} == want
    first = {r[0]: (r[1], r[2]) for r in fuzzy.fuzzy_first(c, "name", f, "award").collect()}
    by = {}
    for name, award in want:
        by.setdefault(award, set()).add(name)
    assert first == {a: (min(s), len(s) > 1) for a, s in by.items()}


@pytest.mark.parametrize("threshold", [0.95, 0.97])
def test_similar_pairs_lose_nothing(spark, threshold):
    def near(w):
        w = list(w)
        for _ in range(RNG.randint(0, 3)):
            i = RNG.randrange(len(w) + 1)
            r = RNG.random()
            if r < 0.35 and w:
                w.pop(min(i, len(w) - 1))
            elif r < 0.7:
                w.insert(i, RNG.choice("abcdefgh"))
            elif len(w) > 1:
                j = min(i, len(w) - 2)
                w[j], w[j + 1] = w[j + 1], w[j]
        return "".join(w) or "a"

    base = ["".join(RNG.choices("abcdefgh", k=RNG.randint(1, 24))) for _ in range(40)]
    a = sorted({near(b) for b in base for _ in range(6)})
    b = sorted({near(x) for x in base for _ in range(6)})
    want = {(x, y) for x in a for y in b if N.jaro_winkler(x, y) >= threshold}
    left = spark.createDataFrame([(x,) for x in a], "x string")
    right = spark.createDataFrame([(x,) for x in b], "y string")
    got = fuzzy.similar_pairs(left, right, threshold).collect()
    assert {(r.a, r.b) for r in got} == want


# ---- ordered -----------------------------------------------------------------------


def _events(spark, n=600):
    """A third of all rows belong to one key."""
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "hot" if RNG.random() < 0.34 else f"k{RNG.randint(0, 9)}"
        rows.append((key, start + dt.timedelta(minutes=RNG.randint(0, 9000)), i, RNG.choice("abc")))
    return rows, spark.createDataFrame(rows, "key string, ts timestamp_ntz, id int, content string")


def test_change_detect(spark):
    rows, df = _events(spark)
    last, want = {}, set()
    for key, _, i, content in sorted(rows, key=lambda r: (r[1], r[2])):
        if last.get(key) != content:
            want.add(i)
        last[key] = content
    got = ordered.change_detect(df, ["key"], "ts", "id", "content")
    assert {r.id for r in got.collect()} == want


def test_carry_skip_and_positions(spark):
    names = [RNG.choice("xyz") for _ in range(500)]
    answers = [RNG.choice(["na", "y", "n"]) for _ in range(500)]
    df = spark.createDataFrame(
        [("f", i, n, a) for i, (n, a) in enumerate(zip(names, answers))], "b string, pos int, name string, ans string"
    )
    said, want = None, {}
    for i, (n, a) in enumerate(zip(names, answers)):
        want[i] = said == n
        if a == "na":
            said = n
    got = ordered.carry_skip(df, ["b"], "pos", "name", "ans", piece_rows=17)
    assert {r.pos: r.auto_false for r in got.collect()} == want
    placed = ordered.positions(df, "pos", buckets=8)
    assert all(r.position == r.pos + 1 and r.position_total == 500 for r in placed.collect())


def test_walks(spark):
    rows = [("q", 1, 0, "a"), ("q", 2, 1, "b"), ("q", 3, 2, "c"), ("q", 4, 1, "d"), ("p", 1, 1, "e"), ("p", 2, 0, "f")]
    df = spark.createDataFrame(rows, "query string, rank int, label int, t string")
    got = ordered.first_relevant(df, ["query"], "rank", "label")
    assert {r.t for r in got.collect()} == {"b", "c", "e"}
    kinds = ordered.candidates_until_found(df, ["query"], "rank", F.col("label") == 2, F.col("label") == 1)
    assert {(r.t, r.kind) for r in kinds.collect()} == {("b", "unsure"), ("c", "found"), ("e", "unsure")}


def test_one_version_per_minute(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    rows = [("k", t, 1, "a"), ("k", t + dt.timedelta(seconds=30), 2, "b"), ("k", t + dt.timedelta(minutes=1), 3, "a")]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id int, content string")
    kept = ordered.change_detect(df, ["key"], "ts", "id", "content")
    assert {r.id for r in ordered.one_per_minute(kept, ["key"], "ts", "id").collect()} == {2, 3}


# ---- merge and joins ---------------------------------------------------------------


def _crawl(spark, rows):
    return spark.createDataFrame(
        rows, "term string, department_code string, department string, course_code string, call_number string, "
        "instructor string, enrollment map<string,string>",
    )


def test_merge_is_idempotent_and_adds_dates(spark):
    day = {"2021-06-12": "10/150"}
    rows = [
        ("2021-Summer", "A", "Dep A", "A 1", "1", "Ann", day),
        ("2021-Summer", "B", "Dep B", "B 1", "2", "Bob", day),
        ("2020-Spring", "B", "Dep B", "B 1", "3", "", {}),
    ]
    first = merge.merge_term(_crawl(spark, rows))
    again = merge.merge_term(_crawl(spark, rows), first.classes, first.enrollment)
    assert sorted(first.enrollment.collect(), key=str) == sorted(again.enrollment.collect(), key=str)
    assert again.classes.count() == 3
    assert again.enrollment.count() == 2  # the empty history is dropped

    moved = [rows[0][:6] + ({"2021-06-10": "101/150"},)]
    third = merge.merge_term(_crawl(spark, moved), again.classes, again.enrollment)
    assert third.classes.count() == 3  # department B and the other term stay
    one = third.enrollment.filter("call_number = '1'").collect()[0]
    assert one.enrollment == {"2021-06-12": "10/150", "2021-06-10": "101/150"}
    people = merge.people_rollup(again.classes)
    assert people.select("name").collect() and {r.name for r in people.collect()} == {"Ann", "Bob"}


def test_left_join_multiplies_unless_deduped(spark):
    new = _crawl(spark, [("t", "A", "D", "A 1", "1", "x", {"2021-01-01": "a"})])
    old = _crawl(spark, [("t", "A", "D", "A 1", "1", "x", {"2021-01-02": v}) for v in "bc"])
    assert merge.overlay_enrollment(new, old).count() == 2
    folded = merge.overlay_enrollment(new, old, dedupe_right=True).collect()
    assert len(folded) == 1 and folded[0].enrollment == {"2021-01-01": "a", "2021-01-02": "c"}


def test_updates(spark):
    people = spark.createDataFrame(
        [("Ann", ["X", "Y"], "old", "gold"), ("Bob", ["Z"], None, "gold")],
        "name string, departments array<string>, link string, badge string",
    )
    links = spark.createDataFrame(
        [("Ann", "Q; Y", "new1", 1), ("Ann", "X", "new2", 2), ("Ann", "Q", "no", 3), ("Bob", "Y", "no", 1)],
        "name string, department string, link string, seq int",
    )
    got = {r.name: r.link for r in joins.overlap_update(people, links, ["seq"]).collect()}
    assert got == {"Ann": "new2", "Bob": None}
    upd = spark.createDataFrame([("Ann", "silver", 1), ("Ann", None, 2)], "name string, badge string, seq int")
    badges = {r.name: r.badge for r in joins.equi_update(people, upd, ["badge"], ["seq"]).collect()}
    assert badges == {"Ann": None, "Bob": "gold"}
    classes = spark.createDataFrame([("Ann", None), ("Bob", "kept"), (None, None)], "instructor string, f string")
    filled = joins.enrich(classes, people, {"link": "f", "absent": "g"})
    assert {(r.instructor, r.f, r.g) for r in filled.collect()} == {
        ("Ann", "old", None), ("Bob", "kept", None), (None, None, None),
    }


def test_stale_days_are_repeatable_and_in_range(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    days = df.select(filters.due_days(F.col("k"), 15, 45).alias("d")).collect()
    assert {r.d for r in days} == set(range(15, 46))


# ---- quality, evaluation, labels ---------------------------------------------------


def test_checks(spark):
    rows = [("t", "1:10pm", "gold", "1"), ("t", "2:10pm", None, "2"), ("t", "late", "tin", "x"), ("u", "", None, None)]
    df = spark.createDataFrame(rows, "term string, start string, badge string, n string")
    checks = [
        quality.regex_coverage("start", quality.CLOCK_TIME, 2, [""]),
        quality.in_set("badge", quality.BADGES, 1),
        quality.typed("n", "int", 2),
        quality.unique("missing", 1),
    ]
    got = {(r.term, r.check): (r.observed, r.ok) for r in quality.run_checks(df, checks).collect()}
    assert got["t", "start:regex"] == (2, True)
    assert got["t", "badge:in_set"] == (1, True)
    assert got["t", "n:type"] == (2, False)
    assert got["u", "start:regex"] == (0, False)
    assert got["t", "missing:unique"] == (0, False)
    with pytest.raises(ValueError):
        quality.in_set("badge", quality.BADGES, 3)


def test_evaluation_matches_counts(spark):
    y = [RNG.randint(0, 2) for _ in range(300)]
    p = [v if RNG.random() < 0.6 else RNG.randint(0, 2) for v in y]
    s = [round(RNG.random(), 2) for _ in y]
    df = spark.createDataFrame(list(zip(range(300), y, p, s)), "i int, y int, p int, s double")
    acc = evaluate.accuracy_f1(df, "y", "p").collect()[0]
    assert acc.accuracy == pytest.approx(sum(a == b for a, b in zip(y, p)) / 300)
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a != 1]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert evaluate.roc_auc(df, "s", F.col("y") == 1).collect()[0].auc == pytest.approx(auc)


def test_answers(spark):
    want = {
        ("0, 2", 3): [1, 0, 1], ("n", 2): [0, 0], ("m1", 2): [0, 2], ("m", 1): [2], ("p", 1): [1],
        ("m", 2): None, ("1,n", 3): None, ("5", 2): None, ("m9", 2): None, ("", 1): None,
    }
    df = spark.createDataFrame(list(want), "a string, n int")
    got = df.select("a", "n", labelling.answer_labels(F.col("a"), F.col("n")).alias("x")).collect()
    assert {(r.a, r.n): r.x.labels if r.x.valid else None for r in got} == want


# ---- extraction --------------------------------------------------------------------

PAGE = """<html><body><table><tr><td>Menu</td></tr></table><!-- <tr><th>Points</th><td>9</td></tr> -->
<h1>Weaving &amp; Dyeing</h1><h3>Workshop</h3><table class="facts">
<tr><{c}>Points</{c}><td>1 <i>or</i> 2</td></tr>
<tr id=a><{c}>Call Number</{c}><td>70707</td></tr>
<tr><{c}>Day &amp; Time<br>Location</{c}><td>MW 9:05am-9:55am<br>HALL &Eacute; 7</td></tr>
<tr><{c}>Instructor</{c}><td><b>N&uacute;ria O&#8217;Pell</b> - <a href="mailto:n@example.org">mail</a></td></tr>
<tr><{c}>Course Description</{c}><td>Looms. Prerequisites: (ARTX W1000) or the instructor's permission.</td></tr>
<tr><{c}>Department</{c}><td><div><a href="/d">Textile &#x41;rts</a></div></td></tr>
<tr><{c}>Enrollment</{c}><td>7 students (12 max) as of 9:00AM Monday, March 4, 2024</td></tr>
<tr><{c}>Number</{c}><td>W2002</td></tr><tr><{c}>Open To</{c}><td>First School, Second School:Evening</td></tr>
</table></body></html>"""


@pytest.mark.parametrize("cell", ["th", "td"])
def test_class_page(spark, cell):
    url = "http://dir.example.org/subj/ARTX/W2002-20241-003/"
    pages = spark.createDataFrame([(url, PAGE.replace("{c}", cell))], "url string, html string")
    r = extract.class_records(pages).collect()[0]
    assert (r.class_id, r.course_code, r.call_number) == ("W2002-20241-003", "ARTX W2002", "70707")
    assert (r.instructor, r.department) == ("Núria O’Pell", "Textile Arts")
    assert (r.course_title, r.course_subtitle, r.points.split()) == ("Weaving & Dyeing", "Workshop", ["1", "or", "2"])
    assert (r.scheduled_days, r.scheduled_time_start, r.location) == ("MW", "9:05am", "HALL É 7")
    assert r.open_to == ["First School", "Second School:Evening"]
    assert r.prerequisites == [["ARTX W1000"]]
    assert r.enrollment == {"2024-03-04": "7/12"}
    assert r.campus is None and r.type is None


def test_listing_page(spark):
    html = """<tr><td><a href="/home">Home</a></td></tr><tr><td><a href="/cu/subj/COMS/W1002-20203-001/">Section</a>
    </td><td><a href='/cu/subj/OTHER/x/'>again</a></td></tr>"""
    pages = spark.createDataFrame([("http://h.org/cu/sel/COMS_Fall2020.html", html)], "url string, html string")
    assert [tuple(r) for r in extract.listing_links(pages).collect()] == [
        ("COMS", "Fall", "2020", "http://h.org/cu/subj/COMS/W1002-20203-001/")
    ]
