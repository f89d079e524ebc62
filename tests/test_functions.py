import datetime as dt
import random
import re
from urllib.parse import quote_plus, urljoin

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollbook.functions import names, stems, terms, text, urls, vectors

L = F.lit

# Pairs of spellings and whether they name one person.
NAME_PAIRS = [
    ("Zhi Li", "Ying, Zhiliang", False),
    ("Zhi Li", "Li, Zhi", True),
    ("Zhi V Li", "Li, Zhi", True),
    ("Zhi Li", "Li, Zhi V", True),
    ("Iuri Bauler Pereira", "Iuri Pereira", True),
    ("Dragomir R. Radev", "Dragomir Radev", True),
    ("Dolores Barbazan Capeans", "Dolores Capeáns", True),
    ("Begona Alberdi", "Begoña Alberdi", True),
    ("Hee Jin Kim", "Hee-Jin Kim", True),
    ("Aise Johan de Jong", "Aise de Jongs", True),
    ("J.C. Salyer", "J.C. Salyer", True),
    ("Antoni Fernandez Parera", "Antonio Parera", True),
    ("Julien Dub Dat", "Dubedat, Julien", True),
    ("Frances Negr N-Muntaner", "Negron-Muntaner, Frances", True),
    ("Alfred Mac Adam", "MacAdam, Alfred", True),
]


def test_name_pairs(spark):
    df = spark.createDataFrame(NAME_PAIRS, "a string, b string, want boolean")
    got = df.select("a", "want", names.words_match2(F.col("a"), F.col("b")).alias("got")).collect()
    assert [r for r in got if r.want != r.got] == []


@pytest.mark.parametrize(
    "line, want",
    [
        ("0 students (10 max) as of 12:04PM Thursday, May 20, 2021", (dt.date(2021, 5, 20), 0, 10)),
        ("0 students as of  8:04AM Saturday, May 22, 2021", (dt.date(2021, 5, 22), 0, None)),
        ("", (None, None, None)),
        ("axcvse", (None, None, None)),
    ],
)
def test_enrollment_text(value, line, want):
    assert tuple(value(terms.parse_enrollment(L(line)))) == want


def test_enrollment_map(value):
    day = L("2021-05-20").cast("date")
    none = L(None).cast("int")
    assert value(terms.enrollment_map(day, L(3), none)) == {"2021-05-20": "3/?"}
    assert value(terms.enrollment_map(L(None).cast("date"), L(3), L(4))) == {}


def test_terms(value):
    assert value(*[terms.normalize_term(L(t)) for t in ("Summer2020", "SPRING2020", "Fall2019")]) == (
        "2020-Summer", "2020-Spring", "2019-Fall",
    )
    assert value(terms.term_end_date(L("2020-Fall"))) == dt.date(2020, 12, 26)
    assert value(terms.term_end_date(L("2020-Winter"))) is None


def test_prerequisite_golden(value):
    one = (
        "Prerequisites: (COMS W3134) or (COMS W3137) C programming language and Unix systems "
        "programming. Also covers Git, Make, TCP/IP networking basics, C++ fundamentals."
    )
    assert value(text.prerequisites(L(one))) == [["COMS W3134", "COMS W3137"]]
    two = "Prerequisites: (COMS W3134) and (COMS W3137) blah blah blah"
    assert value(text.prerequisites(L(two))) == [["COMS W3134"], ["COMS W3137"]]
    inside = "COMS W3134 needed for COMS W3137"
    assert value(text.prerequisites(L(inside))) == [["COMS W3134", "COMS W3137"]]
    assert value(text.prerequisites(L(inside), whole_words=True)) == [["COMS W3134"], ["COMS W3137"]]


def test_prerequisite_random(spark):
    """Against the definition: a code joins the last list iff the token before it is 'or'."""
    rng = random.Random(7)
    words = ["COMS W3134", "MATH V1101", "W4156", "or", "and", "for", "standing", "x", "OR", "And"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(400)]

    def plain(t):
        groups, before = [], ""
        for tok in re.findall(text.PREREQUISITE_PATTERN, t):
            if tok.lower() not in ("or", "and"):
                if before == "or" and groups:
                    groups[-1].append(tok)
                else:
                    groups.append([tok])
            before = tok.lower()
        return groups

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", text.prerequisites(F.col("t")).alias("g")).collect()
    assert all(r.g == plain(r.t) for r in got)


def test_map_overlay_golden(value):
    new = F.create_map(L("2021-06-12"), L("10/15"))
    old = F.create_map(L("2021-06-15"), L("9/15"))
    assert value(terms.map_overlay(new, old)) == {"2021-06-12": "10/15", "2021-06-15": "9/15"}
    same = F.create_map(L("2021-06-12"), L("old"))
    assert value(terms.map_overlay(new, same)) == {"2021-06-12": "old"}
    none = L(None).cast("map<string,string>")
    assert value(terms.map_overlay(none, old), terms.map_overlay(new, none)) == (
        {"2021-06-15": "9/15"}, {"2021-06-12": "10/15"},
    )


def test_map_overlay_and_cutoff_random(spark):
    rng = random.Random(3)
    days = [f"2021-0{m}-1{d}" for m in range(1, 9) for d in range(4)] + ["junk"]

    def some():
        return {k: str(rng.randint(0, 9)) for k in rng.sample(days, rng.randint(0, 5))}

    rows = [(some(), some()) for _ in range(300)]
    df = spark.createDataFrame(rows, "n map<string,string>, o map<string,string>")
    end = L("2021-05-20").cast("date")
    got = df.select(
        "n", "o", terms.map_overlay(F.col("n"), F.col("o")).alias("m"), terms.map_cutoff(F.col("n"), end).alias("c")
    ).collect()
    for r in got:
        assert r.m == {**r.n, **r.o}
        kept = {k: v for k, v in r.n.items() if k == "junk" or k <= "2021-05-20"}
        if r.n and not kept:
            first = min(r.n)
            kept = {first: r.n[first]}
        assert (r.c or {}) == kept


def test_url_join(spark):
    bases = ["http://x.com/a/b.html", "http://x.com", "http://x.com/a/b/?q=1#f", "https://x.com/a//b"]
    hrefs = ["c.html", "/c/d", "../c", "//y.com/z", "?z=1", "#g", "", "./../c/./d/", "../../../q", "mailto:z@y",
             "..", "c//d", "/c//d/../e?x=/../y#z", "http://o.org/p", "."]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    got = df.select("b", "h", urls.url_join(F.col("b"), F.col("h")).alias("u")).collect()
    assert [(r.b, r.h, r.u) for r in got if r.u != urljoin(r.b, r.h)] == []


def test_quote_plus(value):
    s = "aé*~ -_.(x)/:+%&"
    assert value(urls.quote_plus(L(s))) == quote_plus(s)


def test_url_parts(value):
    assert tuple(value(urls.listing_parts(L("http://c/sel/CO_MS_Fall2020.html")))) == ("CO_MS", "Fall2020")
    assert tuple(value(urls.url_tail(L("http://x/subj/COMS/W1002-20203-001/")))) == ("W1002-20203-001", "COMS")


def test_small_text(value):
    assert tuple(value(text.schedule(L("TR 4:10pm-5:25pm\n825 Mudd")))) == ("TR", "4:10pm", "5:25pm", "825 Mudd")
    assert tuple(value(text.schedule(L("TR")))) == ("TR", None, None, None)
    assert value(text.clean_instructor(L("Nuria O Pell - \ne-mail"))) == "Nuria O Pell"
    assert value(text.badge(L("Gold and silver")), text.badge(L("gold")), text.badge(L("x"))) == (
        "silver", "gold", None,
    )
    assert tuple(value(text.award_line(L("1999 - John X Doe, Physics")))) == (1999, "John X Doe")
    assert value(text.award_line(L("1999 John"))) is None
    assert value(text.drop_initials(L("John X  Doe"))) == "John Doe"
    assert value(text.digits_int(L("a12b3")), text.digits_int(L(""))) == (123, 0)
    marked = F.array(*[L(x) for x in ("a", "b", "Workload:", "c")])
    assert tuple(value(text.split_at_marker(marked))) == ("a\nb", "c")
    assert tuple(value(text.split_at_marker(F.array(L("a"))))) == ("a", None)
    assert value(text.jaccard_words(L("a b b"), L("b b c"))) == 0.5
    assert value(text.jaccard_words(L("a b b"), L("b b c"), as_set=True)) == pytest.approx(1 / 3)
    assert value(text.levenshtein_similarity(L(""), L(""))) == 1.0


def test_vectors(value):
    m = F.create_map(L("a"), L(3))
    assert value(vectors.dict_vector(m, ["d", "b", "c", "a"])) == [3, 0, 0, 0]
    assert value(vectors.dict_vector(F.create_map(L("c"), L(2), L("z"), L(88)), ["a", "b", "c", "d"])) == [0, 0, 2, 0]
    assert value(vectors.argmax(F.array(L(1.0), L(5.0), L(5.0)))) == 1


def test_porter():
    known = {
        "caresses": "caress", "ponies": "poni", "agreed": "agre", "plastered": "plaster", "hopping": "hop",
        "filing": "file", "happy": "happi", "relational": "relat", "digitizer": "digit", "hopefulness": "hope",
        "electriciti": "electr", "adjustment": "adjust", "adoption": "adopt", "controll": "control", "rate": "rate",
    }
    assert {w: stems.porter_stem(w) for w in known} == known


def test_accents(value):
    assert value(names.fold_accents(L("Žofia Łuß Æsop é ñ"))) .startswith("Zofia Luss")
    assert value(names.name_tokens(L("J.C. Salyer-Émile"))) == ["salyer", "emile"]


def test_stem_expression_and_sql_equal_the_plain_stemmer(spark):
    rng = random.Random(3)
    ends = [s for s, _ in stems.STEP2 + stems.STEP3] + [*stems.STEP4, "ed", "ing", "eed", "sses", "ies", "y", "yy", "e", "ll", ""]
    stem = lambda: "".join(rng.choice("aeioybtlszwxykc") for _ in range(rng.randint(0, 6)))
    words = {stem() + rng.choice(ends) + rng.choice(["", "", "s", "ed", "ing", "y"]) for _ in range(5000)}
    words |= {"y" * k + e for k in range(8) for e in ("", "ed", "ing", "y")}
    words |= {"Élan", "ab1ing", "x_ying", "x" * 50_000 + "ing", "ay" * 30_000 + "ed"}
    rows = spark.createDataFrame([(w,) for w in words] + [(None,)], "word string")
    out = rows.select("word", stems.stem_word(F.col("word")).alias("stem"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    want = {w: stems.porter_stem(w) for w in words}
    assert {r.word: r.stem for r in out.collect()} == want | {None: None}
    words_table = pd.DataFrame({"word": sorted(words)})  # noqa: F841
    got = duckdb.sql(f"WITH {stems.stem_sql('words_table')} SELECT word, stem FROM stems").fetchall()
    assert dict(got) == want
