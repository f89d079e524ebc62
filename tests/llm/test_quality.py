"""Counts against a plain definition; planted junk goes, clean documents stay."""

import math
import re
from collections import Counter

from rollbook.llm import quality
from rollbook.llm.queries import op7_quality_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    w = WORD.findall(text or "")
    windows = list(zip(w, w[1:], w[2:]))
    seen, inside = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(inside),
    )


def check(rows, texts):
    for r in rows:
        n, *_, repeats = want = plain(texts[r.doc_id])
        assert tuple(r[c] for c in quality.BASE) == want
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (r.base_failed and r.kept)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = op7_quality_rules(spark, SF).collect()
    assert len(rows) == len(docs)
    check(rows, {d.doc_id: d.text for d in docs})
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(r.kept, good[r.doc_id]) for r in rows if r.doc_id in good and not r.base_failed]
    assert all(kept for kept, q in judged if q == 1)
    assert not any(kept for kept, q in judged if q == 0)


def plain_limits(rows):
    """Group -> metric -> (low, high): exact quartiles blended by weight, no sketches."""
    values = {"": []}
    for r in rows:
        if r.base_failed:
            continue
        n = r.n_words
        v = (r.word_chars / n, r.n_symbols / n, r.n_dup_lines / r.n_lines, r.n_repeat_words / n)
        for key in ("", (r.lang,), (r.lang, r.source)):
            values.setdefault(key, []).append(v)
    blended = {}
    for key in sorted(values, key=len):
        cols = [sorted(c) for c in zip(*values[key])]
        n = len(values[key])
        own = [[c[math.ceil(p * n) - 1] for p in (0.25, 0.5, 0.75)] for c in cols]
        if key:
            above = blended[key[:-1] or ""]
            own = [[(n * n * a + 400 * b) / (n * n + 400) for a, b in zip(x, y)] for x, y in zip(own, above)]
        blended[key] = own
    out = {}
    for key, cols in blended.items():
        out[key] = [
            (q[1] - 6 * max(q[2] - q[1], s) if low else -1, q[1] + 6 * max(q[1] - q[0], s))
            for q, s, low in zip(cols, (0.5, 0.04, 0.08, 0.07), (True, False, False, False))
        ]
    return out


def check_verdicts(rows):
    limits = plain_limits(rows)
    for r in rows:
        if r.base_failed:
            assert not r.kept
            continue
        n = r.n_words
        v = (r.word_chars / n, r.n_symbols / n, r.n_dup_lines / r.n_lines, r.n_repeat_words / n)
        inside = [low <= x <= high for x, (low, high) in zip(v, limits[r.lang, r.source])]
        near = any(abs(x - y) < 1e-9 for x, lh in zip(v, limits[r.lang, r.source]) for y in lh)
        assert near or r.kept == all(inside)


def test_verdicts_follow_plain_thresholds(spark):
    check_verdicts(op7_quality_rules(spark, SF).collect())


def test_each_fence_rejects_by_itself(spark):
    def prose(i, n=100):
        return [f"w{i}a{j}" for j in range(n)]

    lines = lambda w: "\n".join(" ".join(w[k : k + 5]) for k in range(0, len(w), 5))
    rows = [(i, lines(prose(i)), "en", "s") for i in range(300)]
    odd = {
        1000: " ".join(f"wwwwwwwwwwwwww{j}" for j in range(100)),
        1001: " ".join("ab" if j % 2 else chr(97 + j % 25) + chr(97 + j // 25) for j in range(100)),
        1002: lines([f"{w}#" if j % 3 == 0 else w for j, w in enumerate(prose(7))]),
        1003: "\n".join(["same"] + [x for j in range(60) for x in (f"only{j}a{j}", "same")]),
        1004: " ".join(prose(3) + [w for j in range(38) for w in ("x1xxx", "y2yyy", "z3zzz", f"kkk{j}")]),
    }
    docs = spark.createDataFrame(
        rows + [(k, t, "en", "s") for k, t in odd.items()], "doc_id long, text string, lang string, source string"
    )
    got = quality.judge(quality.with_counts(docs)).collect()
    check_verdicts(got)
    limits, out = plain_limits(got)["en", "s"], {}
    for r in got:
        if r.doc_id >= 1000 and not r.base_failed:
            n = r.n_words
            v = (r.word_chars / n, r.n_symbols / n, r.n_dup_lines / r.n_lines, r.n_repeat_words / n)
            out[r.doc_id] = {k for k, (x, (low, high)) in enumerate(zip(v, limits)) if not low <= x <= high}
    assert {frozenset(x) for x in out.values()} >= {frozenset({k}) for k in range(4)}
    assert {r.doc_id for r in got if not r.kept} == set(out)


def test_no_size_is_a_switch(spark):
    """One more document moves the limits of a group a little, at any size."""
    schema = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, lang string, source string"
    row = lambda i, s: (100, 400 + 7 * i % 300, i % 9, i % 5, i % 30, 10, "en", s)
    others = [row(3 * i, "t") for i in range(500)]

    def high(n):
        counted = spark.createDataFrame(others + [row(i, "s") for i in range(n)], schema)
        return quality.thresholds(counted).where("source = 's'").first()

    for n in (4, 199):
        a, b = high(n), high(n + 1)
        for f in quality.FENCES:
            x, y = a[f"high_{f.metric}"], b[f"high_{f.metric}"]
            assert abs(x - y) <= 0.12 * max(x, y)


def test_edge_rows(spark):
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    texts = [None, "", " \t\n", "a b c", "a b c a b c", "a a a a a", "x\n\nx\n y\nx", "é ü a\rb", long,
             "one two three four " * 30, "clean words go here " + " ".join(f"k{i}" for i in range(90))]
    rows = [(i, t, None if i % 2 else "en", "s", "n", True) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_words string, kept boolean"
    docs = spark.createDataFrame(rows + rows[-1:], schema)
    got = quality.quality(docs).collect()
    assert len(got) == len(texts) + 1
    check(got, dict(enumerate(texts)))
    assert [r.kept for r in got if r.doc_id == len(texts) - 1] == [True, True]
    assert quality.quality(docs.limit(0)).count() == 0
    # fences follow each group: words of 20 letters are odd in one source and usual in another
    many = [(i, " ".join(f"{i}w{j}" + "z" * (16 if i % 2 else 0) for j in range(60)), "en", f"s{i % 2}")
            for i in range(400)]
    odd = [(999, " ".join(f"q{j}" + "z" * 16 for j in range(60)), "en", "s0")]
    got = quality.quality(spark.createDataFrame(many + odd, "doc_id long, text string, lang string, source string"))
    assert {r.doc_id for r in got.collect() if not r.kept} == {999}
