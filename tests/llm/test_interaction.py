"""The filter audit against its SQL, plain sets and edge cases."""

import random
from itertools import permutations

from rollbook.llm import interaction


def plain_fails(rows):
    """Letters that (id, text) rows fail, by the plain definition."""
    out = []
    for i, text in rows:
        text = text or ""
        words = [w for w in text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
        f = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        f += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text))
        f += "D" * any(c in "#$%&*|" for c in text)
        f += "E" * (i is not None and any(j is not None and j < i and (t or "") == text for j, t in rows))
        out.append(f)
    return out


def plain(rows, labels):
    """{(part, order, step): figures} of (id, text, part) rows."""
    fails = plain_fails([(i, t) for i, t, _ in rows])
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = {}
    for part in {p or "" for *_, p in rows}:
        of = [(f, i in good, i in toxic) for f, (i, _, p) in zip(fails, rows) if (p or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            kept = of
            for step, x in enumerate(order, 1):
                lost = [r for r in kept if x in r[0]]
                kept = [r for r in kept if x not in r[0]]
                shapley[x] += len(lost)
                failing = sum(x in f for f, *_ in of)
                out[part, order, step] = [
                    len(kept), len(lost), failing - len(lost), sum(f == x for f, *_ in of),
                    sum(g for _, g, _ in lost), sum(t for *_, t in lost),
                ]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(shapley[order[step - 1]])
    return out


def check(spark, rows, labels):
    docs = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "doc_id long, text string, source string, part string, row int"
    )
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in interaction.audit(docs, marks).collect()}
    assert got == plain(rows, labels)


def test_random_rows(spark):
    rnd = random.Random(3)
    texts = [None, "", " \n", "a" * 5000, "é Ü   x" * 60, "no break here " * 30]
    for _ in range(60):
        words = rnd.choices([f"w{i}" for i in range(rnd.choice([5, 60, 500]))], k=rnd.choice([3, 49, 50, 80]))
        if rnd.random() < 0.3:
            words[0] = rnd.choice(["#", "ABCDEFGH" * 9, "100%"])
        texts.append(rnd.choice(" \t\r").join(words))
    ids = [None, None, *range(40), 7, 7, *range(100, 130)]
    rows = [(i, rnd.choice(texts), rnd.choice(["s", "t", None, ""])) for i in ids]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in [None, 3, 3, *range(0, 140, 3)]]
    check(spark, rows, labels)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(docs, marks).count() == 0
    check(spark, [(1, None, None)], [])


def test_merges():
    rnd = random.Random(5)
    for _ in range(300):
        lists = [
            sorted(rnd.sample(range(rnd.choice([20, 200])), rnd.randint(0, 20))) for _ in range(rnd.randint(0, 5))
        ]
        assert interaction.union(lists) == sorted(set().union(*lists))
        for a in lists:
            for b in lists:
                assert interaction.difference(a, b) == sorted(set(a) - set(b))
                assert interaction.common(a, b) == len(set(a) & set(b))
