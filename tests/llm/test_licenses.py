"""Licence scan against a plain version."""

import re

import pytest

from rollbook.llm import licenses
from rollbook.llm.queries import op6_license_scan

SF = "/root/testdata/sf0.001"


def plain(text):
    clean = re.sub(r"[^\w\n]|_", " ", (text or "").lower())
    lines = clean.split("\n")
    parts = [p for p in re.split(r"\n\s*\n\s*", clean) if p.strip()]
    units = lines + [p for p in parts if "\n" in p.strip()] + ([clean] if len(parts) > 1 else [])
    found = []
    for u in units:
        a = set(licenses.bigrams(u.split()))
        best = max(
            (2 * len(a & set(b)) / (len(a) + len(b)), -k)
            for k, (_, t) in enumerate(licenses.TEMPLATES)
            for b in [licenses.bigrams(licenses.normal_words(t))]
        )
        if best[0] >= licenses.THRESHOLD:
            found.append(best)
    words, windows = clean.split(), []
    there = set(licenses.bigrams(words))
    for k, (_, t) in enumerate(licenses.TEMPLATES):
        own, n = set(licenses.bigrams(licenses.normal_words(t))), len(licenses.normal_words(t))
        if 3 * len(there & own) < len(own):
            continue  # no window can hold two thirds of the template
        for s in range(len(words) - n + 1):
            a = set(licenses.bigrams(words[s : s + n]))
            dice = 2 * len(a & own) / (len(a) + len(own))
            if dice >= licenses.THRESHOLD:
                windows.append((dice, -k))
    best = max(found + windows, default=None)
    return (licenses.TEMPLATES[-best[1]][0] if best else None), best and best[0], len(found), len(windows)


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        name, dice, n, windows = plain(texts[r.doc_id])
        assert (r.license, r.n_matches, r.n_windows) == (name, n, windows), texts[r.doc_id]
        assert r.dice is None if dice is None else r.dice == pytest.approx(dice)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check(op6_license_scan(spark, SF).collect(), {d.doc_id: d.text for d in docs})


def test_edge_rows(spark):
    isc = dict(licenses.TEMPLATES)["ISC"]
    texts = [None, "", "\n\n", "word", "Released under the MIT License.", "released  UNDER the mit-license", "Released under the MIT",
             "x\nReleased under the MIT License\ny\n\nLicensed under CC BY 4.0.", isc.replace(", ", ",\n"), "a b\n\n" + isc.replace(" ", "\n"),
             "Licensed under CC BY NC 4.0\nLicensed under CC BY 4.0", "the the " * 40_000, "Released under the MIT License. " * 30, "é_ü 漢 字"]
    docs = spark.createDataFrame([(i, t, "l", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, license string, dice double")
    got = licenses.scan(docs).collect()
    check(got, dict(enumerate(texts)))
    assert got[4].license == "MIT" and got[8].license == "ISC"
    twice = spark.createDataFrame([(None, texts[4]), (None, texts[4])], "doc_id long, text string")
    assert [r.license for r in licenses.scan(twice).collect()] == ["MIT", "MIT"]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_whole_texts_and_headers(spark):
    by_name = {}
    for name, text in licenses.TEMPLATES:
        by_name[name] = max(by_name.get(name, ""), text, key=len)
    filler = "some words of a page that stand before and after it\n" * 5
    texts, want = [], []
    for name, text in by_name.items():
        lines = "\n * ".join(text[i : i + 60] for i in range(0, len(text), 60))  # cut inside words too
        for made in (text, f"{name} License\n\nCopyright (c) 2020 A. Person\n\n{text}\n", f"{filler} {text} {filler}"):
            texts.append(made)
            want.append(name)
        texts.append(lines)
        want.append(None)
    texts += ["Welcome to our page. Released under the MIT License.", "the software " * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(licenses.scan(docs).collect(), key=lambda r: r.doc_id)
    for r, name in zip(got, want):
        assert name is None or (r.license == name and r.dice > 0.99 and r.n_windows), (name, r)
    assert got[-2].license == "MIT" and got[-2].n_matches == 0 and got[-1].license is None


def test_anchors_lose_nothing():
    for _, text in licenses.TEMPLATES:
        own = licenses.bigrams(licenses.normal_words(text))
        wanted = licenses.anchors(text, licenses.THRESHOLD)
        without = len(own) - len(wanted)  # a unit of exactly these shares the most it can without an anchor
        assert 2 * without / (len(own) + without) < licenses.THRESHOLD
