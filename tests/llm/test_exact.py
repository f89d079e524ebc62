"""Exact dedup against grouping in plain Python."""

import hashlib
from collections import defaultdict

from rollbook.llm import exact
from rollbook.llm.queries import op8_exact_dedup

SF = "/root/testdata/sf0.001"


def check(rows, texts):
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[t or ""].append(i)
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = groups[text]
        want = (max(ids), len(ids), r.doc_id == max(ids), hashlib.sha256(text.encode()).hexdigest())
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == want


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check(op8_exact_dedup(spark, SF).collect(), {d.doc_id: d.text for d in docs})


def test_block_borders_and_edge_rows(spark):
    base = "abcdefgh" * 9
    texts = ["", None, " ", base, base, base[:-1] + "x", base[:-1], base[:8], base[:9], "x" + base[1:], "é" * 8,
             "é" * 8, "ü" * 8, "abcdefghabcdefgh", "abcdefghabcdefgh", "abcdefghabcdefgX", base * 50, base * 50]
    rows = [(i, t, "n", 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string, row int")
    for size in (4, 8, 4096):
        check(exact.exact_groups(docs, block_bytes=size).collect(), dict(enumerate(texts)))
    # the names alone, without the checksum before them: same length, different blocks
    body = docs.selectExpr("doc_id AS row", "7L AS n_bytes", "CAST(coalesce(text, '') AS BINARY) AS body")
    names = {r.row: r.name for r in exact.identities(body.where("octet_length(body) = 72"), 8).collect()}
    assert len(set(names.values())) == 3 and names[3] == names[4]
    odd = spark.createDataFrame([(None, "a"), (None, "a"), (3, "a"), (3, "a"), (None, "b")], "doc_id long, text string")
    got = exact.exact_groups(odd).collect()
    assert sorted((r.doc_id is None, r.keep_id or 0, r.group_size, r.kept) for r in got) == [
        (False, 3, 4, False), (False, 3, 4, True), (True, 0, 1, True), (True, 3, 4, False), (True, 3, 4, False)
    ]
    assert exact.exact_groups(docs.limit(0)).count() == 0


def test_dedup_keeps_whole_rows(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (2, "a", "y"), (3, None, None), (4, "", "z"), (5, "b", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = sorted(tuple(r) for r in exact.exact_dedup(docs).collect())
    assert got == [(2, "a", "y"), (4, "", "z"), (5, "b", "w")]
