"""Fingerprints and components against a plain all-pairs version."""

import random
import re

import xxhash

from rollbook.llm import simhash
from rollbook.llm.components import components
from rollbook.llm.queries import op5_simhash_near_dedup

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def check(rows, texts):
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = plain_components(fps)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.fingerprint, r.component_id) == (f"{fps[r.doc_id]:016x}", want[r.doc_id])


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check(op5_simhash_near_dedup(spark, SF).collect(), {d.doc_id: d.text for d in docs})


def test_edge_rows(spark):
    texts = [None, "", " \n", "A", "a", "a b", "A  b", "a b c", "É a\rb\x0bc", "x y z " * 30_000, "漢 字 漢 字"]
    rows = [(i, t, "p", 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root int")
    check(simhash.near_groups(docs).collect(), dict(enumerate(texts)))
    odd = spark.createDataFrame([(None, "q r s"), (4, "q r s"), (4, "q r s"), (None, "t u v")], "doc_id long, text string")
    got = [(r.doc_id, r.component_id) for r in simhash.near_groups(odd).collect()]
    assert sorted(got, key=str) == [(4, 4), (4, 4), (None, 4), (None, None)]
    assert simhash.near_groups(docs.limit(0)).count() == 0


def test_links_reach_everything_at_two_bits(spark):
    rnd = random.Random(5)
    fps = {}
    for _ in range(40):  # clusters, chains and far points
        x = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 12)):
            fps[x] = x
            x ^= (1 << rnd.randrange(64)) | (1 << rnd.randrange(64))
            if rnd.random() < 0.3:
                x ^= 1 << rnd.randrange(64)
    signed = {x - (1 << 64) if x >> 63 else x: x for x in fps}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = simhash.links(df)
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in links.collect())
    root = {r.node: r.root for r in components(links).collect()}
    want = plain_components(signed)
    groups = {}
    for s in signed:
        groups.setdefault(want[s], set()).add(root.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_long_paths(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {i: 0 for i in range(61)} | {100: 100, 101: 100, 200: 150, 150: 150}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
