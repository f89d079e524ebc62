"""Packing: the plan uses every piece once, near the lower bound; ids equal the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

from rollbook.llm import packing
from rollbook.llm.queries import op3_best_fit_packing

FILE = public.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    return lambda text: t.encode(text, add_special_tokens=False).ids + [2]


def check_plan(counts, capacity):
    used = Counter()
    patterns = packing.plan(counts, capacity)
    for lengths, times in patterns:
        assert times > 0 and 0 < sum(lengths) <= capacity
        for x in lengths:
            used[x] += times
    assert used == Counter({k: v for k, v in counts.items() if v})
    total = sum(k * v for k, v in counts.items())
    return sum(t for _, t in patterns), -(-total // capacity)


def test_plan():
    rnd = random.Random(3)
    for capacity in (1, 2, 7, 20, 100):
        for _ in range(60):
            draws = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 80))]
            n, least = check_plan(dict(Counter(draws)), capacity)
            assert n <= least * 1.7 + 1
    draws = Counter(min(1024, int(rnd.expovariate(1 / 400)) + 1) for _ in range(20_000))
    n, least = check_plan(dict(draws), 1024)
    assert n <= least * 1.005 + 1
    assert packing.plan({512: 7, 256: 4, 128: 1, 384: 1}, 1024) and packing.plan({}, 8) == []
    # exact combinations of two, three and four pieces
    for lengths in ((600, 424), (500, 300, 224), (400, 300, 200, 124)):
        assert packing.plan(dict(Counter(lengths)), 1024) == [(lengths, 1)]


def best_fit_decreasing(lengths, capacity):
    """Number of sequences when each piece, the longest first, goes where the least room is left."""
    room = [0] * (capacity + 1)
    used = 0
    for x in sorted(lengths, reverse=True):
        gap = next((g for g in range(x, capacity + 1) if room[g]), None)
        if gap is None:
            used, gap = used + 1, capacity
        else:
            room[gap] -= 1
        room[gap - x] += 1
    return used


def test_no_worse_than_best_fit():
    rnd = random.Random(5)
    for scale in (80, 250, 700):
        for n in (50, 400, 3000):
            lengths = [1 + min(1023, int(rnd.expovariate(1 / scale))) for _ in range(n)]
            used, _ = check_plan(dict(Counter(lengths)), 1024)
            assert used <= best_fit_decreasing(lengths, 1024)


def whole(rows, capacity):
    """Sequences are gapless from 0 and not over capacity."""
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for at in places.values():
        end = 0
        for offset, n in sorted(at):
            assert offset == end
            end += n
        assert end <= capacity
    return len(places)


def test_query(spark, library):
    rows = op3_best_fit_packing(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    by_doc, total = defaultdict(list), 0
    for r in rows:
        by_doc[r.doc_id].append(r)
    for d in docs:
        ids = library(d.text)
        total += len(ids)
        got = sorted(by_doc[d.doc_id], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in got] == [
            (k, s, n) for k, (s, n) in enumerate(packing.cut(len(ids), 1024))
        ]
        for r in got:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
    used = whole(rows, 1024)
    assert used <= -(-total // 1024) * 1.02 + 1
    assert used <= best_fit_decreasing([r.length for r in rows], 1024)


def test_edge_rows(spark, library):
    schema = "doc_id long, text string, length string, part int"
    texts = [None, "", "a b c " * 40, "a b c " * 40, "<|endoftext|>a <|endoftext|><|endoftext|> b <|endoftext", "x\u0085y\x1cz　\xa0​ \t\n  <|endoftext|>", "漢😀" * 9]
    odd = spark.createDataFrame([(i or None, t, "l", 7) for i, t in enumerate(texts)], schema)
    rows = packing.pack_documents(odd, FILE, capacity=16).collect()
    assert whole(rows, 16)
    for i, t in enumerate(texts):
        got = sorted((r for r in rows if r.doc_id == (i or None)), key=lambda r: r.piece)
        assert np.frombuffer(b"".join(r.ids for r in got), "<u4").tolist() == library(t or "")
    assert packing.pack_documents(spark.createDataFrame([], schema), FILE).count() == 0
