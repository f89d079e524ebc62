"""Encoding against the tiktoken library; exact round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken

from rollbook.llm import bpe
from rollbook.llm.queries import op1_byte_bpe

FILE = public.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    with open(FILE, "rb") as f:
        return bpe.Vocabulary.from_file(f.read())


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(library, text):
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


def test_random_texts(vocabulary, library):
    encoder, rnd = bpe.Encoder(vocabulary, public.PATTERN), random.Random(1)
    letters = "aaaaabcé \n\t!?#12漢字😀'st\u0085\x1c　\xa0​Éß\x00"
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(2000)]
    texts += ["a" * 50_000, "", "<|endoftext|>", " " * 300 + "x"]
    assert list(encoder.encode_all(texts)) == [ids_of(library, t) for t in texts]
    assert all(encoder.decode(encoder.encode(t)) == t.encode() for t in texts)


def test_append_and_edit_equal_a_new_encoding(vocabulary):
    rnd = random.Random(2)
    draw = lambda n: bytes(rnd.randrange(97, 101) for _ in range(n))
    for _ in range(300):
        piece, more = draw(rnd.randint(0, 80)), draw(rnd.randint(0, 9))
        grown = bpe.PrefixEncoding(vocabulary, piece).append(more)
        assert grown.tokens() == bpe.PrefixEncoding(vocabulary, piece + more).tokens()
        start = rnd.randint(0, len(grown.piece))
        removed = rnd.randint(0, len(grown.piece) - start)
        want = grown.piece[:start] + more + grown.piece[start + removed :]
        grown.edit(start, removed, more)
        assert grown.piece == want
        assert grown.last == bpe.PrefixEncoding(vocabulary, want).last
    long = bpe.PrefixEncoding(vocabulary, draw(20_000))
    assert long.edit(100, 1, b"b") < 2_000


def test_query_and_edge_rows(spark, library):
    rows = {r.doc_id: r for r in op1_byte_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = ids_of(library, d.text)
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids) // 4 and r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()

    schema = "doc_id long, text string, id string, ids int"
    odd = spark.createDataFrame([(1, None, "x", 1), (1, "", "y", 2), (None, "ab", None, None)], schema)
    got = bpe.encode(odd, FILE, public.PATTERN)
    assert got.columns == ["doc_id", "ids"]
    assert {(r.doc_id, bytes(r.ids)) for r in got.collect()} == {(1, b""), (None, ids_of(library, "ab"))}
    assert got.count() == 3
    back = bpe.decode(got, FILE).collect()
    assert sorted(bytes(r.text_bytes) for r in back) == [b"", b"", b"ab"]
    empty = spark.createDataFrame([], schema)
    assert bpe.digests(empty, FILE, public.PATTERN).count() == 0
