"""Every stage of the pipeline against a plain version on its own input."""

import numpy as np
import public_tokenizers as public
from test_similar import plain_kept
from test_suffix import plain
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from rollbook.llm import quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "repeats", "pack"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, tables = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = spark.createDataFrame(stage(spark, kept, SF).collect(), stage(spark, kept, SF).schema)
        tables[name] = kept.collect()
        if name != "pack":
            assert kept.columns == docs.columns

    judged = quality.quality(docs).where("kept").collect()
    assert {r.doc_id for r in tables["quality"]} == {r.doc_id for r in judged}
    last = {}
    for r in tables["quality"]:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert {(r.text, r.doc_id) for r in tables["exact"]} == set(last.items())
    assert len(tables["exact"]) == len(last)
    rows = tables["exact"]
    assert {r.doc_id for r in tables["near"]} == {rows[i].doc_id for i in plain_kept([(r.doc_id, r.text) for r in rows])}
    want = plain({r.doc_id: r.text for r in tables["near"]}, 100)
    before = {r.doc_id: r for r in tables["near"]}
    for r in tables["repeats"]:
        n, removed, *_ = want[r.doc_id]
        assert n - removed - 6 <= len(r.text.encode()) <= n - removed and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
    assert len(tables["repeats"]) == len(before)
    tok = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    by_doc = {}
    for r in sorted(tables["pack"], key=lambda r: r.piece):
        by_doc.setdefault(r.doc_id, []).append(bytes(r.ids))
    for r in tables["repeats"]:
        ids = tok.encode(r.text, add_special_tokens=False).ids + [2]
        assert np.frombuffer(b"".join(by_doc[r.doc_id]), "<u4").tolist() == ids


# columns that some operator has for itself
CLASHING = (
    "n_bytes", "none", "n_spans", "n_removed", "kept_sha256", "kept_text", "n_words", "n_lines", "kept",
    "base_failed", "__c", "__key", "__limits", "key", "id", "row", "ref", "rest", "doc", "whole", "digest",
    "root", "name", "check", "body", "length", "piece",
)


def test_columns_of_the_caller_come_back(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns(
        {c: F.concat(F.lit(f"{c} of "), "doc_id") for c in CLASHING}
    )
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF)
        if name == "pack":
            assert kept.count() >= docs.count()
            break
        assert kept.columns == docs.columns
        docs = spark.createDataFrame(kept.collect(), kept.schema)
        rows = docs.collect()
        assert rows and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in CLASHING)


def test_registered(spark):
    assert queries()["pipeline"](spark, SF).count() > 0


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
