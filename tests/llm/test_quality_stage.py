"""What the quality stage leaves on disk."""

import corpus_pipeline
from rollbook.llm import quality

SF = "/root/testdata/sf0.001"


def test_quality_stage_stores_no_texts(spark, monkeypatch):
    held = []
    for module in (corpus_pipeline, quality):
        before = module.stored
        monkeypatch.setattr(module, "stored", lambda df, name, f=before: held.append(df) or f(df, name))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.quality_rules(spark, docs, SF)
    assert held and not {"doc", "text", "whole"} & {c for df in held for c in df.columns}
    want = quality.quality(docs).where("kept").select(*docs.columns)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
