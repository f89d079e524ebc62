"""Shards against a plain version, and what must hold for any table."""

import hashlib
import zlib
from collections import Counter

from pyspark.sql import functions as F

from rollbook.llm import all_queries, shards

SF = "/root/testdata/sf0.001"


def draw(value, seed):
    text = f"{seed}:{'' if value is None else value}"
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain(rows, k, seed=shards.SEED):
    """{id: (shard, slot)} of (id, source) with different ids."""
    by = {}
    for i, s in rows:
        by.setdefault(s, []).append((draw(i, seed), i))
    mixed = []
    for s, ids in by.items():
        u = draw(s, seed) / float(1 << 60)
        mixed += [((r + u) / len(ids), (s is not None, s or ""), i) for r, (_, i) in enumerate(sorted(ids))]
    out, n = {}, len(mixed)
    for at, (_, _, i) in enumerate(sorted(mixed)):
        shard = at * k // n
        out[i] = (shard, at - -(-shard * n // k))
    return out


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = all_queries()["op13_sharding"](spark, SF).collect()
    want = plain([(d.doc_id, d.source) for d in docs], 16)
    texts = {d.doc_id: (d.text or "").encode() for d in docs}
    assert len(got) == len(docs) == len(want)
    for r in got:
        assert (r.shard, r.slot) == want[r.doc_id]
        assert r["size"] == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        assert r.law == "rows" and r.grown_shard is None


def check(spark, rows, k):
    docs = spark.createDataFrame(rows, "doc_id long, source string, shard string, slot string, row string, at long")
    out = shards.shard_rows(docs.repartition(7), k)
    got = out.select("doc.*", F.col("shard").alias("k"), F.col("slot").alias("p")).collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter(rows)
    held = Counter(r.k for r in got)
    assert max(held.values()) - min(held.get(i, 0) for i in range(k)) <= 1
    for i in held:
        assert sorted(r.p for r in got if r.k == i) == list(range(held[i]))
    return got, out


def test_hot_source_small_sources_and_clashing_columns(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 30}", "mine", None, "x", -1) for i in range(900)]
    rows += [(5000 + i, f"alone{i}", None, "mine", "y", i) for i in range(64)]
    got, out = check(spark, rows, 8)
    n = Counter(r.source for r in got)
    for (shard, source), c in Counter((r.k, r.source) for r in got).items():
        assert abs(c - n[source] / 8) <= 2.5, (shard, source)
    alone = Counter(r.k for r in got if r.source.startswith("alone"))
    assert max(alone.values()) <= 20 and len(alone) == 8
    assert all(abs(r.n_rows - r.expected) <= 2.5 for r in shards.mixture(out).collect())
    again, _ = check(spark, rows[::-1], 8)
    place = lambda rs: {r.doc_id: (r.k, r.p) for r in rs}
    assert place(got) == place(again)


def test_nulls_repeats_few_and_no_rows(spark):
    check(spark, [(None, None, None, None, None, None)] * 40 + [(7, "a", "", "", "", 0)] * 25, 4)
    check(spark, [(1, "a", "", "", "", 0)], 16)
    docs = spark.createDataFrame([], "doc_id long, source string")
    assert shards.shard_rows(docs, 16).count() == 0


def test_written(spark, tmp_path):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).cast("string").alias("source"))
    out = shards.shard_rows(docs, 4)
    shards.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert Counter((r.doc.doc_id, r.shard, r.slot) for r in back) == Counter(
        (r.doc.doc_id, r.shard, r.slot) for r in out.collect()
    )
