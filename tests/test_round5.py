"""Tests for the findings of round 4: disk that the merges hold while they run."""

import os
import time

from pyspark.sql import functions as F

from rollbook.operators import jobs, stored as stored_terms
from rollbook.plans import q_streams
from rollbook.sources.buckets import CODEC, SHUFFLE_CLEANUP
from rollbook.sources.scratch import scratch_dir, stored
from rollbook.streaming import incremental

SCHEMA = (
    "term string, department_code string, course_code string, call_number string, instructor string, "
    "department string, enrollment map<string,string>"
)


def crawl(spark, n=40):
    rows = [
        (f"202{i % 2}-Fall", "AB"[i % 3 == 0], f"c{i % 7}", str(i), f"P{i % 5}", "Dep", {"2020-10-01": f"{i}/50"})
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = [f.getName() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left(spark, before):
    """Shuffle files that stay; Spark deletes them in a thread of its own."""
    for _ in range(50):
        if not (found := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return found


def test_stored_leaves_no_shuffle_files(spark):
    was = [spark.conf.get(k, None) for k in (SHUFFLE_CLEANUP, CODEC)]
    before = shuffle_files(spark)
    counts = spark.range(1000).groupBy(F.col("id") % 7).count()  # a plan that is still referred to keeps its files
    kept = stored(counts, "few")
    assert not left(spark, before)
    assert kept.count() == counts.count() == 7
    assert [spark.conf.get(k, None) for k in (SHUFFLE_CLEANUP, CODEC)] == was


def test_three_crawls_leave_the_tables_only(spark):
    root = scratch_dir(spark, "upsert")
    full = stored(crawl(spark), "crawl")
    job = incremental.TermUpsert(root, compact_every=2)
    handled = []

    def handle(batch, batch_id):
        before = shuffle_files(spark)
        incremental.TermUpsert.handle(job, batch, batch_id)
        handled.append(left(spark, before))

    job.handle = handle
    q_streams._three_crawls(job, full, F.col("department_code") != "B", root)
    assert handled == [set(), set(), set()]
    folder = root.removeprefix("file:")
    assert not os.path.exists(f"{folder}/in") and not os.path.exists(full.stored_at.removeprefix("file:"))
    assert job.classes(spark).count() == job.enrollment(spark).count() == 40
    seen = {r.call_number: r.enrollment for r in job.enrollment(spark).collect()}
    assert seen["7"] == {"2020-10-01": "7/50"}
    assert {r.name for r in job.people(spark).collect()} == {f"P{i}" for i in range(5)}


def test_batch_repeated_after_its_classes_were_replaced(spark, tmp_path, monkeypatch):
    """A failure between the two tables: the repeated batch ends as one that never failed."""
    first, second = crawl(spark), crawl(spark, 9).where("department_code = 'A'")
    jobs_ = [incremental.TermUpsert(f"{tmp_path}/{x}") for x in "ab"]
    for job in jobs_:
        job.handle(first, 0)
    stage = incremental.TermUpsert._stage

    def fails(self, df, name):
        if name == "enrollment":
            raise OSError("lost")
        stage(self, df, name)

    monkeypatch.setattr(incremental.TermUpsert, "_stage", fails)
    try:
        jobs_[0].handle(second, 1)
    except OSError:
        pass
    monkeypatch.setattr(incremental.TermUpsert, "_stage", stage)
    for job in jobs_:
        job.handle(second, 1)
    for table in ("classes", "enrollment", "people"):
        a, b = (sorted(map(str, getattr(job, table)(spark).collect())) for job in jobs_)
        assert a == b and a


def test_merged_terms_are_copied_one_table_at_a_time(spark, monkeypatch):
    """The copy of the classes goes before the histories are written."""
    rows = crawl(spark)
    kept = stored_terms.StoredTerms(spark, scratch_dir(spark, "terms"), rows.schema, buckets=2)
    there, copies = [], []

    def copy(df, name):
        copies.append(stored(df, name))
        return copies[-1]

    replace = stored_terms.BucketedTable.replace_terms

    def replaced(self, *args):
        there.append(sum(os.path.exists(c.stored_at.removeprefix("file:")) for c in copies))
        before = shuffle_files(spark)
        replace(self, *args)
        assert not left(spark, before)

    monkeypatch.setattr(stored_terms, "stored", copy)
    monkeypatch.setattr(stored_terms.BucketedTable, "replace_terms", replaced)
    kept.merge(rows)
    assert there == [2, 1]
    assert kept.histories().count() == kept.classes.read().count() == 40
    kept.close()


def test_merged_classes_are_stored_once(spark, monkeypatch):
    """People and classes of a crawl read one table, so that the merge is not computed for each."""
    made = []
    monkeypatch.setattr(jobs.scratch, "stored", lambda df, name: (made.append(name), stored(df, name))[1])
    url, cells = "https://d.example.org/subj/X/W1/", "<tr><th>Department</th><td>Dep</td></tr><tr><th>Instructor</th><td>Ann</td></tr>"
    pages = spark.createDataFrame([("2020-Fall", url, f"<h1>t</h1><table>{cells}</table>")], "term string, url string, html string")
    old = crawl(spark).drop("enrollment")
    done = jobs.crawl_merge(pages, old, columns=old.columns)
    assert made == ["merged"]
    assert done.classes.count() == 41
    assert {r.name for r in done.people.collect()} == {"Ann", *(f"P{i}" for i in range(5))}


def test_line_items_are_spread_before_the_joins(spark, tmp_path):
    """While they are numbers: a shuffled page row holds no text made by the view."""
    from rollbook.plans import q_pages

    sf = "/root/testdata/sf0.001"
    plan = q_pages.class_pages(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan.split("RebalancePartitions")[1]
    assert plan.count("RebalancePartitions") == 1 and "Join" not in dealt.split("Relation")[0]
