"""Tests for the findings that round 3 left over."""

from pyspark.sql import functions as F

from rollbook.operators import features, jobs
from rollbook.plans import views as V
from rollbook.plans.q_pages import class_pages

SF = "/root/testdata/sf0.001"


def test_crawl_merge_parses_only_what_is_read(spark, monkeypatch):
    kept = []
    stored = jobs.stored
    monkeypatch.setattr(jobs, "stored", lambda df, name: kept.append(df.columns) or stored(df, name))
    pages = class_pages(spark, SF, classes=V.v_new(spark, SF))
    slim, whole = jobs.crawl_merge(pages, columns=["points"]), jobs.crawl_merge(pages)
    assert set(kept[0]) == {*jobs.MERGED, "points"} and {"prerequisites", "enrollment"} < set(kept[1])
    rows = lambda df: sorted(map(str, df.select(*sorted(kept[0])).collect()))
    assert rows(slim.classes) == rows(whole.classes)
    people = lambda df: sorted(map(str, df.collect()))
    assert people(slim.people) == people(whole.people)
    assert whole.enrollment.count() > 0 and slim.enrollment.count() == 0


def test_stem_overlap_joins_few_words(spark):
    cand = [("1", "A", "A x", "histories of physics"), ("1", "B", "B x", "physics"), ("2", "A", "A x", "the relics")]
    cand = spark.createDataFrame(cand, "id string, name string, found string, interests string")
    people = spark.createDataFrame([("A", "history"), ("B", "history")], "name string, department string")
    titles = spark.createDataFrame([("A", "a relic")], "name string, title string")
    out = features.stem_overlap(cand, people, titles)
    # a text meets the stems of the person of its own row, as in the SQL
    assert sorted((r.id, r.name, r.overlap) for r in out.collect()) == [
        ("1", "A", ["histori"]), ("1", "B", ["histori"]), ("2", "A", ["relic"])]
    plan = features.stem_table(cand.select(F.col("interests").alias("word")))._jdf.queryExecution().optimizedPlan()
    assert "RepartitionByExpression" in plan.toString()  # few bytes would be merged into one task
