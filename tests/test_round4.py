"""Tests for the findings of round 3 taken up again: page trees, term files, class files, histories."""

import json

from pyspark.sql import functions as F

from rollbook.functions import terms
from rollbook.operators import merge
from rollbook.sources import readers, writers


def test_term_files_in_pieces(spark, tmp_path):
    rows = [(f"T{i % 3}", f"c{(i * 37) % 50:02d}", f"n{i}", 'a "q"\n') for i in range(400)] + [(None, "x", "y", "z")]
    df = spark.createDataFrame(rows, "term string, course string, number string, points string")
    for per_piece, folder in ((30, f"{tmp_path}/small"), (10_000, f"{tmp_path}/one")):
        out = writers.term_files(df, folder, order=["course"], rows_per_piece=per_piece)
        assert {r.name: r.n_rows for r in out.collect()} == {"T0.json": 134, "T1.json": 133, "T2.json": 133}
    for t in ("T0", "T1", "T2"):
        text = [(tmp_path / f / f"{t}.json").read_text() for f in ("small", "one")]
        assert text[0] == text[1] and len(json.loads(text[0])) == (134 if t == "T0" else 133)
    assert not [p for p in (tmp_path / "small").iterdir() if "parts" in p.name]
    back = readers.term_files(spark, f"{tmp_path}/small", df.drop("term").schema, array_files=True)
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(
        map(str, df.where("term IS NOT NULL").collect())
    )


def test_page_tree_is_listed_and_read_in_few_tasks(spark, tmp_path):
    pages = spark.range(300).select(
        F.lit("T").alias("term"), F.lit("D").alias("department_code"), F.col("id").cast("string").alias("class_id"),
        F.timestamp_seconds(F.lit(1_599_999_960)).alias("ts"), F.concat(F.lit("page "), "id").alias("raw_content"),
    )
    folder = str(tmp_path / "tree")
    writers.page_tree(pages, folder)
    spark.sparkContext.setJobGroup("list", "list")
    back = readers.raw_pages(spark, folder)
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("list") for s in status.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(s.numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism < 300
    assert sorted(map(str, back.collect())) == sorted(map(str, pages.collect()))


def test_json_by_term_is_compressed(spark, tmp_path):
    df = spark.range(500).select((F.col("id") % 3).cast("string").alias("term"), F.col("id").cast("string").alias("text"))
    for folder, options, end in (("a", {}, ".json.gz"), ("b", {"compression": "none"}, ".json")):
        writers.json_by_term(df, f"{tmp_path}/{folder}", **options)
        files = [p.name for p in (tmp_path / folder).glob("term=*/part-*")]
        assert files and all(f.endswith(end) for f in files)
        back = readers.term_partitions(spark, f"{tmp_path}/{folder}", df.select("text").schema)
        assert sorted(map(tuple, back.select("term", "text").collect())) == sorted(map(tuple, df.collect()))


def test_history_of_one_date_is_not_read(spark):
    """Its cut is the history itself, so the end of the term is not asked for."""
    one = spark.sql("SELECT map('2021-01-02', '1/9') AS h")
    cut = terms.map_cutoff(F.col("h"), F.raise_error(F.lit("read")).cast("date"))
    assert one.select(cut.alias("h")).first().h == {"2021-01-02": "1/9"}


def test_stored_value_wins_over_a_larger_new_one(spark):
    schema = "term string, call_number string, enrollment map<string,string>"
    day, later, late = "2021-01-02", "2021-02-02", "2029-01-01"
    new = [("2021-Fall", "a", {day: "9/9"}), ("2021-Fall", "b", {later: "9/9"}), ("2021-Fall", "c", {late: "3/9"}),
           ("2021-Fall", "d", {day: "10/9"}), ("2021-Fall", "d", {day: "9/9"})]
    old = [("2021-Fall", "a", {day: "1/9"}), ("2021-Fall", "b", {day: "1/9"})]
    out = merge.folded_histories(
        spark.createDataFrame(new, schema), spark.createDataFrame(old, schema), ["term", "call_number"]
    )
    assert {r.call_number: r.enrollment for r in out.collect()} == {
        "a": {day: "1/9"}, "b": {day: "1/9", later: "9/9"}, "c": {late: "3/9"}, "d": {day: "10/9"}}
