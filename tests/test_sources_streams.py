import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook import schemas
from rollbook.operators import merge, models
from rollbook.sources import readers, writers
from rollbook.sources.scratch import scratch_dir
from rollbook.streaming import incremental

SMALL = T.StructType([T.StructField("call_number", T.StringType()), T.StructField("points", T.StringType())])


def test_missing_files_are_empty(spark, tmp_path):
    for read in (readers.json_records, readers.json_lines, readers.csv_table):
        df = read(spark, str(tmp_path / "none.json"), SMALL)
        assert df.schema == SMALL and df.count() == 0


def test_term_files(spark, tmp_path):
    rows = [{"call_number": "001", "points": "3-4"}, {"call_number": "2"}]
    (tmp_path / "2020-Fall.json").write_text(json.dumps(rows, indent=2))
    (tmp_path / "2021-Spring.json").write_text(json.dumps(rows[:1], indent=2))
    df = readers.term_files(spark, str(tmp_path), SMALL, array_files=True)
    assert {tuple(r) for r in df.collect()} == {
        ("001", "3-4", "2020-Fall"), ("2", None, "2020-Fall"), ("001", "3-4", "2021-Spring"),
    }


def test_raw_pages(spark, tmp_path):
    for path, body in {
        "2020-Fall/COMS/2020-07-10_18-35_UTC.html": "<p>a\nb</p>",
        "2020-Fall/COMS/W1-001/2020-07-11_01-02_UTC.html": "<p>c</p>",
    }.items():
        f = tmp_path / path
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(body)
    got = {tuple(r) for r in readers.raw_pages(spark, str(tmp_path)).collect()}
    assert {(r[0], r[1], r[2], r[4]) for r in got} == {
        ("2020-Fall", "COMS", None, "<p>a\nb</p>"), ("2020-Fall", "COMS", "W1-001", "<p>c</p>"),
    }
    assert {r[3] for r in got} == {dt.datetime(2020, 7, 10, 18, 35), dt.datetime(2020, 7, 11, 1, 2)}


def test_page_tree(spark, tmp_path):
    at = dt.datetime(2020, 7, 10, 18, 35, 20)
    schema = "term string, department_code string, class_id string, ts timestamp, raw_content string"
    crawl = [
        ("2020-Fall", "COMS", None, at, "<p>a\nb</p>\n"), ("2020-Fall", "COMS", "W{1},2", at, "c\r\n"),
        ("2020-Fall", "MATH", None, at, "m"), ("2020-Fall", "MATH", "W2", at, None), ("2021-Fall", "COMS", None, at, "d" * 100_000),
    ]
    folder = str(tmp_path / "tree")
    assert readers.raw_pages(spark, folder).count() == 0
    first = spark.createDataFrame(crawl, schema)
    assert writers.page_tree(first, folder).count() == 4
    assert writers.page_tree(first.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")), folder).count() == 0
    again = spark.createDataFrame([(*crawl[0][:3], at + dt.timedelta(days=2), "new"), (*crawl[1][:3], at, "c\r\n")], schema)
    assert [r.name for r in writers.page_tree(again, folder).collect()] == ["2020-Fall/COMS/2020-07-12_18-35_UTC.html"]
    rows = {tuple(r) for r in readers.raw_pages(spark, folder).collect()}
    minute = at.replace(second=0)
    want = {(*c[:3], minute, c[4]) for c in crawl if c[4]} | {(*crawl[0][:3], minute + dt.timedelta(days=2), "new")}
    assert rows == want
    one = readers.raw_pages(spark, folder, terms=["2020-Fall"])
    assert {tuple(r) for r in one.collect()} == {w for w in want if w[0] == "2020-Fall"}
    assert all("/2020-Fall/" in f for f in one.inputFiles())
    both = readers.raw_pages(spark, folder, ["2020-Fall", "2021-Fall", "none"], ["MATH"])
    assert [r.department_code for r in both.collect()] == ["MATH"]
    assert readers.raw_pages(spark, folder, ["none"]).count() == 0
    assert readers.raw_pages(spark, folder, []).count() == 0


def test_written_term_files(spark, tmp_path):
    rows = [("002", "3", "2020-Fall"), ("001", None, "2020-Fall"), ("é\n\"", "4", "2021-Spring"), ("5", "5", None)]
    df = spark.createDataFrame(rows, "call_number string, points string, term string")
    for _ in range(2):
        written = {r.name: r.n_rows for r in writers.term_files(df, str(tmp_path), order=["call_number"]).collect()}
        assert written == {"2020-Fall.json": 2, "2021-Spring.json": 1}
    assert [r["call_number"] for r in json.loads((tmp_path / "2020-Fall.json").read_text())] == ["001", "002"]
    got = readers.term_files(spark, str(tmp_path), SMALL, array_files=True)
    assert {tuple(r) for r in got.collect()} == set(rows[:3])
    assert sorted(p.name for p in tmp_path.iterdir()) == ["2020-Fall.json", "2021-Spring.json"]


def test_flat_columns(spark):
    df = spark.createDataFrame(
        [("n", ["b", "a"], [("2021-Fall", "C 1")], ["x"])],
        "name string, departments array<string>, classes array<struct<term:string,course_code:string>>, reviews array<string>",
    )
    assert [tuple(r) for r in writers.flat_columns(df).collect()] == [("n", "a\nb", "2021-Fall C 1")]


def test_scratch_follows_the_session():
    class Conf:
        def get(self, key, default=None):
            return "/shared/folder/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert scratch_dir(Session(), "x").startswith("/shared/folder/rollbook-x-")


def test_snapshot_stream_equals_batch(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows = [("a" if i % 3 else "b", t + dt.timedelta(hours=i), i, "xxyyz"[i % 5]) for i in range(60)]
    schema = "key string, ts timestamp_ntz, id int, content string"
    job = incremental.SnapshotChanges(str(tmp_path), ["key"], "ts", "id", "content")
    for part in (rows[:20], rows[20:21], rows[21:]):
        df = spark.createDataFrame(part, schema)
        df.write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        incremental.run_available(stream, job.handle, f"{tmp_path}/cp")
    last, want = {}, set()
    for key, _, i, content in rows:
        if last.get(key) != content:
            want.add(i)
        last[key] = content
    assert {r.id for r in job.kept(spark).collect()} == want


def test_term_upsert_is_idempotent(spark, tmp_path):
    schema = (
        "term string, department_code string, course_code string, call_number string, instructor string, "
        "department string, enrollment map<string,string>"
    )
    rows = [
        ("2021-Fall", "A", "A 1", "1", "Ann", "Dep A", {"2021-10-01": "1/9"}),
        ("2021-Fall", "B", "B 1", "2", "Bob", "Dep B", {"2021-10-01": "2/9"}),
        ("2020-Fall", "A", "A 1", "1", "Ann", "Dep A", {"2020-10-01": "3/9"}),
    ]
    job = incremental.TermUpsert(str(tmp_path))

    def state():
        e = {(r.term, r.call_number): r.enrollment for r in job.enrollment(spark).collect()}
        c = sorted((r.term, r.course_code) for r in job.classes(spark).collect())
        return c, e

    crawl = spark.createDataFrame(rows, schema)
    job.handle(crawl, 0)
    once = state()
    assert len(once[0]) == 3 and len(once[1]) == 3
    job.handle(crawl, 1)
    assert state() == once
    later = [rows[0][:6] + ({"2021-11-01": "5/9"},)]
    job.handle(spark.createDataFrame(later, schema), 2)
    classes, history = state()
    assert classes == once[0]
    assert history["2021-Fall", "1"] == {"2021-10-01": "1/9", "2021-11-01": "5/9"}
    assert {r.name for r in job.people(spark).collect()} == {"Ann", "Bob"}


def test_weighted_model_round_trip(spark, tmp_path):
    rows = [(i, "good fine text" if i % 3 else "bad poor words", int(i % 3 > 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, text string, label int")
    model = models.weighted_text_classifier(df, "text", "label", models.ARTICLE_WEIGHTS, width=256)
    models.save_model(model, str(tmp_path / "m"))
    scored = models.batch_infer(df, models.load_model(str(tmp_path / "m")))
    assert scored.filter(F.col("label") != F.col("predicted")).count() == 0


def test_schemas_keep_text():
    assert dict(schemas.CLASS.fieldNames() and [(f.name, f.dataType.simpleString()) for f in schemas.CLASS])[
        "points"
    ] == "string"
    assert merge.TERM == "term"
