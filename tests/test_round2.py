"""Whole lists and texts, null keys, late rows, numeric histories and character references."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollbook.operators import extract, features, filters, labelling, merge, models, ordered, quality
from rollbook.sources.scratch import scratch_dir
from rollbook.streaming import incremental

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)


def test_answers_beyond_nine_digits_and_lists_beyond_fifty(spark):
    df = spark.createDataFrame([("m0000000001", 60), ("m00000000012", 60), ("m59", 60), ("m60", 60), ("m" + "9" * 30, 60)], "a string, n int")
    got = df.select("a", labelling.answer_labels(F.col("a"), F.col("n")).alias("x")).collect()
    place = {r.a: r.x.labels.index(2) if r.x.valid else None for r in got}
    assert place == {"m0000000001": 1, "m00000000012": 12, "m59": 59, "m60": None, "m" + "9" * 30: None}
    nested = spark.createDataFrame(
        [("q", "dep", "", [(f"t{i}", "s", None) for i in range(60)], "m55")],
        "name string, department string, course_descr string, search_results array<struct<title:string,snippet:string,label:int>>, answer string",
    )
    flat = features.flatten_results(nested.drop("answer")).collect()
    assert sorted(r["rank"] for r in flat) == list(range(60))
    done = labelling.apply_answers(nested, "search_results", "answer").first()
    assert [r.label for r in done.search_results].index(2) == 55
    stats = labelling.search_label_stats(nested, "search_results").first()
    assert (stats.queries, stats.results) == (1, 60)


def test_labels_that_are_there_stay(spark):
    df = spark.createDataFrame([([("a", 2), ("b", None)], "n")], "r array<struct<t:string,label:int>>, ans string")
    labels = lambda **k: [x.label for x in labelling.apply_answers(df, "r", "ans", **k).first().r]
    assert labels() == [2, 0] and labels(only_missing=False) == [0, 0]
    every = lambda a, n: F.struct(F.lit(True).alias("valid"), F.array_repeat(F.lit(1), n).alias("labels"))
    assert labels(rule=every) == [2, 1]


def test_character_references(value):
    raw = "Bego&ntilde;a &#233;&#xE9;&#8217; R&amp;D &lt;b&gt; &nope; &#0; &#xD800; a & b &amp;eacute; &apos;&#x1F600;&nbsp;."
    assert value(extract.unescape(F.lit(raw))) == "Begoña éé’ R&D <b> &nope; &#0; &#xD800; a & b &eacute; '😀 ."
    assert value(extract.unescape(F.lit("plain"))) == "plain"


def test_nested_reviews(spark):
    body = (
        '<div class=card-body><div class="review_content">one <div>two</div> three<DIV><p>x</p><div>y</div></DIV> z</div>'
        '<p class="date">March 3, 2012</p></div><div class="big card-body"><div class="review_content">four'
    )
    got = extract.profile(spark.createDataFrame([("u", body)], "url string, html string")).first().reviews
    assert [r.text.split() for r in got] == [["one", "two", "three", "x", "y", "z"], ["four"]]


def test_stream_with_null_keys_late_rows_and_equal_crawls(spark, tmp_path):
    schema = "key string, ts timestamp_ntz, id int, content string"
    job = incremental.SnapshotChanges(str(tmp_path), ["key"], "ts", "id", "content", compact_every=2)
    batches = [
        [(None, START, 0, "x"), ("a", START, 1, "x"), ("a", START + 2 * DAY, 3, "y")],
        [(None, START + DAY, 4, "x"), ("a", START + DAY, 2, "x")],  # unchanged; late
        [(None, START + DAY, 4, "x"), ("a", START + 2 * DAY, 3, "y")],  # the same crawl again
        [(None, START + 3 * DAY, 5, "z"), ("b", START, 6, "x")],
        [("a", START + 4 * DAY, 7, "y"), ("b", START + DAY, 8, "w")],
    ]
    for n, rows in enumerate(batches):
        job.handle(spark.createDataFrame(rows, schema), n)
    assert sorted(r.id for r in job.kept(spark).collect()) == [0, 1, 3, 5, 6, 8]
    assert spark.read.parquet(f"{tmp_path}/state/batch=3").count() == 2  # only what it touched
    assert job.state(spark, 5).count() == 3


def test_histories_by_number_and_class(spark):
    df = spark.createDataFrame(
        [("t", "1", {"d": "9/50"}), ("t", "1", {"d": "10/50"}), ("t", "2", {"d": "odd"}), ("t", "2", {"d": "1/2"})],
        "term string, call_number string, enrollment map<string,string>",
    )
    got = {r.call_number: r.enrollment["d"] for r in merge.one_history_per_call(df, ["term", "call_number"]).collect()}
    assert got == {"1": "10/50", "2": "1/2"}


def test_upsert_keeps_columns_classes_and_people(spark, tmp_path):
    schema = (
        "term string, department_code string, course_code string, call_number string, instructor string, "
        "department string, points string, enrollment map<string,string>"
    )
    rows = [
        ("2021-Fall", "A", "A 1", "1", "Ann", "Dep", "3", {"2021-10-01": "9/50"}),
        ("2021-Fall", "A", "A 2", "1", "Bob", "Dep", "4", {"2021-10-01": "10/50"}),
    ]
    known = spark.createDataFrame([("Old", ["D"], [])], "name string, departments array<string>, classes array<struct<term:string,course_code:string>>")
    job = incremental.TermUpsert(str(tmp_path), known)
    assert job.classes(spark).count() == 0
    for n in range(2):
        job.handle(spark.createDataFrame(rows, schema), n)
    assert sorted((r.course_code, r.points) for r in job.classes(spark).collect()) == [("A 1", "3"), ("A 2", "4")]
    seen = {r.course_code: r.enrollment["2021-10-01"] for r in job.enrollment(spark).collect()}
    assert seen == {"A 1": "9/50", "A 2": "10/50"}
    assert {r.name for r in job.people(spark).collect()} == {"Old", "Ann", "Bob"}


def test_patterns_know_every_script(spark):
    df = spark.createDataFrame([("Économie",), ("文学",), ("a b",)], "t string")
    good = quality.regex_coverage("t", r"^\w+$", 2)
    assert [r.t for r in df.filter(good.good(F.col("t"))).collect()] == ["Économie", "文学"]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="share"):
        scratch_dir(Session(), "x")


def test_feature_and_balance_hooks(spark):
    df = spark.createDataFrame([(float(i), int(i > 35)) for i in range(40)] + [(99.0, None)], "x double, label int")
    seen = {}

    def fit(rows):
        seen["weights"] = {r.label: round(r.w, 6) for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
        return models.gaussian_nb(rows)

    vectors = lambda d: models.with_vector(d.withColumn("v", F.array("x", F.col("x") * 2)), "v")
    model = models.fit_features(df, fit, vectors, models.weigh_classes)
    assert seen["weights"] == {0: 20.0, 1: 20.0}
    scored = models.decide(model.transform(vectors(df.limit(40))), lambda s: (s[1] > 0.5).cast("int"))
    assert scored.filter(F.col("predicted") == F.col("label")).count() >= 38


def test_text_hook(spark):
    df = spark.createDataFrame([("good", "text", 1), ("bad", "text", 0)] * 10, "a string, b string, label int")
    both = lambda d: F.concat_ws(" ", d["a"], d["b"])
    model = models.weighted_text_classifier(df, "t", "label", {0: 1.0, 1: 2.0}, 64, text_of=both, params={"regParam": 0.1})
    assert model.stages[-1].getRegParam() == 0.1
    scored = models.batch_infer(df.withColumn("t", both(df)), model)
    assert scored.filter(F.col("predicted") != F.col("label")).count() == 0


def test_refresh_rule(spark):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 29)
    rows = [("a", True, old, old), ("b", True, old, new), ("c", False, old, new), ("d", True, new, old), ("e", None, None, None)]
    df = spark.createDataFrame(rows, "k string, linked boolean, s timestamp_ntz, u timestamp_ntz")

    def due(**kw):
        rule = filters.needs_refresh(F.col("linked"), F.col("s"), F.col("u"), F.col("k"), dt.datetime(2024, 1, 30), 10, 10, **kw)
        return [r.k for r in df.filter(rule).orderBy("k").collect()]

    assert due() == ["a", "c", "e"] and due(literal=True) == ["b", "c", "e"]


def test_positions_along_texts(spark):
    words = [None, "", "é", "z", "漢", "a", "B", "b"] + [f"k{i:03}" for i in range(100)]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "w string, i int")
    got = {r.w: r.position for r in ordered.positions(df, "w", buckets=7).collect()}
    order = sorted((w for w in words if w is not None), key=lambda w: w.encode())
    assert got == {w: k + 1 for k, w in enumerate([None, *order])}
