"""Tests for the third round's findings."""

import duckdb
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from rollbook.operators import extract, fuzzy, merge
from rollbook.operators import stored as stored_terms


def _plan(df):
    """The final plan of a table that has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_fuzzy_keys_stay_off_the_driver(spark):
    names = spark.createDataFrame([(f"Supplier#{i:09d}",) for i in range(60)], "name string")
    assert "Broadcast" not in _plan(fuzzy.similar_pairs(names, names, 0.9))
    assert "Broadcast" not in _plan(fuzzy.fuzzy_first(names, "name", names.toDF("found"), "found"))
    assert "Broadcast" not in _plan(fuzzy.fuzzy_pairs(names, "name", names.toDF("found"), "found"))


def test_titles_equal_their_sql_on_references(spark, tmp_path):
    heads = ["a &quot;b&quot; &amp; c", "&amp;quot; &lt;i&gt;", "&#65;&nbsp;x", "&amp;lt;", "", "plain"]
    rows = [(i, "u", f"<h1 class='t'>{h}</h1>") for i, h in enumerate(heads)] + [(9, "u", "none")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(tuple(r) for r in queries()["ext_titles"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == sorted(con.execute(oracle_sql()["ext_titles"]).fetchall())
    # the operator itself still reads every reference
    assert pages.select(extract.titles(F.col("html"))["title"]).first()[0] == 'a "b" & c'


def test_histories_are_cut_after_their_rows_are_folded(spark):
    rows = [
        ("2020-Fall", "1", "A 1", {"2020-10-01": "9/50"}),
        ("2020-Fall", "1", "A 1", {"2021-02-01": "3/50"}),  # after the end of the term
        ("2020-Fall", "1", "A 1", {"2020-10-01": "10/50"}),
        ("2020-Fall", None, "A 1", {"2020-10-02": "1/50"}),
    ]
    schema = "term string, call_number string, course_code string, enrollment map<string,string>"
    old = [("2020-Fall", "1", "A 1", {"2020-10-01": "2/50", "2020-09-01": "1/50"}),
           ("2020-Fall", None, "A 1", {"2020-01-01": "7/50"}), ("2020-Fall", "8", "A 1", {"2020-01-01": "7/50"})]
    keys = ["term", "call_number", "course_code"]
    new, stored = spark.createDataFrame(rows, schema), spark.createDataFrame(old, schema)
    first = {r.call_number: r.enrollment for r in merge.folded_histories(new, None, keys).collect()}
    assert first == {"1": {"2020-10-01": "10/50"}, None: {"2020-10-02": "1/50"}}
    both = {r.call_number: r.enrollment for r in merge.folded_histories(new, stored, keys).collect()}
    assert both == {"1": {"2020-10-01": "2/50", "2020-09-01": "1/50"}, None: {"2020-10-02": "1/50"}}
    assert "Join" not in merge.folded_histories(new, stored, keys)._jdf.queryExecution().executedPlan().toString()


def test_exploded_items_are_computed_once(spark):
    pages = spark.createDataFrame([("https://x.example/COMS_Fall2020.html", "<tr><a href='../subj/a/1'>x</a>")], "url string, html string")
    def filters(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return [line for line in plan.splitlines() if "Filter" in line and "size(" in line]
    assert filters(extract.listing_links(pages)) == []
    assert [r.link for r in extract.listing_links(pages).collect()] == ["https://x.example/subj/a/1"]
    assert filters(extract.links_containing(pages)) == []


def test_value_cells_read_alike_by_both_ways(spark):
    cells = ["\n <td>x &amp; y</td>", "<td></td>", "<td> </td> <td>b</td>", "x", "", "<td>a<br>b</td>", "<td><b>&nbsp;q </b></td>\n ",
             "<td>a</td>\n<td>b</td>", " <td>a</td> <i></i>", "a<td>b", "<td>&lt;</td> </x>\t"]
    rows = spark.createDataFrame([(c,) for c in cells], "c string")
    got = rows.select(extract.value_text(F.col("c")), extract._pieces_text(F.col("c"))).collect()
    assert [r[0] for r in got] == [r[1] for r in got]


def test_profile_is_spread_before_it_is_parsed(spark):
    plan = queries()["ext_profile"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "isnotnull(reviews" not in plan


def test_buckets_follow_the_rows(spark, monkeypatch):
    assert [stored_terms.buckets_for(n) for n in (0, 600_000, 36_000_000, 216_000_000)] == [8, 8, 90, 540]
    sf = "/root/testdata/sf0.001"
    want = sorted(tuple(r) for r in queries()["merge_stored_terms"](spark, sf).collect())
    monkeypatch.setattr(stored_terms, "ROWS_PER_BUCKET", 500)
    asked = []
    made = stored_terms.BucketedTable.__init__
    monkeypatch.setattr(
        stored_terms.BucketedTable, "__init__", lambda self, *a: (asked.append(a[-1]), made(self, *a))[1]
    )
    got = sorted(tuple(r) for r in queries()["merge_stored_terms"](spark, sf).collect())
    assert got == want and asked == [12, 12]


def test_merged_histories_are_computed_once(spark):
    plan = queries()["merge_term"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") + plan.count("map_filter") + plan.count("mapfilter") > 0
    assert not [x for x in plan.splitlines() if "Filter" in x and "map_filter" in x.lower() and "make_date" in x.lower()]
