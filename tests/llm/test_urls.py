"""URL rules against a plain definition; held-out accuracy of the model."""

import random

from pyspark.sql import functions as F

from rollbook.llm import urls
from rollbook.llm.queries import URL_RULES, op10_url_filter

SF = "/root/testdata/sf0.001"


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = []
    for rule in URL_RULES:
        domain, _, begin = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + begin):
            fits.append(rule)
    return max(fits, key=len, default=None)


def check(rows, given):
    assert sorted(str(r[0]) for r in rows) == sorted(str(i) for i, _ in given)
    by_id = dict(given)
    for r in rows:
        host, path = plain(by_id[r.page_id])
        rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (not rule or r.verdict == URL_RULES[rule])


def test_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    rows = op10_url_filter(spark, SF).collect()
    check(rows, [(p.page_id, p.url) for p in pages])
    assert sorted(rows) == sorted(op10_url_filter(spark, SF).collect())


def test_edge_rows(spark):
    given = [None, "", "no scheme", "http://", "HTTP://A.ORG", "x://É.Org/fr/", "http://net", "http://net/", "http://a.NET?/x",
             "http://xnet/", "http://b.example.net/en/1#/de", "http://example.net/en", "http://example.com/de/x://y/?q", "http://h/" + "p" * 50_000,
             "://a.org/fr/\nx", "http://org/fr/"]
    rows = [(i, u, "h", "r") for i, u in enumerate(given)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    check(urls.url_filter(pages, URL_RULES).collect(), [(i, u) for i, u in enumerate(given)])
    twice = spark.createDataFrame([(None, "http://q/a"), (None, "http://q/a")], "page_id long, url string")
    assert [r.verdict for r in urls.url_filter(twice, URL_RULES).collect()] == ["allow", "allow"]
    assert urls.url_filter(pages.limit(0), URL_RULES).count() == 0


def test_held_out_accuracy(spark):
    rnd = random.Random(4)
    word = lambda a: "".join(rnd.choices(a, k=7))
    rows = []
    for _ in range(1200):
        bad = rnd.random() < 0.4
        host = ("casino" if bad and rnd.random() < 0.7 else "news") + word("abcdefgh") + ".com"
        path = "/win-" + word("xyzw") if bad else "/story/" + word("abcd")
        rows.append((f"http://{host}{path}", int(bad)))
    df = spark.createDataFrame(rows, "url string, blocked int")
    model = urls.UrlModel(train_rows=400).fit(df.limit(800))
    test = urls.with_parts(df.subtract(df.limit(800)).withColumnRenamed("blocked", "truth"))
    got = model.blocked(test).agg(F.avg((F.col("blocked").cast("int") == F.col("truth")).cast("int")))
    assert got.first()[0] > 0.95


def test_rules_of_one_length(spark):
    """Both fit; the least is taken in whatever order the rules come."""
    rows = spark.createDataFrame([("a.b", "/cc")], "host string, path string")
    rules = {"a.b/": "block", "b/cc": "allow"}
    for given in (rules, dict(reversed(rules.items()))):
        got = rows.select(urls.rule_of(F.col("host"), F.col("path"), given).alias("rule")).first()
        assert got.rule == "a.b/"
