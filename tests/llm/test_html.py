"""Extraction of the article from generated and odd pages."""

import html
import re

from rollbook.llm.html import blocks, extract, main_blocks, main_text, path_scores
from rollbook.llm.queries import op4_html_text

SF = "/root/testdata/sf0.001"


def article(page):
    """The text of the one article of a test page, whose blocks are h1 and p."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h\d)>", inner)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in parts]
    return "\n\n".join(x for x in parts if x)


def test_query(spark):
    pages = {p.page_id: p for p in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op4_html_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        want = article(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


def test_furniture_goes():
    page = """<html><head><title>T</title><style>p{}</style></head><body>
    <header><h1>Site</h1><nav><a href=/>Home</a></nav></header><div class="cookie-notice"><p>We use cookies, yes.</p></div>
    <div id=wrap class="with-sidebar"><main><article><header><h1>Title &eacute;&#8217;s</h1><p>By me</p></header>
    <p>First&nbsp;para,\n with <a href='x>y'>a <b>link</b></a>.<p>Second<br>one &lt;p&gt; a < b. <script>if (a<b) "</p>";</script>
    <form>Name <input></form><div class="advert">Buy this, now.</div><ul><li>one<li>two</ul><!-- <p>gone</p> -->
    <table><tr><td>c1<td>c2</table><section id="comments"><p>Nice, thanks, really.</p></section></article></main>
    <aside>Side text, long.</aside></div><footer>&copy; us</footer>"""
    assert main_text(page).split("\n\n") == [
        "Title é’s", "First para, with a link.", "Second one <p> a < b.", "one", "two", "c1", "c2",
    ]


def test_pages_without_an_article():
    page = """<body><div><a href=1>Home</a> <a href=2>News, more</a></div><div class=t><h2>Head</h2>
    <div>Some long text, with commas, and it goes on. And on it goes.</div><div>Another block of text.</div>
    </div><div>© 2020</div></body>"""
    assert main_text(page).startswith("Head\n\nSome long") and "Home" not in main_text(page)
    assert main_text("just text") == "just text"
    for nothing in (None, "", "<html>", "<nav>x</nav>", "<script>x", "<!-- x", "<p", "</p></div>", "<p> \n</p>"):
        assert main_text(nothing) == ""


def test_edge_rows(spark):
    deep = "<div>" * 3000 + "<p>deep, text.</p>"
    long = "<article>" + "<p>word, word.</p>" * 20_000
    rows = [(1, None, None, "t"), (None, "u", "<p>a</p>", "t"), (None, "u", "<p>a</p>", "t"), (2, "u", deep, "t"), (3, "u", long, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 0, r.url, r.text) for r in extract(df).collect()), key=str)
    assert [g[:2] for g in got] == [(0, "u"), (0, "u"), (1, None), (2, "u"), (3, "u")]
    assert [g[2][:11] for g in got] == ["a", "a", "", "deep, text.", "word, word."]
    assert got[4][2].count("\n\n") == 19_999 and extract(df.limit(0)).count() == 0


def test_linked_heading_and_sources_stay():
    page = """<body><nav><a href=/>Home</a></nav><article><h1><a href=/1>A linked title</a></h1>
    <p>Some long text, with commas, and it goes on. And on it goes, for a while.</p>
    <ul><li><a href=a>First source</a><li><a href=b>Second source</a></ul>
    <table><tr><td><a href=c>Cell</a></table></article></body>"""
    parts = main_text(page).split("\n\n")
    assert parts[0] == "A linked title" and parts[2:] == ["First source", "Second source", "Cell"]


def test_comments_are_no_article_and_wrappers_no_furniture():
    text = "<p>The story, which is long enough, goes on. And on it goes, with commas.</p>"
    comment = "<p>A reader, who liked it, wrote this. And much more, and more, and more of it, too.</p>" * 3
    outside = f"<body><div class='post'>{text}</div><section class='comments'><article>{comment}</article></section>"
    nested = f"<body><article><h1>Title</h1>{text}<article class='comment'>{comment}</article></article>"
    deep = f"<body><article><h1>Title</h1>{text}<div id='comments'><article>{comment}</article></div></article>"
    teaser = f"<body><div class='post'>{text * 3}</div><article><p>A teaser, short.</p></article>"
    for page in (outside, nested, deep, teaser):
        assert "The story" in main_text(page) and "reader" not in main_text(page), page
    for mark in ("no-sidebar", "has-sidebar", "layout with-banner", "sidebar-left"):
        for at in ("class", "id"):
            assert "The story" in main_text(f"<body><div {at}='{mark}'>{text}</div><div class='sidebar'><p>Side.</p></div>")
    two = f"<body><article>{text}</article><article>{text.replace('story', 'other')}</article>"
    assert main_text(two).count("\n\n") == 1


LONG = "A long paragraph, with commas, that goes on. And on it goes, for quite a while, in this section."


def test_sections_lists_tables_forms_formulas_and_comment_lists():
    sections = f"""<body><ul><li><a href=1>Home</a><li><a href=2>News</a></ul><div class=page><h1>Title</h1>
    <div class=sec><h2>One</h2><p>{LONG}</p></div><div class=sec2><h2>Two</h2><p>Short.</p></div>
    <div class=more><ul><li>first<li>second</ul><table><tr><td>c1<td>c2</table></div></div><div>(c) 2020</div>"""
    parts = ["Title", "One", LONG, "Two", "Short.", "first", "second", "c1", "c2"]
    assert main_text(sections).split("\n\n") == parts
    form = sections.replace("<body>", "<body><form action=/><input><label>Search</label>") + "</form>"
    assert main_text(form).split("\n\n") == parts
    small = f"<body><article><h1>T</h1><p>{LONG}</p><form>Your name <input></form><fieldset>Vote, please</fieldset></article>"
    assert main_text(small).split("\n\n") == ["T", LONG]
    formula = f"""<body><article><p>{LONG}</p><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><mspace/><annotation>x=1</annotation></math> holds
    <svg><title>icon</title><style>a{{}}</style><path d="M0"/><text>Label</text><text>Two</text></svg> here.</p></article>"""
    assert main_text(formula).split("\n\n") == [LONG, "So x=1 holds Label Two here."]
    reader = "<li><p>A reader, who liked it, wrote this. And much more, and more, and more of it, too.</p>" * 5
    for mark in ("class=commentlist", "id='comment-list'", "class='x commentthread'"):
        page = f"<body><div class=post><h1>Title</h1><p>{LONG}</p></div><ol {mark}>{reader}</ol>"
        assert main_text(page).split("\n\n") == ["Title", LONG]


def test_the_ratios_decide():
    rows = lambda mark, text: f"<div class={mark}>" + f"<p>{text}</p>" * 9 + "</div>"
    found = blocks("<body>" + rows("a", LONG) + rows("b", "Few words") + rows("c", f"{LONG} {LONG}"))
    score = path_scores(found)
    ranked = sorted(score, key=score.get)
    assert [p[-2] for p in ranked] == ["div.b", "div.a", "div.c"]
    between = score[ranked[1]] / score[ranked[2]]
    texts = lambda share: [b.path[-2] for b in main_blocks(found, share)]
    assert texts(between * 1.01) == ["div.c"] * 9 and texts(between * 0.99) == ["div.a"] * 9 + ["div.c"] * 9
    # an article that holds little of the text does not outweigh the rest, one that holds most does
    teaser = f"<body><article><p>A teaser, short.</p></article><div class=post><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(teaser) == f"{LONG}\n\n{LONG}"
    most = f"<body><article><p>{LONG}</p><p>{LONG}</p></article><div class=post><p>{LONG[:60]}</p></div>"
    assert main_text(most) == f"{LONG}\n\n{LONG}"
