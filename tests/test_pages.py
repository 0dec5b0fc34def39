"""Operators over inline pages: nodes, assets, tooltips, section tables, cards, records, directories."""

import pytest
from pyspark.sql import functions as F

from snapquarry.functions import text, urls
from snapquarry.operators import directory, dom, extract, records

TABLE = """<html><body><div id="affixes"><table><tr><th>Level</th><th>Text</th></tr>
<tr data-modifier-id="m1" data-tier="0+"><td>1</td><td>adds  fire</td></tr><tr data-tier="1"><td>2</td><td>adds cold</td></tr><tr><td>3</td><td> </td></tr></table></div></body></html>"""
TIPS = """<p><a data-bs-toggle="tooltip" data-bs-title="&lt;div&gt;&lt;div&gt;Title&lt;/div&gt;&lt;div&gt;one&lt;br/&gt;two&lt;/div&gt;&lt;/div&gt;">x</a>
<a data-bs-toggle="tooltip" data-bs-title="plain text">y</a><a data-bs-toggle="tooltip">z</a></p>"""
ASSETS = """<html><head><link rel="stylesheet" href="/a.css"><style>p{background:url("/b.png")}</style></head><body><img src="/c.png" srcset="/d.png 1x, /e.png 2x"><video poster="/f.jpg"></video><i style="x:url(/g.svg)"></i><a href="/h">h</a></body></html>"""
CARDS = """<div class="card popupItem"><div data-modifier-id="a">base</div><div class="tierParent"><div data-modifier-id="b">affix<span data-modifier-id="c">in</span></div></div></div>
<div class="card popupItem previousItem"><div data-modifier-id="d">old</div></div>"""


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(1, "https://s.example/en/x", TABLE), (2, "https://s.example/en/y", TIPS), (3, "https://s.example/en/z", ASSETS), (4, "https://s.example/en/c", CARDS), (5, "https://s.example/en/n", None)], "page_id long, url string, html string")


def test_nodes_close_at_nearest_open_tag(spark):
    n = dom.marked_nodes(spark.createDataFrame([(1, "<div><p>a<br>b</div></i>c")], "page_id long, html string"), {})
    assert [(r.tag, r.parent_id, r.last_id) for r in n.orderBy("node_id").collect()] == [("div", None, 4), ("p", 0, 4), ("#text", 1, 2), ("br", 1, 3), ("#text", 1, 4), ("#text", None, 5)]


def test_section_rows_and_records(spark, pages):
    rows = extract.section_rows(pages)
    assert [(r.row_index, r.cells, r.stable_key, r.tier_value) for r in rows.orderBy("row_index").collect()] == [(0, ["1", "adds fire"], "m1", "0+"), (1, ["2", "adds cold"], None, "1"), (2, ["3", ""], None, None)]
    best = extract.level_tables(rows).collect()
    assert [(r.page_id, r.n, r.least, r.greatest) for r in best] == [(1, 3, 1, 3)]
    defs = spark.createDataFrame([("affixes", "affix", 1)], "section_id string, record_type string, text_column int")
    out = records.affix_records(rows, defs).orderBy("key").collect()
    assert [(r.key, r.text, r.tier, r.source_locator.locator_confidence) for r in out] == [("modifier:m1", "adds fire", "t0_plus", "high"), ("row:1", "adds cold", "t1", "medium")]
    assert len({r.record_id for r in out}) == 2
    assert records.validate_records(records.affix_records(rows, defs).withColumn("route", F.lit("/x/"))).filter("size(reasons) > 0").count() == 0
    assert extract.section_descriptor(rows).first().keyed == 1
    wrong = records.structure_check(spark.createDataFrame([(1, "tables", "1")], "page_id long, check string, value string"), {"tables": "2", "rows": "3"})
    assert sorted(r.check for r in wrong.collect()) == ["rows", "tables"]


def test_tooltips(pages):
    out = extract.tooltip_occurrences(pages).orderBy("occurrence_id").collect()
    assert [(r.method, r.title, r.lines, r.text) for r in out] == [("html", "Title", ["one", "two"], "one\ntwo"), ("text", None, ["plain text"], "plain text"), ("missing", None, [], None)]


def test_assets(spark, pages):
    refs = extract.asset_refs(pages).filter("page_id = 3").collect()
    assert sorted(r.url for r in refs) == ["/a.css", "/b.png", "/c.png", "/d.png", "/e.png", "/f.jpg", "/g.svg"]
    css = spark.createDataFrame([("u", "@import url('/i.css'); @font-face{src:url(/f.woff)} p{x:url(/p.png)}")], "url string, css string")
    assert sorted((r.kind, r.ref) for r in extract.css_refs(css).collect()) == [("font", "/f.woff"), ("import", "/i.css"), ("url", "/p.png")]


def test_visible_text_and_lines(spark):
    p = spark.createDataFrame([(1, '<nav>no</nav><p>one <b>two</b></p>three<div id="skip">x</div><div class="tab-pane">y</div>')], "page_id long, html string")
    assert extract.visible_text(p, ["skip"]).first().text == "one two three y"
    assert extract.visible_text(p, ["skip"], strict=True).first().text == "one two three"
    assert [r.line for r in extract.lines(dom.marked_nodes(p, {})).orderBy("line_no").collect()] == ["no", "one two", "three", "x", "y"]


def test_urls(spark):
    rows = [("a/../b?x#f", "https://s.example/en/d/e"), ("//h.example/p", "https://s.example/"), ("/r", "https://s.example/en/d"), ("#a", "https://s.example/"), ("mailto:x", "https://s.example/"), ("https://o.example/q#z", "https://s.example/")]
    df = spark.createDataFrame(rows, "h string, b string")
    got = [r[0] for r in df.select(urls.resolve_url(F.col("h"), F.col("b"))).collect()]
    assert got == ["https://s.example/en/d/b?x", "https://h.example/p", "https://s.example/r", None, None, "https://o.example/q"]
    c = spark.createDataFrame([("https://s.example/en/a%20b+c/",), ("https://s.example/en/../x",), ("https://s.example/en/%E4%BD%A0",)], "u string").select(urls.canonical_page(F.col("u"))).collect()
    assert [r[0] for r in c] == ["/en/a%20b%2Bc", None, "/en/%E4%BD%A0"]


def test_text(spark):
    df = spark.createDataFrame([(" a  b\n", "Foo Bar slug FOO baz", "slug", ["foo", "foo bar"])], "t string, s string, slug string, titles array<string>")
    r = df.select(text.clean(F.col("t")).alias("t"), text.clean_summary(F.col("s"), F.col("slug"), F.col("titles")).alias("s")).first()
    assert (r.t, r.s) == ("a b", "baz")


def test_directory(spark):
    cards = "".join(f'<li><a href="/en/p{i}">P{i}</a></li>' for i in (1, 2, 3, 1))
    page = spark.createDataFrame([(1, "https://s.example/en/dir", f'<nav><a href="/en/nav">N</a></nav><div><h2>Things /3</h2><ul>{cards}</ul></div><p><a href="/en/other">o</a></p>')], "page_id long, url string, html string")
    entries, report = directory.entries_from_pages(page)
    assert [r.route for r in entries.orderBy("source_order").collect()] == ["/en/p1", "/en/p2", "/en/p3"]
    r = report.first()
    assert (r.occurrences, r.n_unique, r.displayed, r.duplicates, r.confidence) == (4, 3, 3, 1, 0.84)


def test_directory_of_one_link(spark):
    html = '<h2>Things / 2</h2><ul><li><a href="/en/p">P</a></li></ul>'
    entries, report = directory.entries_from_pages(spark.createDataFrame([(1, "https://s.example/en/dir", html)], "page_id long, url string, html string"))
    assert [(r.route, r.name, r.source_order) for r in entries.collect()] == [("/en/p", "P", 0)]
    r = report.first()
    assert (r.occurrences, r.n_unique, r.displayed, r.has_container, r.confidence) == (1, 1, None, True, 0.7)
