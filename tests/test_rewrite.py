"""Pages put to local paths; enrichment; readiness; numbered lines; samples."""

import re

import pytest
from pyspark.sql import functions as F

from snapquarry.operators import aggregates, entities, quality, rewrite
from snapquarry.sources import readers

ASSETS = [("https://w.example/a.css", "assets/a.css"), ("https://w.example/i.png", "assets/i.png"), ("https://w.example/i.png?v=2", "assets/i2.png"), ("https://c.example/f.js", "assets/f.js"), ("https://w.example/en/r.png", "assets/r.png")]
ROUTES = [("/en/a", "en/a/"), ("/en/%C3%A9", "en/e/")]


@pytest.fixture(scope="module")
def put(spark):
    def run(*htmls):
        pages = spark.createDataFrame([(i, "https://w.example/en/p", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
        return [r.asDict() for r in rewrite.rewrite_pages(pages, spark.createDataFrame(ASSETS, "url string, path string"), spark.createDataFrame(ROUTES, "route string, path string")).orderBy("page_id").collect()]
    return run


CASES = {
    '<a href="a">x</a>': '<a href="en/a/">x</a>', "<a href='/en/a/?q=1#s'>x</a>": "<a href='en/a/?q=1#s'>x</a>", '<A  HREF = a >x</A >': '<A  HREF = en/a/ >x</A >',
        '<a href="/en/é">x</a>': '<a href="en/e/">x</a>', '<a href="#s">x</a>': None, '<a href="https://o.example/en/a">x</a>': None,
    '<a data-href="a" href="none">x</a>': None, '<img src="/i.png">': '<img src="assets/i.png">', '<img data-src="/i.png" alt="/i.png">': None,
        '<img src="/i.png?v=2#f"/>': '<img src="assets/i2.png#f"/>', '<img src="r.png">': '<img src="assets/r.png">',
    '<img srcset="/i.png 1x, https://w.example/i.png?v=2 2x,/none.png 3x">': '<img srcset="assets/i.png 1x, assets/i2.png 2x,/none.png 3x">', '<source srcset="/i.png">': '<source srcset="assets/i.png">', '<p srcset="/i.png">': None,
    '<style>@import "/a.css"; @import url(\'/a.css\'); p { background: url( /i.png ) }</style>': '<style>@import "assets/a.css"; @import url(\'assets/a.css\'); p { background: url( assets/i.png ) }</style>',
    "<p style=\"background:url('/i.png')\">url(/i.png)</p>": "<p style=\"background:url('assets/i.png')\">url(/i.png)</p>", '<script>var a = \'<img src="/i.png">\';</script>': None, '<!-- <img src="/i.png"> -->': None,
    '<script src="//c.example/f.js" integrity="x" defer></script>': '<script src="assets/f.js"  defer></script>', '<script src="/own.js" integrity="x"></script>': None,
        '<link rel="stylesheet" href="/a.css">': '<link rel="stylesheet" href="assets/a.css">',
    'a<script src="https://www.google-analytics.com/x.js">x<b></script>b': "ab", '<iframe src="https://ad.doubleclick.net/"><iframe></iframe></iframe>!': "!",
        '<img src="https://x.doubleclick.net/1.gif">c': "c", "x<ins class='nitropay'>never closed": "x",
    "<?pi x?><!DOCTYPE html><P CLASS=a>&amp; &#x41; &nosuch; < 3 </p  ><br/>\r\n\ttext": None, "": None,
}


def test_rewriting(put):
    for (before, after), got in zip(CASES.items(), put(*CASES)):
        assert got["html"] == (before if after is None else after), before


def test_statistics(put):
    html = '<a href="a">1</a>\n<a href="b">2</a><img src="/i.png" srcset="/none.png 1x">\n\n<a href="mailto:x">m</a><style>p{x:url(data:z)}</style><script src="https://www.googletagmanager.com/x"></script>'
    got = put(html, None)
    assert [got[0][k] for k in rewrite.STATS] == [6, 1, 1, 1, 1, 1, 0]
    assert got[1]["html"] is None and got[1]["n_refs"] == 0


def test_untouched_pages(spark):
    """Pages without a known reference come out byte for byte."""
    from pathlib import Path

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert Path("/root/testdata/sf0.001/pages.parquet").exists()
    none = spark.createDataFrame([], "url string, path string"), spark.createDataFrame([], "route string, path string")
    out = rewrite.rewrite_pages(pages, *none).withColumnRenamed("html", "after").join(pages, "page_id")
    assert out.filter("n_removed = 0 and not (after <=> html)").count() == 0 and out.filter("n_refs > 0").count() > 0


def fact(route, kind, title, summary, subcategory=None, **counts):
    return (route, kind, title, subcategory, summary, counts or None)


def test_enrichment(spark):
    """The first kind says all; what it leaves open stays the entity's own."""
    entity = [(f"r{i}", f"own {i}", "sys", f"cat{i}", "primary", [("sys", "primary")]) for i in range(8)]
    e = spark.createDataFrame(entity, "route string, title string, owner string, category string, confidence string, sources array<struct<system_id:string,role:string>>")
    facts = [fact("r0", "hero", "Hero", "h", n=1), fact("r0", "fate", "Fate", "f"), fact("r1", "memory", "Mem", "m"), fact("r1", "hero", "Hero", "h", n=2),
        fact("r2", "talent", None, None, "talent_new_god"), fact("r2", "talent", "Zeta", "z"), fact("r3", "nonsense", "N", "n"), fact("r4", "legendary", "L", ""),
             fact("r5", "related_system", "R", "r"), fact("r5", "related_system", "Q", "q"), fact("none", "hero", "x", "x"), fact("r6", "equipment", "E", "e", None, k=3), fact("r7", "prism", " ", "p")]
    got = {r.route: r for r in entities.entity_visibility(entities.enrich(e, spark.createDataFrame(facts,
        "route string, kind string, title string, subcategory string, summary string, counts map<string,long>")), spark.createDataFrame([("r0",), ("r1",), ("r3",)], "route string")).collect()}
    told = lambda r: (got[r].entity_type, got[r].title, got[r].shown_title, got[r].category, got[r].subcategory, got[r].clean_summary, got[r].visibility)
    assert told("r0") == ("fate", "own 0", "own 0", "pact_spirit", "pact_spirit_destiny", "f", "hidden") and [s.role for s in got["r0"].sources] == ["primary"]
    assert told("r1") == ("hero", "Hero", "Hero", "hero", "hero_trait", "h", "visible") and got["r1"].counts == {"n": 2} and [s.role for s in got["r1"].sources] == ["hero_trait"]
    assert told("r2") == ("talent", "own 2", "own 2", "talent_board", "talent_new_god", None, "visible")
    assert told("r3") == (None, "own 3", "own 3", "cat3", None, None, "hidden")
    assert told("r4") == ("legendary_equipment", "own 4", "L", "equipment", "equipment_legendary", None, "visible") and len(got["r4"].sources) == 2
    assert told("r5") == ("equipment_related_system", "own 5", "Q", "equipment_related", "equipment_related", "q", "visible")
    assert told("r6") == ("equipment", "own 6", "own 6", "equipment", "equipment_craft", "e", "visible") and got["r6"].counts == {"k": 3}
    assert told("r7") == ("talent_system", "own 7", "own 7", "talent_board", "talent_ethereal_prism", "p", "visible")


def test_record_facts(spark):
    rows = [("a", "base", 1, " x  y "), ("a", "base", 0, "z"), ("a", "base", 2, "z"), ("a", "craft", 0, "c"), ("a", "other", 0, "no"), ("b", "craft", 0, "c"), ("c", "base", 0, " ")]
    records, titles = spark.createDataFrame(rows, "route string, record_type string, row_index long, text string"), spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "route string, title string")
    parts = {"base": ["base"], "craft": ["craft"]}
    got = {r.route: r for r in entities.record_facts(records, titles, "vorax", parts, {"base": "Base", "craft": "Craft"}).collect()}
    assert (got["a"].summary, got["a"].counts, got["a"].kind) == ("A Base z x y Craft c", {"base": 3, "craft": 1}, "vorax") and got["b"].summary == "B Craft c" and set(got) == {"a", "b"}
    assert {r.route for r in entities.record_facts(records, titles, "vorax", parts, needed=["base", "craft"]).collect()} == {"a"}


def test_readiness(spark):
    pages = [("ok", "1", "https://w.example/en/p", "<p>x</p><img src='/i.png'>"), ("far", "1", "https://w.example/en/p", '<img alt="x" src="//cdn.example/i.png">'),
        ("css", "1", "https://w.example/en/p", "<style>p{background:url(/none.png)}</style>"), ("api", "1", "https://w.example/en/p", "<script>fetch('/api/x')</script>"),
        ("ad", "1", "https://w.example/en/p", "<script>fetch('https://www.google-analytics.com/x')</script>"), ("remote", "1", "u", None)]
    assets = [("ok", "https://w.example/i.png", "image", True, True), ("far", "https://w.example/f.js", "script", True, True), ("css", "https://w.example/i.png", "image", True, None),
        ("gone", "https://w.example/i.png", "image", False, False), ("remote", "https://cdn.example/i.png", "image", True, True)]
    sheets = [("ok", "https://w.example/a.css", "p{background:url(i.png)}"), ("remote", "https://w.example/a.css", "p{background:url(https://cdn.example/i.png)}")]
    make = lambda rows, names: spark.createDataFrame(rows, names)
    texts = "system_id string, url string, text string"
    scripts = [("far", "https://w.example/f.js", "axios.get('/api/late')")]
    out, classes = quality.readiness(make(pages, "system_id string, page_id string, url string, html string"),
        make(assets, "system_id string, url string, type string, present boolean, has_meta boolean"), make(sheets, texts), make(scripts, texts))
    got = {r.system_id: (r.verdict, r.blocking, r.remaining) for r in out.collect()}
    assert got == {"ok": ("ready", [], []), "far": ("not_ready", ["1 endpoints"], ["1 remote_pages"]), "css": ("not_ready", ["1 missing_meta", "1 missing_secondary"], []),
        "api": ("not_ready", ["1 endpoints"], []), "ad": ("ready", [], []), "gone": ("not_ready", ["1 missing_files", "1 missing_meta"], []),
        "remote": ("ready_with_minor_gaps", [], ["1 remote_css"])}
    assert ("far", "required_for_interaction", "w.example", 2) in [tuple(r) for r in classes.collect()]


def test_numbered_lines(spark, tmp_path):
    """Line numbers over byte ranges: files are cut into many, and bad lines are named by file and line."""
    good = [f'{{"k": {i}, "t": "{"x" * (i % 50)}"}}' for i in range(3000)]
    lines = list(good)
    lines[1234] = lines[1234][:-3]
    lines.insert(500, "")
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.jsonl").write_text("\r\n".join(['{"k": 1}', "nonsense", '{"k": 3}']))
    (tmp_path / "c.jsonl").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        numbered = readers.numbered_lines(spark, str(tmp_path))
        assert numbered.rdd.getNumPartitions() > 10
        got = {(r.file[-7:], r.line): r.value for r in numbered.collect()}
        assert got == {("a.jsonl", i + 1): v for i, v in enumerate(lines)} | {("b.jsonl", 1): '{"k": 1}', ("b.jsonl", 2): "nonsense", ("b.jsonl", 3): '{"k": 3}'}
        rows = readers.read_occurrences(spark, str(tmp_path), "k long, t string", strict=False)
        assert sorted((r._file[-7:], r._line) for r in rows.filter("_corrupt_record is not null").collect()) == [("a.jsonl", 1236), ("b.jsonl", 2)] and rows.count() == 3003
        with pytest.raises(Exception, match=r"bad line \S+(a\.jsonl:1236|b\.jsonl:2): "):
            readers.read_occurrences(spark, str(tmp_path), "k long, t string").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_samples(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("s"), F.col("id").alias("k"))
    one, two = (sorted(map(tuple, quality.samples(x, ["s"], "k", 4).collect())) for x in (df, df.repartition(7)))
    assert one == two and len(one) == 12
    some = quality.samples(df.filter("k < 500"), ["s"], "k", 4).drop("sample_no").unionByName(quality.samples(df.filter("k >= 500"), ["s"], "k", 4).drop("sample_no"))
    assert sorted(map(tuple, quality.samples(some, ["s"], "k", 4).collect())) == one  # samples of parts make the sample of all


def test_conflicts(spark):
    rows = [("1", "T", "a"), ("2", "T", " b "), ("3", None, "a"), ("3", "U", "c"), ("4", "U", "c"), ("5", None, None), ("6", "V", " "), ("7", None, "d"), ("8", None, "d")]
    df = spark.createDataFrame([(i, t, x, "e", "s", (i != "7", "f" + i)) for i, t, x in rows],
        "occurrence_id string, tooltip_title string, tooltip_text string, source_entity_id string, source_type string, source struct<hash_match:boolean,html_file:string>")
    got = sorted((r.conflict_type, r.key, r.severity, r.occurrence_ids) for r in aggregates.conflicts(df).collect())
    assert got == [("duplicate_occurrence_id", "3", "error", ["3", "3"]), ("missing_tooltip_text", "5", "review", ["5"]), ("missing_tooltip_text", "6", "review", ["6"]),
        ("same_text_different_title", "a", "review", ["1", "3"]), ("same_title_different_text", "T", "review", ["1", "2"]), ("source_hash_mismatch", "f7", "review", ["7"])]
    assert re.match("same", got[3][0])
