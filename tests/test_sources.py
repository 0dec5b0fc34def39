"""Readers, sinks, incremental runs, modifiers on the frozen cases."""

import json

import pytest
from pyspark.sql import functions as F

from snapquarry.operators import modifiers
from snapquarry.operators.extract import i18n_refs
from snapquarry.operators.graph import asset_closure, reachable
from snapquarry.sources import readers, sinks
from snapquarry.streaming import incremental


def test_read_pages(spark, tmp_path):
    d = tmp_path / "heroes" / "raw_html"
    d.mkdir(parents=True)
    (d / "a%20b.html").write_text("<p>x</p>")
    (d / "bad.html").write_bytes(b"\xff\xfe\xfa")
    rows = {r.slug: r for r in readers.read_pages(spark, str(tmp_path)).collect()}
    assert rows["a b"].html == "<p>x</p>" and rows["a b"].system_id == "heroes" and rows["bad"].error == "invalid encoding"


def test_manifests_and_modules(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"system_id": "s", "discovery_status": "confirmed", "entries": [{"id": "1", "slug": "a", "validation": {"status": "not_found"}}, {"id": "2", "slug": "b"}]}))
    ok, lost = readers.read_entries(spark, str(tmp_path / "m.json"))
    assert [r.id for r in ok.collect()] == ["2"] and [r.id for r in lost.collect()] == ["1"]
    good = {"schema_version": 1, "season": "s1", "record_count": 1, "records": [{"record_id": "r", "text": "t"}]}
    (tmp_path / "g.json").write_text(json.dumps(good))
    (tmp_path / "w.json").write_text(json.dumps(good | {"record_count": 2}))
    read = lambda f: readers.read_modules(spark, {"m": (str(tmp_path / f), True)}, "record_id:string,text:string", version=1, season="s1")
    assert [r.module for r in read("g.json").collect()] == ["m"]
    with pytest.raises(Exception, match="wrong header"):
        read("w.json").collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read("none.json")


def test_publish_keeps_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish(spark.range(3), path, "a")

    def fail(df):
        raise ValueError("gate")

    with pytest.raises(ValueError, match="gate"):
        sinks.publish(spark.range(5), path, "b", [fail])
    assert sinks.current(spark, path).count() == 3
    sinks.publish(spark.range(7), path, "c")
    assert sinks.current(spark, path).count() == 7
    out = sinks.export_partitioned(spark.range(4).withColumn("k", F.col("id") % 2), "k", str(tmp_path / "e")).collect()
    assert {r.file.split("/")[0] for r in out} == {"k=0", "k=1"} and all(len(r.sha256) == 64 for r in out)


def test_incremental_pages(spark, tmp_path):
    src, state = str(tmp_path / "in"), str(tmp_path / "state")
    row = lambda i, body: (i, bytearray(body), 200, len(body), None)
    schema = "page_id long, content binary, http_status int, content_length long, html_sha256 string"
    for part in ([row(1, b"a"), row(2, b"")], [row(1, b"a"), row(3, b"c")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        incremental.incremental_pages(spark.readStream.schema(schema).parquet(src), state, str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.page_id, r.batch) for r in spark.read.parquet(state).select("page_id", "batch").collect()) == [(1, 0), (3, 1)]


def test_rejected_state(spark, tmp_path):
    src, state = str(tmp_path / "in"), str(tmp_path / "state")
    schema = "route string, reason string, seq long"
    first = [(f"/r{i}", "x", i) for i in range(300)] + [("/a", "x", 1)]
    for part in (first, [("/a", "y", 2), ("/b", "z", 3), ("/a", "w", 1)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        incremental.rejected_state(spark.readStream.schema(schema).parquet(src), state, str(tmp_path / "cp")).awaitTermination()
    want = {f"/r{i}": "x" for i in range(300)} | {"/a": "y", "/b": "z"}
    assert {r.route: r.reason for r in incremental.rejected_routes(spark, state).collect()} == want and incremental.rejected_routes(spark, state).count() == 302
    assert {r.route: r.reason for r in incremental.rejected_routes(spark, state, before=1).collect()} == {f"/r{i}": "x" for i in range(300)} | {"/a": "x"}
    versions = spark.read.parquet(state).select("bucket", "version").distinct().groupBy("version").count().collect()
    assert {r.version: r["count"] for r in versions}[1] <= 2  # only the buckets of the batch's own routes are written again


def test_hits(spark):
    c = spark.createDataFrame([("h", 1, 100.0, "fire", ["physical", "fire"], ["attack"])], "hit_id string, component_id int, base_value double, current_type string, history array<string>, hit_tags array<string>")
    m = spark.createDataFrame([("h", "increased", None, 0.5, [], []), ("h", "increased", None, 0.3, ["attack"], ["physical"]), ("h", "extra", None, 0.2, [], []), ("h", "extra", "g", 0.5, [], []), ("h", "extra", "g", 9.0, ["spell"], [])],
                              "hit_id string, kind string, extra_group string, value double, required_tags array<string>, required_types array<string>")
    assert abs(modifiers.hit_totals(c, m).first().total - 100 * 1.8 * 1.2 * 1.5) < 1e-9
    with pytest.raises(Exception, match="negative multiplier"):
        modifiers.extra_multiplier(spark.createDataFrame([("h", -1.5)], "hit_id string, total double"), ["hit_id"]).collect()


def test_conversion(spark):
    c = spark.createDataFrame([("h", 1, 225.0, "physical", ["physical"])], "hit_id string, component_id int, base_value double, current_type string, history array<string>")
    r = spark.createDataFrame([("h", "physical", "fire", 1.0)], "hit_id string, from_type string, to_type string, ratio double")
    assert [(x.base_value, x.current_type, x.history) for x in modifiers.convert(c, r).collect()] == [(225.0, "fire", ["physical", "fire"])]


def test_fixed_points(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 6)], "src long, dst long")
    assert sorted(tuple(r) for r in reachable(e, spark.createDataFrame([(1,)], "node long")).collect()) == [(1, 0), (2, 1), (3, 2)]
    sheets = spark.createDataFrame([("a", "b"), ("b", "c")], "url string, ref string")
    assert sorted(r.node for r in asset_closure(spark.createDataFrame([("a",)], "url string"), sheets).collect()) == ["a", "b", "c"]


def test_closure_to_the_end(spark):
    chain = spark.createDataFrame([(f"s{i}", f"s{i + 1}") for i in range(10)] + [("s10", "s3")], "url string, ref string")
    pages = spark.createDataFrame([("s0",)], "url string")
    assert {r.node: r.depth for r in asset_closure(pages, chain).collect()} == {f"s{i}": i for i in range(11)}
    assert asset_closure(pages, chain, max_rounds=2).count() == 3


def test_languages(spark):
    """Only files of languages and translations; languages only from pages that have text keys."""
    from snapquarry.operators.extract import i18n_resources

    script = "<script>load(`/i18n/${lang}.json`); get('/data/prices.json'); get('i18n/x.json?v=1'); get(\"https://c.example/Locale_a.json\")</script>"
    rows = [(1, f'<html lang="en"><b data-i18n="k|1">x</b>{script}'), (2, '<html lang="fr"><b>no key</b></html>'), (3, """<html class="a" lang='de'><i data-i18n='k|2'>y</i>"""), (4, None), (5, "")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    got = sorted((r.page_id, r.kind, r.value) for r in i18n_refs(pages).collect())
    assert got == [(1, "file", "/i18n/${lang}.json"), (1, "file", "https://c.example/Locale_a.json"), (1, "file", "i18n/x.json?v=1"), (1, "key", "k|1"), (1, "lang", "en"), (3, "key", "k|2"), (3, "lang", "de")]
    got = sorted(tuple(r) for r in i18n_resources(pages, "https://w.example/").collect())
    runtime = "runtime_language_loader"
    assert got == [("https://c.example/Locale_a.json", "direct_json", 1, [1]), ("https://w.example/i18n/de.json", runtime, 1, [1]), ("https://w.example/i18n/en.json", runtime, 1, [1]), ("https://w.example/i18n/x.json?v=1", "direct_json", 1, [1])]
    many = spark.createDataFrame([(k, f'<html lang="l{k}"><b data-i18n="k">x</b> "/i18n/${{lang}}.json"') for k in range(70)], "page_id long, html string")
    out = i18n_resources(many, "https://w.example/").collect()
    assert len(out) == 70 and all(r.pages == 70 and r.source_pages == [0, 1, 2, 3, 4] for r in out)


def test_links_resolve_like_the_standard_library(spark):
    from urllib.parse import urldefrag, urljoin

    from snapquarry.functions.urls import resolve_url

    bases = ["https://w.example/en/a/p", "https://w.example/", "https://w.example", "https://w.example/a/b/", "http://w.example/x?q=1"]
    hrefs = ["a", "./a", "../a", "../../../a", "/a/../b", "/a/./b/..", "?x=1", "a?x=../1", "a/", "a//b", "//h/x/../y", "http://h/a/../b", "a/b/../../c", "..", ".", "./", "../", "tel:1", "a#f", "/", "parent:x", "a;b/c", "/../a", "a/.", "/a//b", "..a/..."]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string").withColumn("u", resolve_url(F.col("h"), F.col("b")))
    assert "Python" not in df._jdf.queryExecution().toString()
    assert [(r.b, r.h, r.u) for r in df.collect() if r.u != urldefrag(urljoin(r.b, r.h))[0]] == []
    skipped = spark.createDataFrame([("#x",), ("",), (None,), ("javascript:x",), ("data:x",)], "h string")
    assert [r.u for r in skipped.select(resolve_url(F.col("h"), F.lit("https://w.example/")).alias("u")).collect()] == [None] * 5


def test_structure_rules(spark):
    from snapquarry.operators.records import structure_check

    seen = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "z"), (3, "c", "x"), (4, "a", None)], "page_id long, check string, value string")
    got = sorted(tuple(r) for r in structure_check(seen, {"a": "x", "b": "y"}, ("b",)).select("page_id", "check", "severity").collect())
    assert got == [(2, "a", "mismatch"), (2, "b", "warning"), (3, "a", "mismatch"), (3, "b", "warning"), (4, "a", "mismatch"), (4, "b", "warning")]
    assert structure_check(seen.limit(0), {"a": "x"}).count() == 0


def test_hits_meet_modifiers_once(spark):
    """One join for all kinds of modifiers; components without any, or with a null type, count by their base."""
    from snapquarry.operators import modifiers

    c = spark.createDataFrame([(1, 1, 10.0, "fire", ["fire"], ["a"]), (1, 2, 5.0, None, None, ["a"]), (2, 1, 7.0, "cold", ["cold"], None)],
                              "hit_id int, component_id int, base_value double, current_type string, history array<string>, hit_tags array<string>")
    m = spark.createDataFrame([(1, "increased", None, 0.5, ["a"], None), (1, "extra", "x", 0.1, None, None), (1, "extra", "x", 0.1, None, None), (1, "extra", None, 1.0, ["b"], None)],
                              "hit_id int, kind string, extra_group string, value double, required_tags array<string>, required_types array<string>")
    out = modifiers.hit_totals(c, m)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert {r.hit_id: round(r.total, 9) for r in out.collect()} == {1: 27.0, 2: 7.0}


def test_keys_of_sections_meet_one_row_each(spark):
    """Owners of a key are one row before sections meet them, however many there are."""
    from snapquarry.operators import relational

    s = spark.createDataFrame([(1, "r1", "a", "k1"), (1, "r1", "b", "k2"), (2, "r2", "a", "k1"), (3, "r3", "a", "k3"), (4, None, "a", "k1"), (5, None, "a", "k4"), (6, "r6", "a", "k1"), (6, "r6", "a", "k5")],
                              "page_id int, route string, section string, key string")
    o = spark.createDataFrame([("k1", "x", "r2"), ("k2", "x", "r9"), ("k2", "y", "r8"), ("k4", "x", None), ("k5", None, "r5")], "key string, owner string, owner_route string")
    out = relational.owned_elsewhere(s, o)
    assert {(r.page_id, r.section): r.owned for r in out.collect()} == {(1, "a"): True, (1, "b"): False, (2, "a"): False, (3, "a"): False, (4, "a"): True, (5, "a"): False, (6, "a"): False}
    joined = spark.createDataFrame([(1, "r1", "a", "k")], s.schema), spark.createDataFrame([("k", str(i), str(i)) for i in range(50)], o.schema)
    assert "collect_set" in relational.owned_elsewhere(*joined)._jdf.queryExecution().optimizedPlan().toString()


def test_first_pages_of_a_name_without_all_in_one_task(spark):
    from snapquarry.operators.extract import i18n_resources

    pages = spark.createDataFrame([(k, f"<script>get('/res/locale.json'); get('/res/locale{k % 2}.json')</script>") for k in range(40)], "page_id int, html string").repartition(4)
    out = i18n_resources(pages, "https://w.example/")
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    got = {r.resource_url[-12:-5]: (r.pages, r.source_pages) for r in out.collect()}
    assert got == {"/locale": (40, [0, 1, 2, 3, 4]), "locale0": (20, [0, 2, 4, 6, 8]), "locale1": (20, [1, 3, 5, 7, 9])}


def test_small_files_are_dealt_by_their_rows(spark):
    """One file is read by one task; what is made of its rows is dealt over as many as there are rows for."""
    from snapquarry.plans.queries import dealt

    rows = spark.range(30000).coalesce(1)
    assert dealt(rows, "id", each=2000).rdd.getNumPartitions() == 16 and dealt(rows, "id").rdd.getNumPartitions() == 8 and dealt(spark.range(10), "id").rdd.getNumPartitions() == 1
