"""Rules about links, fetches and directories, and the recovery loop, on cases of every kind."""

import pytest
from pyspark.sql import functions as F

from snapquarry.functions import urls
from snapquarry.operators import directory, graph, quality
from snapquarry.operators.graph import NotConverged, converge, reachable
from snapquarry.streaming import incremental


def test_routes(spark):
    known = spark.createDataFrame([("/en/Sword:Blade",), ("/en/Axe",), ("/en/a%20b",), ("/en/A+B",)], "route string")
    cases = {"/en/Axe": ("existing", None), "/en/a b": ("encoding_mismatch", "/en/a%20b"), "/en/Sword/Sword:Blade": ("wrong_directory", "/en/Sword:Blade"), "/en/x/Axe": ("wrong_namespace", "/en/Axe"),
             "/en/Sword/Sword%3ABlade": ("wrong_directory", "/en/Sword%3ABlade"), "/en/No/No:thing": ("wrong_directory", "/en/No:thing"), "/de/Axe": ("missing", None),
                 "/en/parent:x": ("missing", None), "/de/x/Axe": ("missing", None), "/en/A%2BB": ("encoding_mismatch", "/en/A+B")}
    got = quality.route_audit(spark.createDataFrame([(i, r) for i, r in enumerate(cases)], "page_id long, route string"), known).collect()
    assert {r.route: (r.result, r.suggested) for r in got} == cases


def test_fetches(spark):
    u, home = "https://w.example/en/a", "https://w.example/en/home"
    cases = [(404, u, "x", "not_found"), (503, u, "x", "network_error"), (200, home, "x", "redirected"), (200, "https://o.example/en/a", "x", "redirected"), (200, u + "/?q#f", "x", "available"), (200, None, "x", "available"),
             (200, u, "<title>404</title>", "invalid"), (200, u, "<TITLE>Page Not Found</TITLE>", "invalid"), (200, u, "页面不存在", "invalid"),
                 (200, u, "it does not exist, page not found", "available"), (301, u, "x", "invalid"), (None, u, "x", "invalid"), (200, u, None, "available"),
             (200, u, " " * 20_000 + "页面不存在", "available")]
    df = spark.createDataFrame(cases, "status int, final string, html string, want string")
    assert [r.want for r in df.filter(~urls.classify_fetch(F.col("status"), F.lit(u), F.col("final"), F.col("html")).eqNullSafe(F.col("want"))).collect()] == []
    seen = df.sparkSession.createDataFrame([("T", None, "x", u, True), ("", None, "x", u, False), (None, None, None, u, False), ("404", None, "x", u, False), ("T", u + "/", "x", u, True),
        ("T", "/en/b", "x", u, False), ("T", None, "an Error Response", u, False), ("T", None, "x", home, False)],
                                           "title string, canonical string, text string, final string, want boolean")
    found = urls.is_content_page(F.lit(200), F.lit(u), F.col("final"), F.col("title"), F.col("canonical"), F.col("text"))
    assert [r.asDict() for r in seen.filter(found != F.col("want")).collect()] == []


def test_external_links(spark):
    hrefs = ["https://w.example/en/a", "HTTP://WWW.w.example/en/a/", "https://w.example/en/a.png", "https://o.example/en/a", "/en/a", "https://w.example/de/a", "https://w.example/en/b?x", None, ""]
    catalog = spark.createDataFrame([("/en/a",)], "route string")
    got = quality.external_audit(spark.createDataFrame([(h,) for h in hrefs], "href string"), catalog, ["w.example", "www.w.example"], "/en/").collect()
    assert sorted(map(tuple, got)) == [("/en/a", True, 2), ("/en/b", False, 1)]


def test_carried_assets(spark):
    import hashlib

    before = spark.createDataFrame([("u", "old", "image")], "url string, asset_id string, type string")
    got = {r.url: r.asset_id for r in incremental.carry_forward(before, spark.createDataFrame([("v", "style")], "url string, type string")).collect()}
    assert got == {"u": "old", "v": hashlib.sha256(b"v").hexdigest()}


def test_systems(spark):
    html = '<div class="side-menu"><a href="/en/Things">Things</a><a href="/en/New-Thing!">New</a><a href="/en/new_thing">Newer</a><a href="/en/Search">S</a><a href="/en/empty"></a></div><p><a href="/en/Hero">Heroes</a><a href="/en/page">page</a><a href="/en/Things">again</a></p>'
    pages = spark.createDataFrame([(1, "https://w.example/en/home", html)], "page_id long, url string, html string")
    known = spark.createDataFrame([("hero", "Hero", "/en/Hero"), ("help", "Help", "/en/Help")], "system_id string, name string, route string")
    got = sorted(tuple(r) for r in directory.systems_from_pages(pages, known, ["search"]).collect())
    assert got == [("candidate_new_thing", "New", "/en/New-Thing%21", "candidate"), ("candidate_new_thing_2", "Newer", "/en/new_thing", "candidate"), ("candidate_things", "Things", "/en/Things", "candidate"),
                   ("help", "Help", "/en/Help", "confirmed"), ("hero", "Heroes", "/en/Hero", "confirmed")]


def test_flat_directories(spark):
    link = lambda href, key="item_type_list|name|1": f'<a href="{href}" data-i18n="{key}">{href}</a>'
    good = "".join(link(f"p{i}") for i in range(10)) + link("p3") + link("p11?x=1", "other")
    plain = "".join(link(f"p{i}", "item") for i in range(12)) + "item item item"
    few = "".join(link(f"p{i}") for i in range(9)) + link("/en/x") + link("a/b") + link("http:x") + link(".") + link("#a")
    pages = spark.createDataFrame([(k, f"https://w.example/en/d{k}", h) for k, h in enumerate([good, plain, few, None])], "page_id long, url string, html string")
    got = directory.flat_directory(pages).orderBy("source_order").collect()
    assert [(r.page_id, r.route) for r in got] == [(0, f"/en/p{i}") for i in range(10)] + [(0, "/en/p11")]
    assert (got[0].entries, got[0].markers, got[0].duplicates) == (11, 11, 1)


NAV = '<nav><a href="/en/A">A</a><a href="/en/B">B</a></nav>'
CARDS = "".join(f'<div class="col card"><a href="/en/p{i}">P{i}</a></div>' for i in (1, 2, 3))
KINDS = {
    "confirmed_directory": (NAV + f"<main><section><h2>Things /3</h2>{CARDS}</section></main><footer>no</footer>", 200, None, 0.95, 3),
    "count differs": (f"<section><h3>Things / 4</h3>{CARDS}{CARDS}</section>", 200, None, 0.85, 6),
    "structural": (NAV + f'<ul class="grid">{CARDS}</ul><div id="index"><a href="/en/z">z</a></div>', 200, None, 0.95, 3),
    "relation_index": ('<div id="drop-list"><table>' + "".join(f'<tr><td><a href="/en/p{i}">P</a></td><td>x</td></tr>' for i in (1, 2)) + "</table></div>", 200, None, 0.9, 2),
    "single": ('<div class="list"><a href="/en/p1">P1</a></div>', 200, None, 0.55, 1),
    "navigation_only": (NAV + "<p>Welcome</p>", 200, None, 0.9, 0),
    "content_page": (f"<p>{'word ' * 10}</p><p>{'more ' * 10}<a href='/en/x'>x</a></p>", 200, None, 0.9, 0),
    "ambiguous": ('<p>Text <a href="/en/x">x</a> <a href="/en/y">y</a> <a href="/en/z">z</a></p>', 200, None, 0.5, 0),
    "gone": (CARDS, 404, None, 1.0, None), "elsewhere": (CARDS, 200, "https://w.example/en/home", 1.0, None), "empty": ("<script>var x = 'long enough'</script><div> </div>", 200, None, 0.95, 0), "null": (None, 200, None, 0.95, 0),
    "texts": ('<div class="list"><li>one</li><li>two</li><li>three</li></div>', 200, None, 0.5, 0),
}
WANT = {"count differs": "confirmed_directory", "structural": "confirmed_directory", "single": "needs_review", "ambiguous": "needs_review", "gone": "empty_or_invalid",
    "elsewhere": "empty_or_invalid", "empty": "empty_or_invalid", "null": "empty_or_invalid", "texts": "needs_review"}


def test_directory_kinds(spark):
    rows = [(k, "things", f"https://w.example/en/d{i}", v[1], v[2], v[0]) for i, (k, v) in enumerate(KINDS.items())]
    flat = "".join(f'<a href="p{i}" data-i18n="item_type_list|name|{i}">p</a>' for i in range(10))
    rows += [("flat", "inventory", "https://w.example/en/inv", 200, "", flat), ("flat elsewhere", "things", "https://w.example/en/inv2", 200, "", flat)]
    got = {r.page_id: r for r in directory.verify_pages(spark.createDataFrame(rows, "page_id string, system_id string, url string, status int, final_url string, html string")).collect()}
    assert len(got) == len(rows)
    for k, v in KINDS.items():
        assert (got[k].page_type, got[k].confidence) == (WANT.get(k, k), v[3]), (k, got[k])
        assert v[4] is None or got[k].repeats == v[4], (k, got[k])
    assert got["flat"].page_type == "confirmed_directory" and got["flat elsewhere"].page_type == "needs_review"
    assert got["count differs"].displayed == 4 and got["count differs"].n_unique == 3 and got["count differs"].duplicates == 3 and got["confirmed_directory"].n_nav == 2


# ---- the recovery loop


def pages_of(spark, links):
    return spark.createDataFrame([("s", k, f"https://w.example/en/{k}", "".join(f'<a href="/en/{v}">x</a>' for v in to)) for k, to in links.items()], "system_id string, page_id string, url string, html string")


def web_of(spark, links, status):
    rows = [(f"/en/{k}", status.get(k, "available"), k, f"https://w.example/en/{k}", "".join(f'<a href="/en/{v}">x</a>' for v in to)) for k, to in links.items()]
    return spark.createDataFrame(rows, "route string, status string, page_id string, url string, html string")


def test_converges(spark):
    """A chain of any length below the bound, a cycle, a rejected page and one whose error passes."""
    formal = pages_of(spark, {"home": ["a", "home", "bad"]})
    web = web_of(spark, {"a": ["b"], "b": ["c", "a"], "c": ["home", "late"], "bad": ["hidden"], "hidden": [], "late": []}, {"bad": "not_found"})
    own = spark.createDataFrame([("/en/home",)], "route string")
    calls = []

    def fetch(pending):
        calls.append({r.route for r in pending.collect()})
        first = sum("/en/late" in c for c in calls) < 2
        return pending.join(web, "route").withColumn("status", F.when((F.col("page_id") == "late") & F.lit(first), "network_error").otherwise(F.col("status")))

    # a page that fails once is asked for again; as nothing else is pending then, that is the end
    with pytest.raises(NotConverged, match="unchanged"):
        converge(formal, own, fetch, max_rounds=9)
    assert calls == [{"/en/a", "/en/bad"}, {"/en/b"}, {"/en/c"}, {"/en/late"}]
    calls.clear()
    got = converge(formal, own, lambda pending: pending.join(web, "route"), max_rounds=9)
    assert {r.route: (r.state, r.round) for r in got.routes.collect()} == {"/en/home": ("manifested", 1), "/en/a": ("recovered", 1), "/en/bad": ("rejected", 1), "/en/b": ("recovered", 2),
        "/en/c": ("recovered", 3), "/en/late": ("recovered", 4)}
    assert sorted((r.route, r.system_id, r.page_id, r.raw_href) for r in got.provenance.filter("route in ('/en/a', '/en/home')").collect()) == [("/en/a", "recovered", "b", "/en/a"),
        ("/en/a", "s", "home", "/en/a"), ("/en/home", "recovered", "c", "/en/home"), ("/en/home", "s", "home", "/en/home")]
    assert {r.page_id for r in got.pages.collect()} == {"a", "b", "c", "late"} and got.rounds == 5


def test_retried_routes(spark):
    """What failed is tried again while something else is new."""
    web = web_of(spark, {"a": ["b"], "b": [], "x": []}, {})
    tried = []

    def fetch(pending):
        tried.append({r.route for r in pending.collect()})
        return pending.join(web, "route").withColumn("status", F.when((F.col("page_id") == "x") & F.lit(len(tried) < 2), "network_error").otherwise("available"))

    got = converge(pages_of(spark, {"home": ["a", "x"]}), spark.createDataFrame([], "route string"), fetch)
    assert tried == [{"/en/a", "/en/x"}, {"/en/b", "/en/x"}] and got.routes.filter("state = 'recovered'").count() == 3


def test_rounds_run_out(spark):
    web = web_of(spark, {f"p{i}": [f"p{i + 1}"] for i in range(12)}, {})
    formal, own = pages_of(spark, {"home": ["p0"]}), spark.createDataFrame([], "route string")
    with pytest.raises(NotConverged, match="1 routes are pending after 3 rounds"):
        converge(formal, own, lambda p: p.join(web, "route"), max_rounds=3)


def test_rejected_before(spark):
    web = web_of(spark, {"a": []}, {})
    got = converge(pages_of(spark, {"home": ["a", "b"]}), spark.createDataFrame([], "route string"), lambda p: p.join(web, "route"), rejected=spark.createDataFrame([("/en/b",)], "route string"))
    assert {r.route: r.state for r in got.routes.collect()} == {"/en/a": "recovered", "/en/b": "rejected"}
    none = converge(pages_of(spark, {}), spark.createDataFrame([], "route string"), lambda p: p)
    assert none.routes.count() == none.pages.count() == 0


def test_signature(spark):
    routes = spark.createDataFrame([("a",), ("b",), ("c",)], "route string")
    assert graph.signature_of(routes) == graph.signature_of(routes.orderBy(F.desc("route")).repartition(3)) != graph.signature_of(routes.limit(2))


def test_reachable_has_no_silent_bound(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)], "src long, dst long")
    start = spark.createDataFrame([(0,)], "node long")
    assert reachable(chain, start).count() == 21
    assert reachable(chain, start, 20).count() == 21
    with pytest.raises(NotConverged):
        reachable(chain, start, 8)
    assert reachable(chain, start, 8, cut=True).count() == 9
