"""What operators ask of a parse, and that they parse and resolve no more than they look at."""

from html.parser import HTMLParser

from pyspark.sql import functions as F

from snapquarry.functions import urls
from snapquarry.operators import directory, dom, extract, regions

PIECES = ['<div class="a b">', "</div>", "<p>", "</P >", "<br/>", "x > y", "a &amp; b", "&lt", '<a href="x&amp;y">', "</a>", "<!-- c -->", "<script>a<b</script>", "<", '<i title="x>y">', "<td a=1>", "<IMG Src='q' src=\"r\"/>"]


def test_plain_pages_parse_as_by_the_library():
    mark = {"a": lambda t, attrs, classes: "" if "a" in classes else None}
    for i, first in enumerate(PIECES):
        for second in PIECES:
            html = first + second + PIECES[i // 2] + "z"
            plain, whole = dom._Marked(mark), dom._Marked(mark)
            whole._events = lambda html: None
            assert plain.nodes(html) == whole.nodes(html) and plain.found == whole.found
    assert dom._Marked(mark)._events('<div class="a"><br/>x &amp; y</div>') and dom._Marked(mark)._events("<script>a</script>") is None
    assert issubclass(dom._Marked, HTMLParser)


def test_only_what_is_asked_for_is_given_out(spark):
    html = '<div class="a">one<p>two</p><b>id: 7</b></div>three'
    mark = {"a": lambda t, attrs, classes: "" if "a" in classes else None}
    n = dom.marked_nodes(spark.createDataFrame([(1, html)], "page_id int, html string"), mark, fields=["last_id", "text", "own_text"], texts="id:", plain={"p"})
    assert n.columns == ["page_id", "node_id", "last_id", "own_text", "text", "a"]
    assert [(r.node_id, r.last_id, r.own_text, r.text) for r in n.orderBy("node_id").collect()] == [(0, 5, None, "one two id: 7"), (2, 3, None, None), (5, 5, "id: 7", None)]
    inside = dom.marked_nodes(spark.createDataFrame([(1, html)], "page_id int, html string"), mark, fields=["own_text"], texts={"a"}, plain=set())
    assert sorted(r.own_text for r in inside.collect() if r.own_text) == ["id: 7", "one", "two"]


def test_directory_pages_are_parsed_once(spark):
    html = '<div class="list"><h2>All / 2</h2><ul><li><a href="/en/a">a</a></li><li><a href="/en/b">b</a></li></ul></div>'
    pages = spark.createDataFrame([(1, "x", "https://w.example/en/d", 200, None, html)], "page_id long, system_id string, url string, status int, final_url string, html string")
    for df in (directory.page_features(pages, ["none"]), directory.entries_from_pages(pages.select("page_id", "url", "html"))[1]):
        assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1  # inventories are tried by themselves
    r = directory.page_features(pages, ["none"]).collect()[0]
    assert (r.n_unique, r.repeats, r.displayed, r.n_links) == (2, 2, 2, 2)


def test_counts_below_need_no_texts(spark):
    nodes = spark.createDataFrame([(1, 0, 5, "ul", False), (1, 1, 2, "a", True), (1, 3, 4, "a", True)], "page_id int, node_id int, last_id int, tag string, ok boolean")
    assert [(r.node_id, r.n_below, r.n_elements) for r in directory.links_below(nodes, "ok").orderBy("node_id").collect()] == [(0, 2, 2), (1, 1, 0), (3, 1, 0)]


def test_plain_links_take_one_pattern(spark):
    rows = [("a-b", "https://h.example/en/x"), ("a", "https://h.example/en//x"), ("a", "https://h.example/./x"), ("/en/a", "https://h.example"), ("a\n", "https://h.example/en/x")]
    df = spark.createDataFrame(rows, "h string, b string").select(urls.resolve_url(F.col("h"), F.col("b")).alias("u"))
    assert [r.u for r in df.collect()][:4] == ["https://h.example/en/a-b", "https://h.example/en/a", "https://h.example/a", "https://h.example/en/a"]
    assert urls.PLAIN_LINK in df._jdf.queryExecution().toString()


def test_headings_with_some_references(spark):
    pages = spark.createDataFrame([(1, "<title>a &quot;b&quot; &amp; c&amp</title><h1>&lt;x&gt; &copy;</h1>")], "page_id int, html string")
    r = extract.headings(pages, ["lt", "gt", "amp"]).collect()[0]
    assert (r.title, r.heading) == ("a &quot;b&quot; & c&amp", "<x> &copy;")
    assert extract.headings(pages).collect()[0].title == 'a "b" & c&'


def test_panes_and_recipes_read_marks_of_plain_elements(spark):
    html = f'<div class="tab-pane" id="{regions.CRAFT_PANE}"><table><tr><td>1</td><td><u data-tier="1">x</u></td></tr></table></div>'
    r = regions.pane_records(spark.createDataFrame([(1, "t", html)], "page_id int, title string, html string")).collect()
    assert [(x.text, x.tier) for x in r] == [("x", "t1")]


def test_section_rows_without_exchange(spark):
    """Pages of one shape give what each gives alone: texts and keys are filled in, and no node is dealt again."""
    def page(k, td="td"):
        return (f'<div id="s"><table><tr><th>a  {k}</th></tr><tr data-modifier-id="m{k}" data-tier="{k}"><td> x {k}<b>&amp; y</b></td><{td}></{td}></tr></table>'
                f'<table><tr data-modifier-id=""><td>{"" if k == 2 else " "}</td></tr></table></div>')

    pages = spark.createDataFrame([(k, page(k)) for k in range(6)] + [(6, page(6, "TD")), (7, page(7).replace('"s"', "'s'")), (8, "<div id='s'><table><tr><td>0"), (9, None)], "page_id int, html string").coalesce(1)
    rows = extract.section_rows(pages)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    got = sorted(tuple(r) for r in rows.collect())
    want = []
    for k in range(8):
        want += [(k, "s", 0, 0, [f"a {k}"], [f"x {k} & y", ""], f"m{k}", str(k)), (k, "s", 1, 0, [], [""], "", None)]
    assert got == want + [(8, "s", 0, 0, [], ["0"], None, None)]


def test_nested_keys_of_the_row(spark):
    """Keys that stand in a row need no second parse and no join."""
    from snapquarry.operators import records

    rows = spark.createDataFrame([(1, "s", 0, 0, ["x"], "k", None, ["b", "a"]), (1, "s", 0, 1, ["y"], "", None, ["c"])],
                                 "page_id int, section_id string, table_no int, row_index int, cells array<string>, stable_key string, tier_value string, inner array<string>")
    got = records.nested_key_records(rows, rows["inner"])
    assert [(r.key, r.nested_keys) for r in got.collect()] == [("modifier:k", ["a", "b"])] and "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_pane_records_without_exchange(spark):
    """Units of a page are numbered in its own row; pages of one shape give what each gives alone."""
    def page(k):
        return (f'<div class="tab-pane active show" id="T{k}"><div class="popupItem"><p data-modifier-id="s{k}">stat &amp; {k}</p><div data-block="detail">does {k}<hr>more</div></div></div>'
                f'<div class="tab-pane" id="{regions.BASE_PANE}"><table><tr><td>1</td><td> </td></tr><tr><td>1</td><td>base  {k}</td></tr></table></div>')

    pages = spark.createDataFrame([(k, f"T{k}" if k < 4 else "other", page(k)) for k in range(5)], "page_id int, title string, html string").coalesce(1)
    r = regions.pane_records(pages)
    assert "Exchange" not in r._jdf.queryExecution().executedPlan().toString()
    got = sorted((x.entity_id, x.record_type, x.key, x.text, x.source_locator.row_index) for x in r.collect())
    stats = [(str(k), kind, key, text, 0) for k in range(4) for kind, key, text in (("base_stat", f"modifier:s{k}", f"stat & {k}"), ("special_mechanic", "section:special_mechanic", f"does {k}"))]
    assert got == sorted(stats + [(str(k), "base_affix", "row:0", f"base {k}", 0) for k in range(5)])
