"""Records and links that are told while pages are parsed, and what of them is dealt again."""

from snapquarry.operators import directory, dom, graph, regions
from snapquarry.plans import page_queries, queries  # noqa: F401  page_queries adds its own

TRAITS = '<div class="card"><h5 class="card-header">Name - 英雄特性 /9</h5>{}</div>'
BOX = '<div class="d-flex border-top"><img alt="{}"><div class="flex-grow-1"><div class="fw-bold">{}</div><div>需求等级 {}</div>{}</div></div>'


def _dealt(df):
    """Exchanges by key of a plan that hasn't run."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hash")


def test_page_entries_gives_the_entries(spark, tmp_path):
    """Which container a page's entries stand in, their routes, names and order are part of the result."""
    page = lambda k, rows: (k, f"https://s.example/en/d{k}", f"<main><ul>{rows}</ul></main>")
    link = '<li><a href="/en/{0}">{1}</a></li>'.format
    rows = [page(1, link("b", " B  b ") + link("a", "A") + link("b", "again")), page(2, "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in queries.QUERIES["page_entries"](spark, str(tmp_path)).collect()}
    assert [(x.source_order, x.route, x.name) for x in got[1].listed] == [(0, "/en/b", "B b"), (1, "/en/a", "A")]
    assert (got[1].container, got[1].entries, got[2].container, got[2].listed) == (1, 2, None, None)


def test_flat_directory_deals_only_links_to_leaves(spark):
    html = '<a href="/en/x">x</a><a href="#y">y</a><a href="a/b">z</a>' * 20 + '<a href="p1" data-i18n="item_type_list|name|1">P <b>1</b></a><a href=" p2?x=/ ">2</a><a href="p2"></a><a href="..">u</a>'
    pages = spark.createDataFrame([(k, "https://s.example/en/d", html.replace("p1", f"p{k}")) for k in (5, 6, 7)], "page_id long, url string, html string")
    got = directory.flat_directory(pages, 2, 1)
    assert _dealt(got) == 1
    assert sorted((r.page_id, r.source_order, r.route, r.name, r.entries, r.markers, r.duplicates) for r in got.collect()) == [
        x for k in (5, 6, 7) for x in ((k, 0, f"/en/p{k}", "P 1", 2, 1, 1), (k, 1, "/en/p2", "2", 2, 1, 1))]


def test_traits_and_skills_deal_no_nodes(spark):
    boxes = BOX.format("A", "T", 3, "<div>one<br>two</div><hr><p>三</p>") + BOX.format("A", "", 4, '<p><span class="tierLevel">等级 2</span><b>x</b><i>y</i></p>')
    other = boxes.replace("one", "other").replace(">T<", "> <")
    pages = spark.createDataFrame([(k, TRAITS.format(h)) for k, h in enumerate((boxes, boxes, boxes, other, other))], "page_id long, html string")
    traits = regions.trait_levels(pages)
    assert _dealt(traits) == 0
    got = sorted((r.entity_id, r.source_locator.row_index, r.key, r.text, r.node_name, r.required_level) for r in traits.collect())
    assert got == [x for k in "01234" for x in ((k, 0, "asset:A:occurrence:1:level:unspecified", f"{'one' if k < '3' else 'other'} two 三", "T" if k < "3" else "", 3), (k, 1, "asset:A:occurrence:2:level:2", "x y", "", 4))]
    skill = '<div class="popupItem"><h5 class="card-title">S</h5></div><table><tr><td>1</td><td><i data-modifier-id="4">grows</i></td></tr></table>id: k'
    records = regions.skill_pages(spark.createDataFrame([(k, skill) for k in (1, 2, 3, 3)], "page_id long, html string"))
    assert _dealt(records) == 1
    assert sorted((r.entity_id, r.key, r.text, r.tier) for r in records.collect()) == [x for k in "12" for x in ((k, "modifier:4", "grows", "1"), (k, "skill:k", "S", None))]


def test_placed_nodes(spark):
    """A page's shape gives the same rows as its own parse."""
    import pyarrow as pa

    schema = pa.schema([("at", pa.list_(pa.int32()))])
    read = lambda nodes: [([x for r in nodes for x in (r[0], -1 if r[6] is None else r[6], r[7], r[9])],)]
    html = "<div>{}<p>b<br></p></div><i></i>"
    pages = spark.createDataFrame([(k, html.format(f"t{k}")) for k in range(4)], "page_id long, html string").coalesce(1)
    got = dom.page_rows(pages, {}, read, schema, "at array<int>", placed=True).collect()
    assert len(got) == 4 and {tuple(r.at) for r in got} == {(0, -1, 4, 1, 1, 0, 1, 1, 2, 0, 4, 2, 3, 2, 3, 2, 4, 2, 4, 3, 5, -1, 5, 5)}


def test_recipe_cards_and_sequences_deal_no_nodes(spark):
    card = '<div class="col"><p data-modifier-id="{0}" data-id="r{0}">gains</p>中型天赋 Lv.3 <a href="p{0}">m</a> x{0}<div class="col"><b data-modifier-id="9"> in </b></div></div>'
    recipes = '<div class="col" data-modifier-id="0">out</div><div id="调香秘仪">' + '<div class="col">none</div>' + card.format(4) + card.format(5) + "</div>"
    rows = '<table id="高塔序列"><tr><td>none</td></tr><tr><td><p data-modifier-id="7">t</p></td><td>e</td><td><b data-chip="c">中阶序列</b></td></tr></table>'
    pages = spark.createDataFrame([(k, recipes + rows) for k in range(3)], "page_id long, html string")
    cards, sequences = regions.recipe_cards(pages), regions.sequence_rows(pages)
    assert _dealt(cards) == _dealt(sequences) == 0
    assert sorted((r.entity_id, r.source_locator.row_index, r.key, r.text, r.talent_type, r.recipe_id, [tuple(m) for m in r.materials]) for r in cards.collect()) == [
        (k, i, f"modifier:{4 + i}", "gains\nin", "medium", f"r{4 + i}", [("m", f"/cn/p{4 + i}/", 4 + i)]) for k in "012" for i in (0, 1)]
    assert sorted((r.entity_id, r.source_locator.row_index, r.key, r.text, r.sequence_tier, r.pattern, r.equipment) for r in sequences.collect()) == [(k, 0, "modifier:7", "t", "intermediate", "c", "e") for k in "012"]


def test_rounds_fetch_from_stored_pages(spark, tmp_path, monkeypatch):
    """recovered_routes makes its pages once, not in every round."""
    tables = {"nation": ([(1,)], "n_nationkey int"), "customer": ([(1, 1)], "c_custkey long, c_nationkey int"), "orders": ([(3, 1, "O")], "o_orderkey long, o_custkey long, o_orderstatus string"),
        "lineitem": ([(3, 1, 4, 5)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long"), "part": ([(4, 20)], "p_partkey long, p_size int"), "supplier": ([(5, 1)], "s_suppkey long, s_nationkey int")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    fetched, whole = [], graph.converge
    monkeypatch.setattr(graph, "converge", lambda pages, manifested, fetch: whole(pages, manifested, lambda pending: fetched.append(fetch(pending)) or fetched[-1]))
    got = queries.QUERIES["recovered_routes"](spark, str(tmp_path)).collect()
    assert sorted((r.route, r.state, r["round"], r.sources, r.first_source) for r in got) == [
        ("/en/c1", "recovered", 1, 1, "n1"), ("/en/n1", "manifested", 5, 1, "s5"), ("/en/o3", "recovered", 2, 1, "c1"), ("/en/p4", "recovered", 3, 1, "o3"), ("/en/s5", "recovered", 4, 1, "p4")]
    assert len(fetched) == 4 and not any(".parquet/" in f and str(tmp_path) in f for df in fetched for f in df.inputFiles())
