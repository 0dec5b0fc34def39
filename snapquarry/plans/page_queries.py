"""Registered queries over pages written from the tables' own rows, so that every kind of markup occurs and SQL can say what must
come out: cards, panes and record families, directory verification, rules about links, the recovery loop (see registry)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, urls
from ..operators import aggregates as agg
from ..operators import directory, dom, entities, extract, graph, modifiers, quality, regions, rewrite, search
from ..sources import readers
from ..sources.scratch import new_folder
from .function_queries import SITE, told
from .queries import dealt, query, table


def listed(df: DataFrame, key: str, html: Column, *order: str) -> DataFrame:
    """page_id and the rows' html, in order, one after the other."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(*order, html.alias("_html")))), lambda r: r["_html"])
    return df.groupBy(F.col(key).alias("page_id")).agg(F.array_join(rows, "").alias("rows"))


def order_pages(s: SparkSession, d: str, html: Column) -> DataFrame:
    return table(s, d, "orders").select(F.col("o_orderkey").alias("page_id"), html.alias("html"))


# ---- T11, R02


def _is(prefix: str) -> Column:
    return F.col("o_orderpriority").startswith(prefix)


@query("""SELECT CASE o_orderpriority[1] WHEN '1' THEN 'historical' WHEN '2' THEN 'related' WHEN '3' THEN 'historical' WHEN '4' THEN CASE WHEN o_orderstatus = 'F' THEN 'corrosion' ELSE 'drop_source' END
ELSE CASE WHEN o_orderstatus = 'O' THEN 'current' ELSE 'other' END END AS kind, count(*) AS n, min(o_orderkey) AS first_page FROM orders GROUP BY 1""")
def card_kinds(s, d):
    """Kinds of cards, by their own classes, the pane around and the text keys inside"""
    sign = F.when(F.col("o_orderstatus") == "F", "hyperlink|name|30001").otherwise("TextTable|Func_Tips_DropSource")
    item, head = '<div class="card ui_item popupItem{}">', '<div class="card-header">Corrosion, drop, related</div>x</div>'
    html = (F.when(_is("1"), F.lit(item.format(" previousItem") + head)).when(_is("2"), F.lit('<div class="tab-pane show" id="a">' + item.format("") + head + "</div>"))
            .when(_is("3"), F.lit('<div class="tab-pane" id="cache-1">' + item.format("") + head + "</div>")).when(_is("4"), told('<div class="card"><b data-i18n="', sign, '">', head))
            .when(F.col("o_orderstatus") == "O", F.lit('<div class="tab-pane active show">' + item.format("") + head + "</div>")).otherwise(F.lit('<div class="card">' + head)))
    return regions.cards(order_pages(s, d, html)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_page"))


@query("""SELECT o_orderkey::VARCHAR AS entity_id, unnest(['base_stat', 'affix']) AS record_type, unnest(['modifier:b' || o_custkey, 'modifier:a' || o_custkey]) AS key, unnest(['base ' || o_orderstatus, 'affix ' || o_orderpriority]) AS text,
'base ' || o_orderstatus AS variant, CASE WHEN o_orderpriority LIKE '2%' THEN 'corrosion' ELSE 'current' END AS section FROM orders WHERE o_orderpriority NOT LIKE '1%'""")
def card_stats(s, d):
    """Base stats and affixes of current and corrosion cards; historical ones give none, nor do nested modifiers"""
    kind = F.when(_is("1"), "popupItem previousItem").when(_is("2"), "").otherwise("popupItem")
    sign = F.when(_is("2"), F.lit('<i data-i18n="x hyperlink|name|30001"></i>')).otherwise("")
    html = told('<div class="card ', kind, '"><p data-modifier-id="b', F.col("o_custkey"), '">base ', F.col("o_orderstatus"), "</p>", sign, '<div class="tierParent"><p data-modifier-id="a',
        F.col("o_custkey"), '">affix <b data-modifier-id="in">', F.col("o_orderpriority"), "</b></p></div></div>")
    r = regions.card_records(order_pages(s, d, html))
    return r.select("entity_id", "record_type", "key", "text", "variant", F.col("section_name").alias("section"))


# ---- R03


@query(f"""WITH l AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS i, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem)
SELECT k::VARCHAR AS entity_id, 'craft_affix' AS record_type, 'modifier:' || l_partkey AS key, 'craft ' || l_suppkey AS text, CASE l_returnflag WHEN 'R' THEN 't0_plus' WHEN 'A' THEN 't1' ELSE 'all' END AS tier, i::INT AS row_index FROM l
UNION ALL SELECT k::VARCHAR, 'base_affix', CASE WHEN l_linestatus = 'O' THEN 'row:' || i ELSE 'modifier:' || l_suppkey END, 'base ' || l_partkey, NULL, i::INT FROM l
UNION ALL SELECT o_orderkey::VARCHAR, 'legendary_affix', 'modifier:' || o_custkey, 'legend ' || o_orderstatus, NULL, 0 FROM orders WHERE o_orderkey IN (SELECT k FROM l)
UNION ALL SELECT o_orderkey::VARCHAR, 'base_stat', 'modifier:s' || o_custkey, 'stat ' || o_orderpriority, NULL, 0 FROM orders WHERE o_orderkey IN (SELECT k FROM l) AND o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey::VARCHAR, 'special_mechanic', 'section:special_mechanic', 'mechanic ' || o_orderstatus, NULL, 0 FROM orders WHERE o_orderkey IN (SELECT k FROM l) AND o_orderstatus <> 'F'""")
def pane_affixes(s, d):
    """Stats, mechanic, affixes of two tables and legendary ones of pages with panes; a page whose card is old has no stats"""
    tier = lambda r: F.when(r["l_returnflag"] == "R", ' data-tier="0+"').when(r["l_returnflag"] == "A", ' data-tier="1"').otherwise("")
    key = lambda r: F.when(r["l_linestatus"] == "O", "").otherwise(told(' data-modifier-id="', r["l_suppkey"], '"'))
    base = lambda r: told("<tr", key(r), "><td>1</td><td>base ", r["l_partkey"], "</td></tr>")
    craft = lambda r: told("<tr", tier(r), '><td>1</td><td><i data-modifier-id="', r["l_partkey"], '">craft ', r["l_suppkey"], "</i></td></tr>")
    lines = dealt(table(s, d, "lineitem"), "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"))).alias("r"))
    o = table(s, d, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    title = told("P", F.col("o_orderkey"))
    card = told('<div class="popupItem', F.when(F.col("o_orderstatus") == "F", " previousItem").otherwise(""), '"><p data-modifier-id="s', F.col("o_custkey"), '">stat ',
        F.col("o_orderpriority"), '</p><div data-block="detail">mechanic ', F.col("o_orderstatus"), "<hr>more</div></div>")
    old = F.lit('<div class="popupItem previousItem"><p data-modifier-id="old">old</p></div>')
    part = lambda name, what: told(f'<div class="tab-pane" id="{name}">', what, "</div>")
    joined = lambda f: F.array_join(F.transform("r", f), "")
    html = told('<div class="tab-pane active show" id="', title, '">', card, old, "</div>", part(regions.BASE_PANE, told("<table><tr><th>Tier</th></tr>", joined(base), "</table>")),
        part(regions.CRAFT_PANE, told("<table>", joined(craft), "</table>")),
                part(regions.LEGENDARY_PANE, told('<p data-modifier-id="', F.col("o_custkey"), '">legend ', F.col("o_orderstatus"), "</p>")))
    r = regions.pane_records(o.select(F.col("o_orderkey").alias("page_id"), title.alias("title"), html.alias("html")))
    return r.select("entity_id", "record_type", "key", "text", "tier", F.col("source_locator.row_index").alias("row_index"))


# ---- R05


@query("""WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, first_value(l_linenumber) OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber) AS q FROM lineitem)
SELECT o_custkey::VARCHAR AS entity_id, 'modifier:' || o_orderkey AS key, 'gains ' || o_orderstatus AS text, CASE o_orderpriority[1] WHEN '1' THEN 'medium' WHEN '2' THEN 'core' WHEN '3' THEN 'exotic' END AS talent_type,
'r' || o_orderkey AS recipe_id, m.materials FROM orders LEFT JOIN (SELECT l_orderkey, string_agg('m' || l_partkey || '*' || q || '/cn/p' || l_partkey || '/', ',' ORDER BY l_linenumber, l_partkey) AS materials FROM m GROUP BY 1) m ON l_orderkey = o_orderkey""")
def recipe_cards(s, d):
    """Recipes of pages with materials and quantities, kinds of talents, ids"""
    material = told('<a href="p', F.col("l_partkey"), '">m', F.col("l_partkey"), "</a> x", F.col("l_linenumber"), " ")
    m = listed(dealt(table(s, d, "lineitem"), "l_orderkey"), "l_orderkey", material, "l_linenumber", "l_partkey").withColumnRenamed("page_id", "l_orderkey")
    o = table(s, d, "orders").join(m, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    talent = F.when(_is("1"), "中型天赋").when(_is("2"), "核心天赋").when(_is("3"), "异香天赋").otherwise("天赋")
    card = told('<div class="col"><p data-id="r', F.col("o_orderkey"), '" data-modifier-id="', F.col("o_orderkey"), '">gains ', F.col("o_orderstatus"), "</p>", talent, " Lv.3 ", F.coalesce("rows", F.lit("")), "</div>")
    pages = listed(o, "o_custkey", card, "o_orderkey").select("page_id", told(f'<div id="{regions.RECIPES}">', F.col("rows"), '<div class="col">none</div></div><div class="col" data-modifier-id="x">x</div>').alias("html"))
    text = F.transform("materials", lambda m: F.concat(m["name"], F.lit("*"), m["quantity"].cast("string"), m["route"]))
    return regions.recipe_cards(pages).select("entity_id", "key", "text", "talent_type", "recipe_id", F.when(F.size("materials") > 0, F.array_join(text, ",")).alias("materials"))


@query("""SELECT s_nationkey::VARCHAR AS entity_id, 'modifier:' || s_suppkey AS key, 'tower ' || s_name AS text, CASE WHEN s_acctbal >= 5000 THEN 'advanced' WHEN s_acctbal >= 0 THEN 'intermediate' END AS sequence_tier,
'c' || s_suppkey AS pattern, 'for ' || s_nationkey AS equipment, (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1)::INT AS row_index FROM supplier""")
def sequence_rows(s, d):
    """Rows of sequence tables"""
    tier = F.when(F.col("s_acctbal") >= 5000, "高阶序列 ").when(F.col("s_acctbal") >= 0, "中阶序列 ").otherwise("")
    row = told('<tr><td><p data-modifier-id="', F.col("s_suppkey"), '">tower ', F.col("s_name"), "</p></td><td>for ", F.col("s_nationkey"), '</td><td><b data-chip="c', F.col("s_suppkey"), '">', tier, "</b></td></tr>")
    pages = listed(table(s, d, "supplier"), "s_nationkey", row, "s_suppkey").select("page_id", told('<table><tr><td data-modifier-id="x">x</td></tr></table>',
        f'<div id="{regions.SEQUENCES}"><table class="DataTable"><tr><th>Affix</th></tr>', F.col("rows"), "</table></div>").alias("html"))
    return regions.sequence_rows(pages).select("entity_id", "key", "text", "sequence_tier", "pattern", "equipment", F.col("source_locator.row_index").alias("row_index"))


# ---- R07, R09, R11


@query("""SELECT s_suppkey::VARCHAR AS entity_id, 'contract:' || s_suppkey || ':level:' || s_nationkey AS key, 'S' || s_suppkey || ' level ' || s_nationkey AS text, CASE WHEN s_acctbal > 0 THEN 'of ' || s_name END AS node_context
FROM supplier WHERE s_nationkey % 5 <> 0""")
def contract_boxes(s, d):
    """Contract boxes, badges and rows of tables left out; those of panes that are neither active nor shown give none"""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    more = F.when(F.col("s_acctbal") > 0, told("<div>of ", F.col("s_name"), "</div>")).otherwise("")
    box = told('<div class="d-flex border rounded"><span class="badge">9</span><img data-id="', k, '" data-level="', n, '"><div class="flex-grow-1 ms-2"><div>S', k, "</div><div>level <b>",
        n, "</b><table><tr><td>no</td></tr></table></div><p>no</p>", more, "</div></div>")
    html = F.when(n % 5 == 0, told('<div class="tab-pane" id="x_NPC">', box, "</div>")).when(n % 5 == 1, told('<div class="tab-pane show" id="x_NPC">', box, "</div>")).otherwise(box)
    r = regions.contract_records(table(s, d, "supplier").select(k.alias("page_id"), html.alias("html")))
    return r.select("entity_id", "key", "text", "node_context")


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem),
b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY i) AS n FROM l)
SELECT l_orderkey::VARCHAR AS entity_id, 'asset:' || l_returnflag || ':occurrence:' || n || ':level:' || v AS key, CASE v WHEN '1' THEN 'one p' || l_partkey WHEN '2' THEN 'two s' || l_suppkey ELSE 'plain p' || l_partkey || ' end' END AS text,
'T' || i AS node_name, (l_partkey % 60)::INT AS required_level FROM (SELECT *, unnest(CASE WHEN l_linestatus = 'O' THEN ['1', '2'] ELSE ['unspecified'] END) AS v FROM b)""")
def trait_keys(s, d):
    """Traits of pages by icon, occurrence and level, with what each level says"""
    li = dealt(table(s, d, "lineitem"), "l_orderkey")
    rank = F.row_number().over(_by("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    tiers = told('<div><span class="tierLevel">等级 1</span>free<div>one <b>p', F.col("l_partkey"), '</b></div><hr><p>gone</p><span class="tierLevel">等级 2</span><div>two<br>s', F.col("l_suppkey"), "</div></div>")
    body = F.when(F.col("l_linestatus") == "O", tiers).otherwise(told("<div>plain <i>p", F.col("l_partkey"), "</i></div><span>展开</span><hr><p>end</p>"))
    box = told('<div class="d-flex border-top"><img alt="', F.col("l_returnflag"), '"><div class="flex-grow-1"><div class="fw-bold">T', F.col("i"), "</div><div>需求等级 ", F.col("l_partkey") % 60, "</div>", body, "</div></div>")
    pages = listed(li.withColumn("i", rank), "l_orderkey", box, "i").select("page_id", told('<div class="card"><h5 class="card-header">Name - 英雄特性 /9</h5>', F.col("rows"),
        '</div><div class="d-flex border-top"><div class="flex-grow-1"><b class="fw-bold">x</b></div></div>').alias("html"))
    return regions.trait_levels(pages).select("entity_id", "key", "text", "node_name", "required_level")


def _by(key: str, *order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*order)


def skill_pages(s: SparkSession, d: str) -> DataFrame:
    """A page for each order: its card in the active pane, another in a cached one, and a growth table of its lines."""
    row = told("<tr><td>", F.col("l_linenumber"), '</td><td><i data-modifier-id="', F.col("l_suppkey"), '">grows ', F.col("l_returnflag"), "</i></td></tr>")
    lines = listed(dealt(table(s, d, "lineitem"), "l_orderkey"), "l_orderkey", row, "l_linenumber", "l_partkey", "l_suppkey")
    tag = lambda c: told('<span class="tag">', c, "</span>")
    card = told('<div class="tab-pane active show" id="now"><div class="popupItem"><h5 class="card-title">Order ', F.col("o_orderkey"), "</h5>", tag(F.col("o_orderstatus")), tag(F.col("o_orderpriority")), tag(F.col("o_orderstatus")),
                '<div class="d-flex justify-content-center">', tag(F.col("o_orderstatus")), '</div><div class="d-flex justify-content-center">Cost ', F.col("o_custkey"),
                    '</div><p class="explicitMod">hits c', F.col("o_custkey"), '</p><p class="explicitMod">hits c', F.col("o_custkey"), "</p></div></div>")
    old = F.lit('<div class="tab-pane" id="cache-1"><div class="popupItem"><p class="explicitMod">no</p><b data-modifier-id="no">no</b></div></div>')
    two = F.when(F.col("o_orderstatus") == "P", F.lit('<div class="popupItem">second</div>')).otherwise("")
    o = table(s, d, "orders").join(lines, F.col("page_id") == F.col("o_orderkey"))
    return o.select("page_id", told(card, old, two, "<table><tr><th>Tier</th><th>name</th></tr>", F.col("rows"), "</table><div>id: k", F.col("o_orderkey"), "</div>").alias("html"))


@query("""SELECT l_orderkey::VARCHAR AS entity_id, 'modifier:' || l_suppkey || CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_suppkey) > 1 THEN ':tier:' || l_linenumber ELSE '' END AS key, 'grows ' || l_returnflag AS text, l_linenumber::VARCHAR AS tier
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'""")
def growth_keys(s, d):
    """Growth modifiers of skill pages, repeated ones told apart by tier; pages with two current cards give none"""
    return regions.skill_pages(skill_pages(s, d)).filter("record_type = 'skill_growth'").select("entity_id", "key", "text", "tier")


@query("""SELECT o_orderkey::VARCHAR AS entity_id, 'skill:k' || o_orderkey AS key, 'Order ' || o_orderkey || ' 标签：' || o_orderstatus || '、' || o_orderpriority || ' Cost ' || o_custkey || ' hits c' || o_custkey AS text
FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def effect_texts(s, d):
    """The one effect of a skill page: title, different tags, attributes and effects"""
    return regions.skill_pages(skill_pages(s, d)).filter("record_type = 'skill_effect'").select("entity_id", "key", "text")


# ---- F11, W09, M01, M03


def directories(s: SparkSession, d: str) -> DataFrame:
    """A page for each customer, of a kind that its nation names, with its orders as entries."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    item = told('<li class="entry"><a href="o', F.col("o_orderkey"), '">o', F.col("o_orderkey"), "</a></li>")
    flat = told('<a data-i18n="item_type_list|name|', F.col("o_orderkey"), '" href="o', F.col("o_orderkey"), '">o</a>')
    rows = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", item.alias("item"), flat.alias("flat")))), lambda r: F.struct(r["item"].alias("item"), r["flat"].alias("flat")))
    orders = table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(rows.alias("r"), F.count(F.lit(1)).cast("string").alias("k"))
    c = table(s, d, "customer").join(orders, "c_custkey", "left")
    joined = lambda f: F.array_join(F.transform("r", lambda r: r[f]), "")
    items, flats = F.coalesce(joined("item"), F.lit("")), F.coalesce(joined("flat"), F.lit(""))
    url = told(SITE, "c", k)
    html = (F.when(n == 2, told('<div class="menu">', items, "</div>")).when(n == 3, told("<p>", F.lit("words " * 12), "</p><p>", F.lit("more " * 9), '<a href="/en/x">x</a></p>'))
            .when(n == 4, told('<table class="drop list">', items, "</table>")).when(n == 5, flats).when(n == 6, F.lit("<div> </div>")).otherwise(told('<h2>Things / ', F.coalesce("k", F.lit("0")), "</h2><ul>", items, "</ul>")))
    body = F.when(n == 7, told('<div class="entries">', items, "</div>")).otherwise(told("<div>", html, "</div>"))
    return c.select(k.alias("page_id"), F.when(n == 5, "inventory").otherwise("other").alias("system_id"), url.alias("url"), F.when(n == 0, 404).otherwise(200).alias("status"),
        F.when(n == 1, told(SITE, "home")).otherwise(url).alias("final_url"), body.alias("html"))


@query("""WITH p AS (SELECT c_custkey AS page_id, c_nationkey AS n, count(o_orderkey) AS k FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT page_id, CASE WHEN n < 2 OR n = 6 OR (n IN (2, 4, 5, 7) AND k = 0) THEN 'empty_or_invalid' WHEN n = 2 THEN CASE WHEN k >= 2 THEN 'navigation_only' ELSE 'needs_review' END WHEN n = 3 THEN 'content_page' WHEN n = 4 THEN CASE WHEN k >= 2 THEN 'relation_index' ELSE 'needs_review' END
WHEN n = 5 THEN CASE WHEN k >= 10 THEN 'confirmed_directory' ELSE 'needs_review' END WHEN k >= 2 THEN 'confirmed_directory' ELSE 'needs_review' END AS page_type,
CASE WHEN n IN (3, 6) OR (n = 4 AND k = 0) OR (n = 2 AND k < 2) OR (n = 5 AND k < 10) THEN NULL WHEN n IN (2, 0, 1) THEN NULL WHEN n = 7 AND k = 0 THEN NULL ELSE k END AS n_unique FROM p""")
def directory_types(s, d):
    """Kinds of directory pages, told from their html, status and final URL"""
    found = directory.verify_pages(directories(s, d)).join(table(s, d, "customer").select(F.col("c_custkey").alias("page_id"), F.col("c_nationkey").alias("n")), "page_id")
    known = F.when(F.col("n").isin(4, 7) & (F.col("n_unique") == 0), None).when((F.col("n") == 5) & (F.col("n_unique") < 10), None).when(~F.col("n").isin(0, 1, 2, 3, 6), F.col("n_unique"))
    return found.select("page_id", "page_type", known.alias("n_unique"))


@query("SELECT o_custkey AS page_id, count(*) * CASE WHEN count(DISTINCT o_orderpriority) > 0 THEN 1 END AS repeats, max(k) AS rows FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS k FROM orders) GROUP BY 1")
def repeated_rows(s, d):
    """How many elements of one kind in a page's list hold links; texts without a link don't count"""
    item = told('<li class="b  a"><a href="o', F.col("o_orderkey"), '">o</a></li><li class="c">no link</li><li class="c">nor here</li>')
    lists = listed(table(s, d, "orders"), "o_custkey", item, "o_orderkey")
    pages = lists.select("page_id", F.lit("x").alias("system_id"), told(SITE, "c", F.col("page_id")).alias("url"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("final_url"),
        told('<div class="list">', F.col("rows"), "</div>").alias("html"))
    return directory.page_features(pages).select("page_id", "repeats", F.col("n_unique").alias("rows"))


@query("""WITH l AS (SELECT s_nationkey AS k, arg_min(s_suppkey, s_suppkey) AS first FROM supplier GROUP BY 1), n AS (SELECT n_nationkey AS k FROM nation)
SELECT 'sys' || k AS system_id, 'Shop ' || first AS name, '/en/S' || k AS route, 'confirmed' AS discovery_status FROM l WHERE k < 9
UNION ALL SELECT 'candidate_s' || k, 'Shop ' || first, '/en/S' || k, 'candidate' FROM l WHERE k >= 9 AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = first) UNION ALL SELECT 'sys' || k, 'Known', '/en/S' || k, 'confirmed' FROM n WHERE k < 9 AND k NOT IN (SELECT k FROM l)""")
def navigation_systems(s, d):
    """Systems that pages link to from a context of systems, and known ones wherever they are linked from; utility links and other links of
    the body are none"""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    link = told('<a href="/en/S', n, '">Shop ', k, "</a>")
    html = told(F.when(n < 5, told("<p>", link, "</p>")).otherwise(told('<div class="top-menu"><ul>', link, "</ul></div>")), '<nav><a href="/en/Login">In</a><a href="/en/none"> </a></nav><p><a href="/en/body', k, '">Body</a></p>')
    pages = table(s, d, "supplier").select(k.alias("page_id"), told(SITE, "p", k).alias("url"), html.alias("html"))
    known = table(s, d, "nation").filter("n_nationkey < 9").select(told("sys", F.col("n_nationkey")).alias("system_id"), F.lit("Known").alias("name"), told("/en/S", F.col("n_nationkey")).alias("route"))
    return directory.systems_from_pages(pages, known, ["login"])


@query("""WITH l AS (SELECT l_orderkey AS page_id, l_partkey, count(*) AS k, count(*) FILTER (l_returnflag = 'R') AS m, min(l_linenumber) AS first FROM lineitem GROUP BY 1, 2),
p AS (SELECT *, count(*) OVER w AS entries, sum(m) OVER w AS markers, sum(k) OVER w - count(*) OVER w AS duplicates FROM l WINDOW w AS (PARTITION BY page_id))
SELECT page_id, '/en/p' || l_partkey AS route, (row_number() OVER (PARTITION BY page_id ORDER BY first, l_partkey) - 1)::INT AS source_order, entries, markers::BIGINT AS markers, duplicates::BIGINT AS duplicates FROM p WHERE entries >= 3 AND markers >= 2""")
def flat_directories(s, d):
    """Entries of pages with many links to leaves beside them, some of them texts of item types"""
    mark = F.when(F.col("l_returnflag") == "R", "item_type_list|name|").otherwise("item")
    link = told('<a data-i18n="', mark, '7" href="p', F.col("l_partkey"), '">item</a><a href="/en/p">item</a><a href="a/b">b</a><a href="#x">x</a><a href="..">up</a>')
    pages = listed(dealt(table(s, d, "lineitem"), "l_orderkey"), "l_orderkey", link, "l_linenumber", "l_partkey").select("page_id", told(SITE, "o", F.col("page_id")).alias("url"), F.col("rows").alias("html"))
    return directory.flat_directory(pages, 3, 2).select("page_id", "route", "source_order", "entries", "markers", "duplicates")


# ---- rules about links and pages


@query("""SELECT CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer) THEN CASE WHEN o_orderpriority LIKE '3%' THEN 'wrong_directory' ELSE 'missing' END WHEN o_orderpriority LIKE '1%' THEN 'existing' WHEN o_orderpriority LIKE '2%' THEN 'encoding_mismatch'
WHEN o_orderpriority LIKE '3%' THEN 'wrong_directory' WHEN o_orderpriority LIKE '4%' THEN 'wrong_namespace' ELSE 'missing' END AS result, suggested, count(*) AS links
FROM (SELECT *, CASE WHEN o_orderpriority LIKE '3%' OR (o_custkey IN (SELECT c_custkey FROM customer) AND o_orderpriority[1] IN ('2', '4')) THEN '/en/C:' || (o_custkey % 10) || ' c' || o_custkey END AS suggested FROM orders) GROUP BY 1, 2""".replace("'/en/C:' || (o_custkey % 10) || ' c' || o_custkey", "'/en/C:c' || o_custkey"))
def customer_routes(s, d):
    """Q06: links against the known routes: existing, encoded otherwise, in a directory that their own page names, in another namespace, missing"""
    c = F.col("o_custkey")
    there = F.when(_is("1"), told("/en/C:c", c)).when(_is("2"), told("/en/C%3Ac", c)).when(_is("3"), told("/en/C/C:c", c)).when(_is("4"), told("/en/x/C:c", c)).otherwise(told("/de/C:c", c))
    links = table(s, d, "orders").select(F.col("o_orderkey").alias("page_id"), there.alias("route"))
    routes = table(s, d, "customer").select(told("/en/C:c", F.col("c_custkey")).alias("route"))
    return quality.route_audit(links, routes).groupBy("result", "suggested").agg(F.count(F.lit(1)).alias("links"))


@query("""SELECT '/en/c' || o_custkey AS route, o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20) AS in_catalog, count(*) AS links FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority[1] IN ('1', '2') GROUP BY o_custkey""")
def external_links(s, d):
    """Q07: own pages that are linked by absolute URL, and whether the catalog has them; other hosts, other languages, images and
    relative links don't count"""
    c = F.col("o_custkey")
    href = F.when(F.col("o_orderstatus") != "F", told("/en/c", c)).when(_is("1"), told("HTTPS://w.example/en/c", c)).when(_is("2"),
        told("http://www.w.example/en/c", c, "/?x=1#y")).when(_is("3"), told("https://other.example/en/c", c)).when(_is("4"),
        told("https://w.example/en/c", c, ".PNG")).otherwise(told("https://w.example/de/c", c))
    catalog = table(s, d, "customer").filter("c_nationkey < 20").select(told("/en/c", F.col("c_custkey")).alias("route"))
    return quality.external_audit(table(s, d, "orders").select(href.alias("href")), catalog, ["w.example", "www.w.example"], "/en/")


@query("""SELECT CASE WHEN doc_id % 11 = 0 THEN 'not_found' WHEN doc_id % 13 = 0 THEN 'network_error' WHEN lang = 'de' THEN 'redirected' WHEN doc_id % 17 = 0 OR source IN ('src1', 'src2', 'src3') THEN 'invalid' ELSE 'available' END AS status,
doc_id % 11 <> 0 AND doc_id % 13 <> 0 AND doc_id % 17 <> 0 AND lang <> 'de' AND source NOT IN ('src1', 'src2', 'src3', 'src4', 'src5') AND NOT regexp_matches(lower(text), '404|not found|error response|页面不存在') AS content, count(*) AS n FROM documents GROUP BY 1, 2""")
def fetch_classes(s, d):
    """what a fetch was worth, by status, final URL and error marks, and whether a page has content by title, canonical link and text"""
    code = F.when(F.col("doc_id") % 11 == 0, 404).when(F.col("doc_id") % 13 == 0, 503).when(F.col("doc_id") % 17 == 0, 301).otherwise(200)
    u = told("https://a.example/en/", F.col("doc_id"))
    final = F.when(F.col("lang") == "de", F.lit("https://a.example/en/home")).otherwise(u)
    is_ = lambda k: F.col("source") == f"src{k}"
    title = F.when(is_(1), "404").when(is_(2), "Page Not Found").when(is_(4), " ").otherwise("Home")
    body = F.when(is_(3), told(F.col("text"), " 页面不存在")).otherwise(F.col("text"))
    canonical = F.when(is_(5), F.lit("/en/other")).when(is_(6), u)
    html = told("<title>", title, "</title>", F.when(is_(3), F.lit("页面不存在")).otherwise(""), "it does not exist")
    rows = table(s, d, "documents").select(urls.classify_fetch(code, u, final, html).alias("status"), urls.is_content_page(code, u, final, title, canonical, body).alias("content"))
    return rows.groupBy("status", "content").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT c_custkey AS page_id, c_nationkey AS n, c_mktsegment AS m FROM customer), l AS (SELECT DISTINCT 'l' || n AS lang FROM p WHERE m <> 'MACHINERY'),
r AS (SELECT page_id, 'https://w.example/i18n/' || lang || '.json' AS u, 'runtime_language_loader' AS t FROM p, l WHERE m = 'BUILDING' UNION SELECT page_id, 'https://w.example/res/locale' || n || '.json', 'direct_json' FROM p),
k AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY page_id) AS i FROM r)
SELECT u AS resource_url, min(t) AS reference_type, count(*) AS pages, string_agg(CASE WHEN i <= 5 THEN page_id::VARCHAR END, ',' ORDER BY page_id) AS source_pages FROM k GROUP BY 1""")
def language_resources(s, d):
    """Language files that pages name, templates filled with the languages of pages that have text keys; other JSON isn't taken"""
    n, m = F.col("c_nationkey"), F.col("c_mktsegment")
    key = F.when(m != "MACHINERY", F.lit('<b data-i18n="k">x</b>')).otherwise("")
    load = F.when(m == "BUILDING", F.lit("load(`/i18n/${lang}.json`);")).otherwise("")
    html = told('<html lang="l', n, '">', key, "<script>", load, "get('/data/prices.json'); get(\"/res/locale", n, '.json")</script></html>')
    out = extract.i18n_resources(dealt(table(s, d, "customer"), "c_custkey", each=20_000).select(F.col("c_custkey").alias("page_id"), html.alias("html")), "https://w.example/")
    return out.withColumn("source_pages", F.array_join(F.transform("source_pages", lambda p: p.cast("string")), ","))


# ---- I01


def site(s: SparkSession, d: str) -> DataFrame:
    """What a fetch finds: pages of customers, orders, parts and suppliers, each linked from the one before."""
    link = lambda letter, c: told('<a class="x" href="', letter, c, '">', letter, "</a>")
    orders = listed(table(s, d, "orders"), "o_custkey", link("o", F.col("o_orderkey")), "o_orderkey")
    li = table(s, d, "lineitem")
    lines, made = listed(li, "l_orderkey", link("p", F.col("l_partkey")), "l_linenumber", "l_partkey"), listed(li.select("l_partkey", "l_suppkey").distinct(), "l_partkey", link("/en/s", F.col("l_suppkey")), "l_suppkey")
    page = lambda df, letter, key, status, rows: df.select(told("/en/", letter, F.col(key)).alias("route"), status.alias("status"), told(letter, F.col(key)).alias("page_id"),
        told(SITE, letter, F.col(key)).alias("url"), rows.alias("html"))
    ok, rows = F.lit("available"), F.coalesce("rows", F.lit(""))
    c = page(table(s, d, "customer").join(orders, F.col("page_id") == F.col("c_custkey"), "left"), "c", "c_custkey", ok, rows)
    o = page(table(s, d, "orders").join(lines, F.col("page_id") == F.col("o_orderkey"), "left"), "o", "o_orderkey", F.when(F.col("o_orderstatus") == "P", "not_found").otherwise(ok), rows)
    p = page(table(s, d, "part").join(made, F.col("page_id") == F.col("p_partkey"), "left"), "p", "p_partkey", F.when(F.col("p_size") < 10, "redirected").otherwise(ok), rows)
    up = told('<a href="/en/n', F.col("s_nationkey"), '">up</a><a href="https://other.example/en/x">out</a><a href="#t">t</a>')
    return c.unionByName(o).unionByName(p).unionByName(page(table(s, d, "supplier"), "s", "s_suppkey", ok, up))


@query("""WITH RECURSIVE e AS (SELECT 'n' || c_nationkey AS a, 'c' || c_custkey AS b FROM customer UNION SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders UNION SELECT 'o' || l_orderkey, 'p' || l_partkey FROM lineitem
UNION SELECT 'p' || l_partkey, 's' || l_suppkey FROM lineitem UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
bad AS (SELECT 'o' || o_orderkey AS k FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 'p' || p_partkey FROM part WHERE p_size < 10),
f AS (SELECT * FROM e WHERE a NOT IN (SELECT k FROM bad)), r AS (SELECT 'n' || n_nationkey AS k FROM nation UNION SELECT f.b FROM f JOIN r ON f.a = r.k)
SELECT '/en/' || b AS route, CASE WHEN b[1] = 'n' THEN 'manifested' WHEN b IN (SELECT k FROM bad) THEN 'rejected' ELSE 'recovered' END AS state, (strpos('copsn', b[1]))::INT AS round, count(*) AS sources, min(a) AS first_source
FROM f WHERE a IN (SELECT k FROM r) GROUP BY b""")
def recovered_routes(s, d):
    """Pages recovered from the links of those that are there, round after round, until nothing is pending"""
    links = listed(table(s, d, "customer"), "c_nationkey", told('<a href="c', F.col("c_custkey"), '">c</a>'), "c_custkey").withColumnRenamed("page_id", "k")
    nations = table(s, d, "nation").join(links, F.col("k") == F.col("n_nationkey"), "left")
    pages = nations.select(F.lit("nations").alias("system_id"), told("n", F.col("n_nationkey")).alias("page_id"), told(SITE, "n", F.col("n_nationkey")).alias("url"), F.coalesce("rows", F.lit("")).alias("html"))
    manifested = table(s, d, "nation").select(told("/en/n", F.col("n_nationkey")).alias("route"))
    there = dom.stored(site(s, d), "site")  # each round fetches from it
    found = graph.converge(pages, manifested, lambda pending: pending.join(there, "route"))
    from_ = found.provenance.groupBy("route").agg(F.count(F.lit(1)).alias("sources"), F.min("page_id").alias("first_source"))
    return found.routes.join(from_, "route")


# ---- T16


@query("""SELECT c_custkey AS page_id, '<A HREF=' || chr(39) || CASE WHEN n < 20 THEN 'pages/c' || c_custkey ELSE '/en/c' || c_custkey END || '?x=1#s' || chr(39) || ' data-src="/i/n' || n || '.png">c &amp; d</A><img srcset="assets/n' || n || '.png 1x, /i/none.png 2x" ' || CASE WHEN m = 'BUILDING' THEN 'src="/i/none.png" integrity="q"' ELSE
'src="assets/n' || n || '.png#f" ' END || '/><style>@import "assets/s.css";p{background:url( assets/n' || n || '.png )}</style><p style="background:url(https://far.example/x.png)">text<br></P >' AS html,
CASE WHEN m = 'BUILDING' THEN 8 ELSE 8 END AS n_refs, CASE WHEN m = 'BUILDING' THEN 3 ELSE 4 END AS n_assets, (n < 20)::INT AS n_pages, CASE WHEN m = 'BUILDING' THEN 3 ELSE 2 END AS n_remote, 1 + (n >= 20)::INT AS n_unknown_pages, 2 AS n_removed, (m <> 'BUILDING')::INT AS n_integrity
FROM (SELECT c_custkey, c_nationkey AS n, c_mktsegment AS m FROM customer)""".replace("'/><style>", "'/><style>").replace("text<br></P >'", "text<a href=\"/en/none\">n</a><br></P >'"))
def rewritten_pages(s, d):
    """Pages with their references put to local paths: links, sources, candidates of srcset, styles and imports; trackers go"""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    source = F.when(F.col("c_mktsegment") == "BUILDING", 'src="/i/none.png"').otherwise(told('src="/i/n', n, '.png#f"'))
    html = told("<A HREF='/en/c", k, "?x=1#s' data-src=\"/i/n", n, '.png">c &amp; d</A><img srcset="/i/n', n, '.png 1x, /i/none.png 2x" ', source,
        ' integrity="q"/><script src="https://www.google-analytics.com/a.js">if (a < b) x("</p>")</script><style>@import "/s.css";p{background:url( /i/n', n,
                '.png )}</style><img src="https://x.doubleclick.net/p.gif"><p style="background:url(https://far.example/x.png)">text<a href="/en/none">n</a><br></P >')
    pages = dealt(table(s, d, "customer"), "c_custkey", each=20_000).select(k.alias("page_id"), told(SITE, "c", k).alias("url"), html.alias("html"))
    nations = table(s, d, "nation").select(told("https://w.example/i/n", F.col("n_nationkey"), ".png").alias("url"), told("assets/n", F.col("n_nationkey"), ".png").alias("path"))
    assets = nations.unionByName(s.range(1).select(F.lit("https://w.example/s.css").alias("url"), F.lit("assets/s.css").alias("path")))
    routes = table(s, d, "customer").filter("c_nationkey < 20").select(told("/en/c", k).alias("route"), told("pages/c", k).alias("path"))
    return rewrite.rewrite_pages(pages, assets, routes)


# ---- N09, N10, Q08, Q12, S05


_KINDS = "['fate', 'pact_spirit', 'equipment', 'legendary_equipment', 'equipment', 'talent', 'talent_system', 'hero', 'memory_system', 'equipment_related_system']"
_CATEGORIES = "['pact_spirit', 'pact_spirit', 'equipment', 'equipment', 'equipment', 'talent_board', 'talent_board', 'hero', 'memory', 'equipment_related']"
_SUBCATEGORIES = "['pact_spirit_destiny', 'pact_spirit_entity', 'equipment_craft', 'equipment_legendary', 'equipment_vorax', 'talent_hero', 'talent_ethereal_prism', 'hero_trait', 'hero_memory', 'equipment_related']"
ENRICHED = f"""WITH r AS (SELECT l_partkey AS k, l_orderkey * 10 + l_linenumber AS i, CASE WHEN l_returnflag = 'R' THEN 'main' ELSE 'more' END AS t, 'line ' || l_linenumber || ' ' || l_linestatus AS x FROM lineitem),
u AS (SELECT k, t, x, min(i) AS f, count(*) AS n FROM r GROUP BY 1, 2, 3),
s AS (SELECT k, string_agg(CASE WHEN t = 'main' THEN x END, ' ' ORDER BY f, x) AS m, string_agg(CASE WHEN t = 'more' THEN x END, ' ' ORDER BY f, x) AS o, sum(CASE WHEN t = 'main' THEN n ELSE 0 END)::BIGINT AS n_main, sum(CASE WHEN t = 'more' THEN n ELSE 0 END)::BIGINT AS n_more FROM u GROUP BY 1),
w AS (SELECT p_partkey AS k, p_brand, p_size, s.*, CASE WHEN s.k IS NOT NULL THEN list_filter(range(0, 10), lambda i: p_size % (i + 2) = 0 AND (i <> 3 OR m IS NOT NULL))[1] END AS i FROM part LEFT JOIN s ON s.k = p_partkey),
j AS (SELECT '/en/p' || k AS route, CASE WHEN i IN (7, 8) THEN 'K' || i || ' ' || k ELSE 'Part ' || k END AS title, CASE WHEN i >= 3 THEN 'K' || i || ' ' || k ELSE 'Part ' || k END AS shown_title, {_KINDS}[i + 1] AS entity_type, coalesce({_CATEGORIES}[i + 1], p_brand) AS category,
{_SUBCATEGORIES}[i + 1] AS subcategory, CASE WHEN i IS NOT NULL THEN 'P ' || k || coalesce(' Main ' || m, '') || coalesce(' ' || o, '') END AS clean_summary, CASE WHEN i IS NOT NULL THEN n_main END AS n_main, CASE WHEN i IS NOT NULL THEN n_more END AS n_more,
CASE WHEN p_size % 7 = 0 AND coalesce(i, 0) < 3 THEN 'hidden' ELSE 'visible' END AS visibility FROM w)"""


def enriched(s: SparkSession, d: str) -> DataFrame:
    """Parts as entities of ten kinds, with their lines as records."""
    k, size = F.col("p_partkey"), F.col("p_size")
    parts = table(s, d, "part").withColumn("route", told("/en/p", k))
    own = F.array(F.struct(F.lit("parts").alias("system_id"), F.lit("primary").alias("role")))
    entity = parts.select("route", told("Part ", k).alias("title"), F.lit("parts").alias("owner"), F.col("p_brand").alias("category"), F.lit("primary").alias("confidence"), own.alias("sources"))
    li = table(s, d, "lineitem")
    rows = li.select(told("/en/p", F.col("l_partkey")).alias("route"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_index"),
        F.when(F.col("l_returnflag") == "R", "main").otherwise("more").alias("record_type"), told("line ", F.col("l_linenumber"), " ", F.col("l_linestatus")).alias("text"))
    known = entities.record_facts(rows, parts.select("route", told("P ", k).alias("title")), "any", {"main": ["main"], "more": ["more"]}, {"main": "Main"})
    of = F.filter(F.array(*[F.when(size % (i + 2) == 0, F.struct(F.lit(kind.name).alias("kind"), F.lit(i).alias("i"))) for i, kind in enumerate(entities.KINDS)]), lambda x: x.isNotNull())
    kinds = parts.select("route", k.alias("k"), F.explode(of).alias("x"))
    facts = known.drop("kind", "title").join(kinds, "route").withColumn("kind", F.col("x.kind")).withColumn("title", told("K", F.col("x.i"), " ", F.col("k"))).filter("kind <> 'legendary' or counts['main'] > 0")
    directories = parts.filter(size % 7 == 0).select("route")
    return entities.entity_visibility(entities.enrich(entity, facts), directories)


@query(f"{ENRICHED} SELECT * FROM j")
def enriched_entities(s, d):
    """What the first kind of each entity says of it, field by field, and whether it is shown"""
    e = enriched(s, d)
    return e.select("route", "title", "shown_title", "entity_type", "category", "subcategory", "clean_summary", F.col("counts")["main"].alias("n_main"), F.col("counts")["more"].alias("n_more"), "visibility")


@query(f"{ENRICHED} SELECT entity_type, count(*) AS n, count(*) FILTER (clean_summary <> '') AS enriched, count(*) FILTER (clean_summary IS NULL) AS missing, min(route) AS sample FROM j GROUP BY 1")
def entity_enrichment(s, d):
    """Entities by kind, with and without a summary"""
    return agg.entity_report(enriched(s, d).withColumn("entity_id", F.col("route")))


@query("""WITH c AS (SELECT c_nationkey AS k, count(*) AS pages FROM customer GROUP BY 1), a AS (SELECT s_nationkey AS k, count(*) AS assets, count(*) FILTER (s_acctbal < 0) AS low FROM supplier GROUP BY 1),
n AS (SELECT n_nationkey AS k, n_regionkey AS r, coalesce(pages, 0) AS pages, coalesce(assets, 0) AS assets, coalesce(low, 0) AS low FROM nation LEFT JOIN c ON c.k = n_nationkey LEFT JOIN a ON a.k = n_nationkey WHERE pages IS NOT NULL OR assets IS NOT NULL),
x AS (SELECT *, CASE WHEN r = 4 THEN low ELSE 0 END AS missing_files, CASE WHEN r = 3 THEN assets ELSE 0 END AS missing_secondary, CASE WHEN r = 2 AND pages > 0 THEN 1 ELSE 0 END AS endpoints, CASE WHEN r = 1 THEN pages ELSE 0 END AS remote_pages FROM n)
SELECT k AS system_id, pages, assets, missing_files, missing_secondary, endpoints, remote_pages, CASE WHEN missing_files + missing_secondary + endpoints > 0 THEN 'not_ready' WHEN remote_pages > 0 THEN 'ready_with_minor_gaps' ELSE 'ready' END AS verdict,
concat_ws(', ', CASE WHEN missing_files > 0 THEN missing_files || ' missing_files' END, CASE WHEN missing_secondary > 0 THEN missing_secondary || ' missing_secondary' END, CASE WHEN endpoints > 0 THEN endpoints || ' endpoints' END) AS blocking FROM x""")
def system_readiness(s, d):
    """Q08: whether the pages of each nation can do without a server, and why not"""
    region = table(s, d, "nation").select("n_nationkey", F.col("n_regionkey").alias("r"))
    c = table(s, d, "customer").join(region, F.col("n_nationkey") == F.col("c_nationkey"))
    html = told("<p>x</p>", F.when(F.col("r") == 1, '<img src="https://cdn.example/x.png">').when(F.col("r") == 2,
        told("<script>fetch('/api/n", F.col("c_nationkey"), "'); new WebSocket('wss://www.google-analytics.com/s')</script>")).otherwise(""))
    pages = c.select(F.col("c_nationkey").alias("system_id"), F.col("c_custkey").cast("string").alias("page_id"), told(SITE, "c", F.col("c_custkey")).alias("url"), html.alias("html"))
    a = table(s, d, "supplier").join(region, F.col("n_nationkey") == F.col("s_nationkey")).withColumn("url", told("https://w.example/a/s", F.col("s_suppkey"), ".css")).withColumn("present", (F.col("r") != 4) | (F.col("s_acctbal") >= 0))
    ref = F.when(F.col("r") == 3, told("missing", F.col("s_suppkey"), ".png")).otherwise(told("s", F.col("s_suppkey"), ".css"))
    sheets = a.filter("present").select(F.col("s_nationkey").alias("system_id"), "url", told("p{background:url(/a/", ref, ")}").alias("text"))
    assets = a.select(F.col("s_nationkey").alias("system_id"), "url", F.lit("style").alias("type"), "present", F.lit(True).alias("has_meta"))
    out, _ = quality.readiness(pages, assets, sheets, sheets.limit(0))
    return out.select("system_id", "pages", "assets", "missing_files", "missing_secondary", "endpoints", "remote_pages", "verdict", F.array_join("blocking", ", ").alias("blocking"))


@query("""WITH l AS (SELECT l_orderkey AS p, l_partkey::VARCHAR AS id, l_returnflag <> 'R' AS sel, l_linestatus = 'F' AS keyed FROM lineitem), t AS (SELECT * FROM l WHERE sel), o AS (SELECT o_orderpriority AS t, count(*) AS n FROM orders GROUP BY 1)
SELECT part, n::BIGINT AS n FROM (SELECT 'pages' AS part, count(*) AS n FROM orders UNION ALL SELECT 'with_records', count(DISTINCT p) FROM t WHERE p IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'duplicates', count(*) FROM (SELECT id FROM t GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'templates', count(*) FROM o UNION ALL SELECT 'shared_texts', count(*) FROM (SELECT 1 FROM t GROUP BY keyed HAVING count(DISTINCT id) > 1)
UNION ALL SELECT 'identity.records', count(*) FROM t UNION ALL SELECT 'identity.keyed', count(*) FILTER (keyed) FROM t UNION ALL SELECT 'identity.different', count(DISTINCT (p, id)) FILTER (keyed) FROM t
UNION ALL SELECT 'history.historical_cards', sum(o_custkey % 3) FROM orders UNION ALL SELECT 'history.related_cards', count(*) FILTER (o_orderstatus = 'P') FROM orders
UNION ALL SELECT 'history.records', count(*) FILTER (NOT sel) FROM l UNION ALL SELECT 'history.selected', 0 UNION ALL SELECT 'samples', sum(least(n, 5)) FROM o)""")
def order_family(s, d):
    """All parts of the audit of a family of pages: orders with their lines as records, returned ones as history"""
    flag = F.col("l_returnflag") == "R"
    key = F.when(F.col("l_linestatus") == "F", told("modifier:", F.col("l_partkey"))).otherwise(told("row:", F.col("l_linenumber")))
    records = table(s, d, "lineitem").select(F.col("l_orderkey").alias("page_id"), F.col("l_partkey").cast("string").alias("record_id"), F.lit("line").alias("record_type"), key.alias("key"),
        F.col("l_linestatus").alias("text"), F.when(flag, "historical").otherwise("current").alias("region"), (~flag).alias("selected"))
    pages = table(s, d, "orders").select(F.col("o_orderkey").alias("page_id"), F.col("o_orderpriority").alias("template"), (F.col("o_custkey") % 3).alias("historical_cards"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).cast("long").alias("related_cards"))
    found = quality.family_audit(records, pages)
    told_ = lambda name, df, *columns: df.select(F.explode(F.array(*[F.struct(F.lit(f"{name}{c}").alias("part"), F.col(c).cast("long").alias("n")) for c in columns])).alias("x")).select("x.*")
    counted = lambda name: found[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    out = told_("", found["completeness"], "pages", "with_records").unionByName(told_("identity.", found["identity"], "records", "keyed", "different")).unionByName(told_("history.",
        found["history"], "historical_cards", "related_cards", "records", "selected"))
    for name in ("duplicates", "templates", "shared_texts", "samples"):
        out = out.unionByName(counted(name))
    return out


@query("""SELECT (o_custkey // 100)::VARCHAR AS file, sum(1 + (o_orderpriority LIKE '5%')::INT) OVER (PARTITION BY o_custkey // 100 ORDER BY o_orderkey)::BIGINT AS line, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k, o_orderstatus = 'P' AS bad FROM orders""")
def numbered_json(s, d):
    """Lines of JSON files with their numbers, blank lines counted and bad ones kept"""
    path = new_folder(s, "numbered")
    line = F.when(F.col("o_orderstatus") == "P", told('{"k": ', F.col("o_orderkey"), ', "p')).otherwise(told('{"k": ', F.col("o_orderkey"), "}"))
    rows = table(s, d, "orders").select((F.col("o_custkey") / 100).cast("long").cast("string").alias("f"), "o_orderkey", F.concat(F.when(_is("5"), "\n").otherwise(""), line).alias("value"))
    rows.repartition("f").sortWithinPartitions("f", "o_orderkey").drop("o_orderkey").write.partitionBy("f").text(path)
    got = readers.read_occurrences(s, path, "k long", strict=False)
    return got.select(F.regexp_extract("_file", "/f=([0-9]+)/", 1).alias("file"), F.col("_line").alias("line"), "k", F.col("_corrupt_record").isNotNull().alias("bad"))


# ---- single functions


@query("""SELECT p_partkey AS k, 'image/' || substring(h, 1, 2) || '/' || h || CASE p_size % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' ELSE '' END AS path
FROM (SELECT p_partkey, p_size, sha256('https://w.example/i/' || p_partkey || CASE p_size % 3 WHEN 0 THEN '.PNG?v=1' WHEN 1 THEN '.jpg' ELSE '' END) AS h FROM part)""")
def asset_paths(s, d):
    """The places of assets, told by their type and the hash of their URL"""
    suffix = F.when(F.col("p_size") % 3 == 0, ".PNG?v=1").when(F.col("p_size") % 3 == 1, ".jpg").otherwise("")
    return table(s, d, "part").select(F.col("p_partkey").alias("k"), text.asset_path(told("https://w.example/i/", F.col("p_partkey"), suffix), F.lit("image")).alias("path"))


@query("""SELECT doc_id, sha256(regexp_replace(text, '(en)', '<mark>\\1</mark>', 'gi')) AS marked FROM documents""")
def marked_hits(s, d):
    """Hits marked in whole texts"""
    return table(s, d, "documents").select("doc_id", F.sha2(text.highlight(F.col("text"), "en"), 256).alias("marked"))


@query("""SELECT l_orderkey AS context_id, l_suppkey AS target_node, sum(CASE WHEN l_linestatus = 'F' THEN -l_linenumber ELSE l_linenumber END)::BIGINT AS total FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2""")
def node_sums(s, d):
    """Signed sums of matched modifiers over the keys of each node"""
    rows = table(s, d, "lineitem").select(F.col("l_orderkey").alias("context_id"), F.col("l_suppkey").alias("target_node"), F.col("l_partkey").alias("aggregation_key"),
        F.when(F.col("l_linestatus") == "F", "subtract").otherwise("add").alias("operation"), F.col("l_linenumber").cast("long").alias("value"), (F.col("l_returnflag") != "R").alias("matched"))
    return modifiers.node_totals(modifiers.aggregate_modifiers(rows))


@query("""SELECT lang, count(*) AS pages, count(*) FILTER (source IN ('src1', 'src2')) AS without_content FROM documents GROUP BY 1""")
def content_routes(s, d):
    """routes that hold no content of their own"""
    last = F.when(F.col("source") == "src1", "Login/").when(F.col("source") == "src2", "search").otherwise(told("d", F.col("doc_id")))
    rows = table(s, d, "documents").select("lang", urls.is_non_content(told(SITE, last)).alias("none"))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("pages"), F.count_if("none").alias("without_content"))


# ---- parse, lines, lists, entries, shells, search pages


@query("""WITH l AS (SELECT o_orderkey AS k, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1), t AS (SELECT sum(n) AS lines, count(*) AS pages FROM l)
SELECT x.tag, x.n::BIGINT AS n, x.nav::BIGINT AS in_navigation, x.depth FROM (SELECT unnest([{'tag': 'nav', 'n': pages, 'nav': 0, 'depth': 1}, {'tag': 'div', 'n': pages * 2, 'nav': 0, 'depth': 1}, {'tag': 'a', 'n': pages * 3 + lines, 'nav': pages * 2, 'depth': 3},
{'tag': 'ul', 'n': pages, 'nav': 0, 'depth': 1}, {'tag': 'li', 'n': lines, 'nav': 0, 'depth': 2}, {'tag': '#text', 'n': pages * 3 + lines, 'nav': pages * 2, 'depth': 4}, {'tag': 'body', 'n': pages, 'nav': 0, 'depth': 0}, {'tag': 'span', 'n': pages, 'nav': pages, 'depth': 2}]) AS x FROM t)""")
def tag_profile(s, d):
    """Nodes of each tag of all pages, and how many stand in navigation, told by tag, class or role"""
    item = told('<li><a href="p', F.col("l_partkey"), '">x</a></li>')
    lines = listed(table(s, d, "lineitem"), "l_orderkey", item, "l_linenumber", "l_partkey")
    o = table(s, d, "orders").join(lines, F.col("page_id") == F.col("o_orderkey"), "left")
    html = told('<body><nav><a href="1">a</a></nav><div role="x-Menu"><span><a href="2">b</a></span></div><div class="plain"><a href="3">c</a></div><ul>', F.coalesce("rows", F.lit("")), "</ul></body>")
    n = dom.marked_nodes(o.select(F.col("o_orderkey").alias("page_id"), html.alias("html")), {"nav": dom.navigation}, fields=["tag", "depth"])
    return n.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.count(dom.around("nav")).alias("in_navigation"), F.max("depth").alias("depth"))


@query("""SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) AS n, x AS line FROM (SELECT o_orderkey AS page_id, unnest(['order ' || o_orderkey, 'c' || o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'done' END, 'one two', o_orderpriority, 'tail']) AS x, unnest(range(6)) AS i FROM orders) WHERE x IS NOT NULL""")
def text_lines(s, d):
    """Lines between block elements; inline elements don't part them, empty ones are dropped"""
    html = told("<div>order  <b>", F.col("o_orderkey"), "</b><p>c", F.col("o_custkey"), "</p><p>", F.when(F.col("o_orderstatus") == "F", "done").otherwise(" "), "</p>one<i>\n two</i><br>", F.col("o_orderpriority"), "</div>tail<hr>")
    rows = extract.lines(dom.marked_nodes(order_pages(s, d, html), {}, fields=["tag", "own_text", "line"], plain=set()))
    n = F.row_number().over(_by("page_id", "first_node")).cast("long")
    return rows.select("page_id", n.alias("n"), "line")


@query("""SELECT 'inner' || o_orderstatus AS list, count(*) AS links FROM orders GROUP BY 1 UNION ALL SELECT 'outer', 2 * count(*) FROM orders UNION ALL SELECT NULL, count(*) FROM orders""")
def nearest_lists(s, d):
    """Links by the nearest list around them"""
    html = told('<ul id="outer"><li><a href="1">x</a><ol id="inner', F.col("o_orderstatus"), '"><li><b><a href="2">x</a></b></li></ol><a href="3">x</a></li></ul><a href="4">x</a>')
    nodes = dom.marked_nodes(order_pages(s, d, html), {"list": lambda t, a, c: a.get("id", "") if t in ("ul", "ol") else None}, fields=["tag"], texts=False, plain={"a"})
    return nodes.filter("tag = 'a'").groupBy(F.col("list.value").alias("list")).agg(F.count(F.lit(1)).alias("links"))


@query("""WITH o AS (SELECT o_custkey AS k, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS double FROM orders GROUP BY 1), p AS (SELECT c_custkey AS page_id, c_nationkey < 5 AS wrong, n AS n_unique, double AS duplicates, n + double AS occurrences FROM customer JOIN o ON k = c_custkey),
q AS (SELECT *, CASE WHEN NOT wrong THEN n_unique WHEN n_unique + 1 <= occurrences THEN n_unique + 1 END::INT AS displayed FROM p)
SELECT page_id, n_unique, occurrences, duplicates, displayed, n_unique AS entries, round(greatest(0::DOUBLE, least(0.99::DOUBLE, 0.70::DOUBLE + (CASE WHEN n_unique >= 10 THEN 0.20 WHEN n_unique >= 2 THEN 0.10 ELSE 0 END)::DOUBLE
+ (CASE WHEN displayed IS NULL THEN 0 WHEN displayed = n_unique THEN 0.09 ELSE -0.05 END)::DOUBLE - 0.20::DOUBLE * least(duplicates::DOUBLE / occurrences::DOUBLE, 1::DOUBLE)))::VARCHAR::DECIMAL(20, 18), 2)::DOUBLE AS confidence FROM q""")
def directory_entries(s, d):
    """Different entries of directory pages, with what their headings say and how sure they are. SQL takes each row for an entry or a
    page, so links tell an order's place too, and pages which of a key's rows they are: keys may be missing or repeat."""
    def links(o, i):
        link = told('<li><a href="/en/o', F.coalesce(o["o_orderkey"].cast("string"), F.lit("")), "-", i, '">o</a></li>')
        return F.concat(link, F.when(o["o_orderstatus"] == "F", link).otherwise(""))

    o = dealt(table(s, d, "orders"), "o_custkey").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("orders"))
    c = dealt(table(s, d, "customer"), "c_custkey").withColumn("copy", F.row_number().over(_by("c_custkey", "c_nationkey"))).join(o, F.col("o_custkey") == F.col("c_custkey"))
    wrong = F.coalesce(F.col("c_nationkey") < 5, F.lit(True))
    html = told('<nav><a href="/en/nav">n</a></nav><main><div><h2>Orders / ', F.size("orders") + wrong.cast("int"), "</h2><ul>", F.array_join(F.transform("orders", links), ""), '</ul></div></main><p><a href="https://o.example/en/x">x</a></p>')
    entries, report = directory.entries_from_pages(c.select(F.struct("c_custkey", "copy").alias("page_id"), told(SITE, "c", F.col("c_custkey")).alias("url"), html.alias("html")))
    out = report.join(entries.groupBy("page_id").agg(F.count(F.lit(1)).alias("entries")), "page_id")
    return out.select(F.col("page_id.c_custkey").alias("page_id"), "n_unique", "occurrences", "duplicates", "displayed", "entries", "confidence")


@query("SELECT count(*) AS pages, min(o_orderkey) AS first_page FROM orders GROUP BY o_orderstatus, o_orderpriority, o_orderpriority LIKE '1%'")
def shell_kinds(s, d):
    """Pages by the signature of what frames them: style sheets, scripts, navigation; their own texts don't count"""
    html = told('<link rel="s" href="/', F.col("o_orderstatus"), '.css"><script src="/', F.col("o_orderpriority"), '.js"></script>', F.when(_is("1"), "<nav>x</nav>").otherwise(""), "<p>", F.col("o_orderkey"), "</p>")
    shells = extract.page_shell(order_pages(s, d, html))
    return shells.groupBy("shell").agg(F.count(F.lit(1)).alias("pages"), F.min("page_id").alias("first_page")).drop("shell")


@query("""WITH p AS (SELECT doc_id, '/en/' || sha256(split_part(text, chr(10), 1)) AS route, split_part(text, chr(10), 1) AS title, source, lang, text FROM documents), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY route ORDER BY doc_id) AS n FROM p) WHERE n = 1),
e AS (SELECT route, min(doc_id) AS k, CASE WHEN min(lang) = 'en' THEN 'skill' ELSE 'item' END AS kind, CASE WHEN max(source) = 'src9' THEN 'Summary ' || min(doc_id) WHEN max(source) = 'src8' THEN ' ' END AS summary FROM p WHERE source <> 'src0' GROUP BY 1)
SELECT doc_id AS page_id, CASE WHEN kind = 'skill' THEN 'main' ELSE source END AS system_id, 'e' || k AS entity_id, CASE WHEN k IS NULL THEN sha256(title) ELSE sha256('Entity ' || k) END AS title, CASE WHEN k IS NULL THEN 'system ' || source ELSE 'cat ' || kind END AS category, sha256(coalesce(nullif(trim(summary), ''), text)) AS text
FROM f LEFT JOIN e ON e.route = f.route""")
def search_pages_built(s, d):
    """One search page for each route, with its entity's title, category and summary, and pages of one kind given over to its system"""
    route = F.concat(F.lit("/en/"), F.sha2(F.split_part("text", F.lit("\n"), F.lit(1)), 256))
    p = table(s, d, "documents").select(F.col("doc_id").alias("page_id"), route.alias("route"), F.col("source").alias("system_id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.col("text").alias("cached_text"), "lang")
    g = p.filter("system_id <> 'src0'").groupBy("route").agg(F.min("page_id").alias("k"), F.min("lang").alias("lang"), F.max("system_id").alias("top"))
    kind = F.when(F.col("lang") == "en", "skill").otherwise("item")
    e = g.select("route", told("e", F.col("k")).alias("entity_id"), told("Entity ", F.col("k")).alias("title"), told("cat ", kind).alias("category"), kind.alias("entity_type"),
        F.when(F.col("top") == "src9", told("Summary ", F.col("k"))).when(F.col("top") == "src8", " ").alias("clean_summary"))
    systems = p.select("system_id").distinct().withColumn("category", F.concat(F.lit("system "), "system_id"))
    built = search.refresh_ownership(search.build_search_pages(p.drop("lang"), e, systems), e, "skill", "main")
    return built.select("page_id", "system_id", "entity_id", F.sha2("title", 256).alias("title"), "category", F.sha2("text", 256).alias("text"))
