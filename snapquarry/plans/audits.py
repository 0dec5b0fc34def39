"""Registered queries over pages that are made of the tables' own rows, and audits, each with its SQL (see registry).

The driver's `pages` have no tables, assets, tooltips or cards. These queries write every row of a table as a page with
such markup and read it off again, so that the operators run over whole tables and SQL can say what must come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nested, text
from ..operators import aggregates as agg
from ..operators import directory, extract, quality
from .queries import dealt, page_links, query, table


def line_pages(s: SparkSession, d: str) -> DataFrame:
    """A page for each order: a section with a table of its lines."""
    row = F.concat(F.lit('<tr data-modifier-id="'), F.col("l_partkey").cast("string"), F.lit('" data-tier="'), F.col("l_returnflag"), F.lit('"><td>'), F.col("l_linenumber").cast("string"),
        F.lit("</td><td>"), F.col("l_linestatus"), F.lit("</td></tr>"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("row")))), lambda r: r["row"]), "")
    lines = dealt(table(s, d, "lineitem"), "l_orderkey").groupBy(F.col("l_orderkey").alias("page_id")).agg(rows.alias("rows"))
    return lines.select("page_id", F.concat(F.lit('<div id="lines"><table><tr><th>Level</th><th>Status</th></tr>'), "rows", F.lit("</table></div>")).alias("html"))


@query("""SELECT l_orderkey AS page_id, 'lines' AS section_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS row_index, 'Level|Status' AS headers,
l_linenumber || '|' || l_linestatus AS cells, l_partkey::VARCHAR AS stable_key, l_returnflag AS tier_value FROM lineitem""")
def section_lines(s, d):
    """Rows of section tables"""
    rows = extract.section_rows(line_pages(s, d))
    return rows.select("page_id", "section_id", F.col("row_index").cast("long").alias("row_index"), F.array_join("headers", "|").alias("headers"), F.array_join("cells", "|").alias("cells"), "stable_key", "tier_value")


@query("""SELECT l_orderkey AS page_id, count(*) AS rows, count(*) AS keyed, count(*) AS n, min(l_linenumber)::BIGINT AS least, max(l_linenumber)::BIGINT AS greatest FROM lineitem GROUP BY 1""")
def level_profiles(s, d):
    """Descriptor of each section, and the level table of each page"""
    rows = extract.section_rows(line_pages(s, d))
    best = extract.level_tables(rows).select("page_id", "section_id", "n", F.col("least").cast("long").alias("least"), F.col("greatest").cast("long").alias("greatest"))
    return extract.section_descriptor(rows).join(best, ["page_id", "section_id"]).select("page_id", "rows", "keyed", "n", "least", "greatest")


def asset_pages(s: SparkSession, d: str) -> DataFrame:
    """A page for each part: an image with a larger one, a style sheet, a script and a styled box."""
    k = lambda n: (F.col("p_partkey") % n).cast("string")
    html = F.concat(F.lit('<link href="/c/'), k(7), F.lit('.css"><img src="/i/'), k(97), F.lit('.png" srcset="/i/'), k(97), F.lit('@2.png 2x, /j/'), k(5),
        F.lit('.webp 3x"><script src="/s.js"></script><p style="background: url(/b/'), k(3), F.lit('.gif)">x</p>'))
    return table(s, d, "part").select(F.col("p_partkey").alias("page_id"), html.alias("html"))


ASSETS = """SELECT p_partkey AS page_id, unnest([{'a': 'href', 'u': '/c/' || (p_partkey % 7) || '.css'}, {'a': 'src', 'u': '/i/' || (p_partkey % 97) || '.png'}, {'a': 'srcset', 'u': '/i/' || (p_partkey % 97) || '@2.png'},
{'a': 'srcset', 'u': '/j/' || (p_partkey % 5) || '.webp'}, {'a': 'src', 'u': '/s.js'}, {'a': 'style', 'u': '/b/' || (p_partkey % 3) || '.gif'}]) AS r FROM part"""


@query(f"SELECT r.a AS attribute, r.u AS url, count(*) AS refs, count(DISTINCT page_id) AS pages FROM ({ASSETS}) GROUP BY 1, 2")
def asset_references(s, d):
    """References by attribute"""
    refs = extract.asset_refs(asset_pages(s, d))
    return refs.groupBy("attribute", "url").agg(F.count(F.lit(1)).alias("refs"), F.count_distinct("page_id").alias("pages"))


@query(f"""WITH r AS ({ASSETS}), p AS (SELECT r.u AS url, page_id, row_number() OVER (PARTITION BY r.u ORDER BY page_id) AS n FROM r), t AS (SELECT r.u AS url, count(*) AS ref_count FROM r GROUP BY 1)
SELECT t.url, CASE WHEN t.url LIKE '%.css' THEN 'style' WHEN t.url LIKE '%.js' THEN 'script' ELSE 'image' END AS type, ref_count, string_agg(CASE WHEN n <= 20 THEN page_id::VARCHAR END, ',' ORDER BY page_id) AS refs FROM t JOIN p ON p.url = t.url GROUP BY 1, 2, 3""")
def asset_table(s, d):
    """Assets with type, count and first pages"""
    refs = extract.asset_refs(asset_pages(s, d)).select("page_id", "url", text.asset_type(F.col("url")).alias("type"))
    out = agg.assets(refs)
    return out.select("url", "type", "ref_count", F.array_join(F.transform("refs", lambda x: x.cast("string")), ",").alias("refs"))


@query(f"""WITH r AS (SELECT r.u AS url, count(*) AS k, CASE WHEN r.u LIKE '%.css' THEN 'style' WHEN r.u LIKE '%.js' THEN 'script' ELSE 'image' END AS type FROM ({ASSETS}) GROUP BY 1)
SELECT 'type' AS kind, type AS value, count(*) AS n FROM r GROUP BY 2 UNION ALL SELECT 'host', 'w.example', count(*) FROM r UNION ALL SELECT 'duplicates', NULL, (sum(k) - count(*))::BIGINT FROM r""")
def asset_summary(s, d):
    """Assets by type and host, and references beyond the first"""
    refs = extract.asset_refs(asset_pages(s, d)).select("page_id", F.concat(F.lit("https://w.example"), "url").alias("url"), text.asset_type(F.col("url")).alias("type"))
    return agg.asset_summary(agg.assets(refs))


@query("""SELECT s_suppkey AS url, unnest(['import', 'font', 'url']) AS kind, unnest(['/i' || (s_suppkey % 9) || '.css', '/f' || s_suppkey || '.woff', '/g' || s_nationkey || '.png']) AS ref FROM supplier""")
def css_references(s, d):
    """References of style sheets"""
    k = lambda c: c.cast("string")
    css = F.concat(F.lit("@import url('/i"), k(F.col("s_suppkey") % 9), F.lit(".css'); @font-face { src: url(/f"), k(F.col("s_suppkey")), F.lit(".woff) } .a { background: url(\"/g"), k(F.col("s_nationkey")), F.lit('.png") }'))
    return extract.css_refs(table(s, d, "supplier").select(F.col("s_suppkey").alias("url"), css.alias("css")))


@query("""SELECT doc_id AS page_id, 's1.tooltip.page.' || doc_id || '.0' AS occurrence_id, CASE WHEN doc_id % 3 = 0 THEN 'missing' WHEN doc_id % 3 = 1 THEN 'text' ELSE 'html' END AS method,
CASE WHEN doc_id % 3 = 2 THEN source END AS title, CASE WHEN doc_id % 3 = 1 THEN source || ' ' || lang WHEN doc_id % 3 = 2 THEN lang || chr(10) || n_chars END AS text FROM documents""")
def tooltip_occurrences(s, d):
    """Tooltips of three kinds"""
    k = F.col("doc_id") % 3
    html = F.concat(F.lit("&lt;div&gt;&lt;div&gt;"), "source", F.lit("&lt;/div&gt;&lt;div&gt;"), "lang", F.lit("&lt;br/&gt;"), F.col("n_chars").cast("string"), F.lit("&lt;/div&gt;&lt;/div&gt;"))
    title = F.when(k == 0, "").when(k == 1, F.concat(F.lit(' data-bs-title="'), "source", F.lit("  "), "lang", F.lit('"'))).otherwise(F.concat(F.lit(' data-bs-title="'), html, F.lit('"')))
    pages = table(s, d, "documents").select(F.col("doc_id").alias("page_id"), F.concat(F.lit('<a data-bs-toggle="tooltip"'), title, F.lit(">t</a>")).alias("html"))
    return extract.tooltip_occurrences(pages).select("page_id", "occurrence_id", "method", "title", "text")


@query("""WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st FROM orders)
SELECT 'endpoint' AS kind, 'https://w.example/api/c' || c AS value, count(*) AS n FROM o GROUP BY 2 UNION ALL SELECT 'endpoint', 'https://w.example/en/list?k=' || c, count(*) FROM o GROUP BY 2
UNION ALL SELECT 'tracking', 'wss://www.google-analytics.example/s', count(*) FROM o WHERE st = 'F' HAVING count(*) > 0 UNION ALL SELECT 'hint', '/api/', count(*) FROM o
UNION ALL SELECT 'hint', unnest(['/ajax/', '/search', '/cn/', '/tooltip', '/json']), 0 UNION ALL SELECT 'navigates', (st = 'O')::VARCHAR, count(*) FROM o GROUP BY 2""")
def runtime_calls(s, d):
    """What scripts call, hints in URLs, pages whose scripts navigate"""
    c = F.col("o_custkey").cast("string")
    more = F.when(F.col("o_orderstatus") == "F", 'new WebSocket("wss://www.google-analytics.example/s")').when(F.col("o_orderstatus") == "O", "location.href = x").otherwise("")
    html = F.concat(F.lit("<script>fetch('/api/c"), c, F.lit("'); r.open('GET', 'list?k="), c, F.lit("');"), more, F.lit("</script>"))
    pages = table(s, d, "orders").select(F.col("o_orderkey").alias("page_id"), F.concat(F.lit("https://w.example/en/o"), F.col("o_orderkey").cast("string")).alias("url"), html.alias("html"))
    called = extract.call_urls(pages).groupBy("kind", F.col("target").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    hints = extract.url_hints(pages).select(F.lit("hint").alias("kind"), F.col("hint").alias("value"), "n")
    moves = extract.script_calls(pages).groupBy(F.col("navigates").cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return called.unionByName(hints).unionByName(moves.select(F.lit("navigates").alias("kind"), "value", "n"))


@query("""SELECT CASE WHEN doc_id % 3 = 0 THEN 'missing' WHEN doc_id % 3 = 1 THEN 'text' ELSE 'html' END AS method, count(*) AS n FROM documents GROUP BY 1""")
def tooltip_methods(s, d):
    """Tooltips by the way they were read"""
    k = F.col("doc_id") % 3
    title = F.when(k == 0, "").when(k == 1, ' data-bs-title="plain"').otherwise(' data-bs-title="&lt;b&gt;x&lt;/b&gt;"')
    pages = table(s, d, "documents").select(F.col("doc_id").alias("page_id"), F.concat(F.lit("<i data-bs-toggle='tooltip'"), title, F.lit(">t</i>")).alias("html"))
    return agg.extract_methods(extract.tooltip_occurrences(pages))


@query("""SELECT lang AS shell, count(*) AS pages, count(DISTINCT source) AS hosts, row_number() OVER (ORDER BY count(*) DESC, lang DESC) = 1 AS dominant FROM documents WHERE lang IS NOT NULL GROUP BY 1""")
def shell_report(s, d):
    """Shells of pages, their hosts, and the one that most pages have"""
    docs = table(s, d, "documents").filter("lang is not null")
    return agg.shell_report(docs.select(F.concat(F.lit("https://"), "source", F.lit("/p")).alias("url"), F.col("lang").alias("shell")))


@query("""SELECT page_id, string_agg(t, ' ' ORDER BY i) AS text FROM (SELECT o_orderkey AS page_id, unnest(['shown ' || o_custkey, CASE WHEN o_orderstatus <> 'F' THEN 'Head list' END, CASE WHEN o_orderpriority LIKE '5%' THEN 'pane' END]) AS t, unnest([1, 2, 3]) AS i FROM orders) WHERE t IS NOT NULL GROUP BY 1""")
def strict_text(s, d):
    """Strict visible text; link-list cards and inactive panes are left out"""
    head = F.when(F.col("o_orderstatus") == "F", "Related Skills").otherwise("Head")
    active = F.when(F.col("o_orderpriority").startswith("5"), " active").otherwise("")
    html = F.concat(F.lit("<p>shown "), F.col("o_custkey").cast("string"), F.lit('</p><div class="card"><div class="card-header">'), head,
        F.lit('</div><ul><li>list</li></ul></div><div class="tab-pane'), active, F.lit('">pane</div><p hidden>gone</p>'))
    return extract.visible_text(table(s, d, "orders").select(F.col("o_orderkey").alias("page_id"), html.alias("html")), strict=True)


@query("""SELECT event_type AS system_id, count(*) AS pages, count(*) FILTER (value >= 10) AS ok, count(*) FILTER (value < 10 OR value IS NULL) AS failed FROM events GROUP BY ROLLUP (event_type)""")
def event_batches(s, d):
    """Outcomes by system and in total"""
    return directory.batch_report(table(s, d, "events").select(F.col("event_type").alias("system_id"), F.when(F.col("value") >= 10, "ok").otherwise("failed").alias("outcome")))


@query("""SELECT n_nationkey AS system_id, CASE WHEN k = 'confirmed_directory' THEN 'confirmed' WHEN k = 'content_page' THEN 'rejected' ELSE 'candidate' END AS discovery_status,
CASE WHEN k = 'relation_index' THEN 'relation' WHEN k = 'confirmed_directory' THEN 'directory' END AS role
FROM nation LEFT JOIN (SELECT s_nationkey, CASE WHEN count(*) % 3 = 0 THEN 'confirmed_directory' WHEN count(*) % 3 = 1 THEN 'content_page' ELSE 'relation_index' END AS k FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey""")
def classified_systems(s, d):
    """Status and role of systems from what was verified"""
    n = F.count(F.lit(1)) % 3
    results = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("system_id")).agg(F.when(n == 0, "confirmed_directory").when(n == 1, "content_page").otherwise("relation_index").alias("page_type"))
    systems = table(s, d, "nation").select(F.col("n_nationkey").alias("system_id"), F.lit("candidate").alias("discovery_status"))
    return directory.apply_classification(systems, results).select("system_id", "discovery_status", "role")


@query("""SELECT count(*) AS pages, count(*) FILTER (contains(html, 'track(')) AS track, CASE WHEN count(*) FILTER (contains(html, 'track(')) > 0 THEN 'needs_runtime' ELSE 'static' END AS verdict FROM pages""")
def runtime_dependencies(s, d):
    """Pages that need a server"""
    return quality.dependency_audit(extract.script_calls(table(s, d, "pages")), ["track"])


@query("""SELECT url, asset AS type FROM (SELECT '/a/' || p_partkey || (['.css', '.js', '.png', '.json'])[(p_partkey % 4) + 1] AS url, (['style', 'script', 'image', 'data'])[(p_partkey % 4) + 1] AS asset, (['text/css', 'application/javascript', 'image/png', 'application/json'])[(p_size % 4) + 1] AS got, p_partkey % 4 = p_size % 4 AS fits FROM part) WHERE NOT fits""")
def type_warnings(s, d):
    """Content types that don't fit"""
    pick = lambda c, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (c % 4 + 1).cast("int"))
    assets = table(s, d, "part").select(F.concat(F.lit("/a/"), F.col("p_partkey").cast("string"), pick(F.col("p_partkey"), ".css", ".js", ".png", ".json")).alias("url"),
        pick(F.col("p_size"), "text/css", "application/javascript", "image/png", "application/json").alias("content_type"))
    return quality.type_warning(assets).select("url", "type")


@query("""SELECT CASE WHEN n_chars = 0 THEN 'empty' WHEN contains(text, chr(10)) THEN 'lines' WHEN n_chars > 2000 THEN 'long' ELSE 'other' END AS template, count(*) AS n FROM documents GROUP BY 1""")
def document_templates(s, d):
    """the first rule that a document meets"""
    rules = [("empty", F.col("n_chars") == 0), ("lines", F.contains("text", F.lit("\n"))), ("long", F.col("n_chars") > 2000)]
    return quality.template_group(table(s, d, "documents"), rules).groupBy("template").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, sha256(trim(split_part(split_part(split_part(text, ' - ', 1), ' | ', 1), '_', 1))) AS title FROM (SELECT doc_id, trim(regexp_replace(split_part(text, chr(10), 1), '[\\s\\x0B\\x{85}\\x{A0}]+', ' ', 'g')) AS text FROM documents)""")
def site_titles(s, d):
    """Titles without the site's name"""
    first = text.clean(F.split_part("text", F.lit("\n"), F.lit(1)))
    return table(s, d, "documents").select("doc_id", F.sha2(text.clean_title(first), 256).alias("title"))


@query("""WITH w AS (SELECT o_custkey AS k, list(o_orderpriority ORDER BY o_orderkey) AS v FROM orders GROUP BY 1)
SELECT k, len(list_distinct(v)) AS kinds, array_to_string(list_sort(v)[1:3], ',') AS smallest, len(list_filter(list_distinct(v), lambda x: x NOT IN ('1-URGENT', '2-HIGH'))) AS others FROM w""")
def priority_sets(s, d):
    """Distinct, smallest and unknown values of lists"""
    v = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))), lambda x: x["o_orderpriority"])
    w = table(s, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(v.alias("v"))
    known = F.array(F.lit("1-URGENT"), F.lit("2-HIGH"))
    return w.select("k", F.size(nested.distinct_nonempty(F.col("v"))).cast("long").alias("kinds"), F.array_join(nested.first_sorted(F.col("v"), 3), ",").alias("smallest"),
        F.size(nested.missing_from(F.col("v"), known)).cast("long").alias("others"))
