"""Registered queries of single functions and smaller operators (E, M, N05, Q, U03, W09, S02, S04, S12), each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, nested, text, urls
from ..operators import directory, dom, entities, modifiers, quality
from ..operators import relational as rel
from ..sources import readers
from .audits import line_pages
from .queries import query, table

SITE = "https://w.example/en/"


def told(*parts):
    """Columns and texts put together as one text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query(r"""SELECT doc_id, sha256('["' || source || '","' || lang || '"]') AS definition,
sha256(replace(lower(trim(regexp_replace(text, '[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))), 'ß', 'ss')) AS fingerprint
FROM documents""")
def document_hashes(s, d):
    """Definition hash of source and language, fingerprint of whole texts"""
    return table(s, d, "documents").select(
        "doc_id", hashing.definition_hash(F.col("source"), F.col("lang")).alias("definition"), hashing.fingerprint(F.col("text")).alias("fingerprint"))


@query("SELECT p_partkey, 'made in ' || p_size || ' by' AS summary FROM part")
def part_summaries(s, d):
    """Texts without slug and titles, in any case, and without noise"""
    said = told(F.upper("p_name"), " made in ", F.col("p_size"), "  by (noise) ", F.col("p_brand"))
    out = text.clean_summary(said, F.col("p_brand"), F.array("p_name"), (r"\(noise\)",))
    return table(s, d, "part").select("p_partkey", out.alias("summary"))


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '名' || c_custkey WHEN 1 THEN c_name WHEN 2 THEN '译' || c_nationkey WHEN 3 THEN c_mktsegment ELSE c_custkey::VARCHAR END AS name
FROM customer""")
def customer_names(s, d):
    """Own name in Han, listed name, translation, fallback, id, the first that there is"""
    k = F.col("c_custkey") % 5
    own = F.when(k == 0, told("名", F.col("c_custkey"))).otherwise("Own name")
    translated = F.when(k == 2, told("译", F.col("c_nationkey"))).otherwise(" ")
    name = text.display_name(own, F.when(k == 1, F.col("c_name")), translated, F.when(k == 3, F.col("c_mktsegment")), F.col("c_custkey").cast("string"))
    return table(s, d, "customer").select("c_custkey", name.alias("name"))


@query(r"SELECT o_orderkey, nullif(regexp_extract(o_orderpriority, '^(\d+)-', 1), '')::INT AS level FROM orders")
def priority_levels(s, d):
    """A number out of a text"""
    return table(s, d, "orders").select("o_orderkey", text.extract_number(F.col("o_orderpriority"), r"^(\d+)-").alias("level"))


@query("SELECT p_partkey, p_brand AS name, CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'plain' END AS variant FROM part")
def part_variants(s, d):
    """Names parted at a bar, with a default"""
    both = F.when(F.col("p_size") % 2 == 0, told(F.col("p_brand"), " | ", F.col("p_type"))).otherwise(F.col("p_brand"))
    return table(s, d, "part").select("p_partkey", text.split_name(both, "plain").alias("n")).select("p_partkey", "n.name", "n.variant")


@query("""SELECT doc_id, sum(len(string_split(l, ' ')))::BIGINT AS effects, count(*) - 1 AS last_node FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)
GROUP BY 1""")
def nested_effects(s, d):
    """Nested documents (lines, each with a level of words) as rows, counted"""
    node = F.transform(F.split("text", "\n"), lambda x: F.struct(F.array(F.struct(F.split(x, " ").alias("effects"))).alias("levels")))
    rows = nested.flatten_effects(table(s, d, "documents").filter("text is not null").select("doc_id", node.alias("nodes")))
    return rows.groupBy("doc_id").agg(F.count("effect").alias("effects"), F.max("node_no").cast("long").alias("last_node"))


@query("SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN p_size ELSE -1 END AS looked, p_partkey AS second, p_size::BIGINT AS first FROM part")
def part_maps(s, d):
    """Look-up with a default, and merged maps"""
    both = nested.merged(F.create_map(F.lit("size"), F.col("p_size").cast("long"), F.lit("key"), F.lit(0).cast("long")), F.create_map(F.lit("key"), F.col("p_partkey")))
    looked = nested.looked_up(F.create_map("p_brand", "p_size"), F.lit("Brand#1"), F.lit(-1))
    return table(s, d, "part").select("p_partkey", looked.alias("looked"), F.try_element_at(both, F.lit("key")).alias("second"), F.try_element_at(both, F.lit("size")).alias("first"))


@query("""SELECT doc_id, sha256(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')) AS escaped, sha256(text) AS back
FROM documents""")
def escaped_texts(s, d):
    """Whole texts escaped, and back"""
    e = table(s, d, "documents").select("doc_id", text.escape(F.col("text")).alias("e"))
    return e.select("doc_id", F.sha2("e", 256).alias("escaped"), F.sha2(text.unescape(F.col("e")), 256).alias("back"))


@query("""SELECT l_orderkey AS context_id, 'l' || l_linenumber AS id, CASE WHEN l_returnflag = 'R' THEN 'l' || l_linenumber || ': ' || l_linestatus || ' ' || l_partkey || ' to s' || l_suppkey
ELSE 'l' || l_linenumber || ': rejected by ' || l_returnflag END AS line FROM lineitem""")
def trace_texts(s, d):
    """A line for each modifier that was looked at"""
    rows = table(s, d, "lineitem").select(
        F.col("l_orderkey").alias("context_id"), told("l", F.col("l_linenumber")).alias("id"), (F.col("l_returnflag") == "R").alias("matched"), F.col("l_linestatus").alias("operation"),
        F.col("l_partkey").alias("value"), told("s", F.col("l_suppkey")).alias("target_node"), F.col("l_returnflag").alias("reason"))
    return modifiers.trace_lines(rows)


@query("""WITH o AS (SELECT '/en/c' || o_custkey AS route, count(*) AS pages, min(o_orderkey) AS first_page FROM orders GROUP BY 1), c AS (SELECT '/en/c' || c_custkey AS route FROM customer WHERE c_nationkey < 20)
SELECT coalesce(o.route, c.route) AS route, coalesce(pages, 0) AS pages, first_page, CASE WHEN c.route IS NULL THEN 'snapshot' WHEN o.route IS NULL THEN 'index' ELSE 'index,snapshot' END AS evidence
FROM o FULL JOIN c ON o.route = c.route""")
def snapshot_routes(s, d):
    """Linked routes with their evidence"""
    o = table(s, d, "orders")
    pages = o.select(F.col("o_orderkey").alias("page_id"), told(SITE, "o", F.col("o_orderkey")).alias("url"), told('<a href="c', F.col("o_custkey"), '">c</a>').alias("html"))
    indexed = table(s, d, "customer").filter("c_nationkey < 20").select(told("/en/c", F.col("c_custkey")).alias("route"))
    return directory.routes_from_snapshot(pages, indexed).withColumn("evidence", F.array_join("evidence", ","))


@query("""WITH c AS (SELECT '/en/p' || l_partkey AS route, CASE l_returnflag WHEN 'N' THEN 'available' WHEN 'R' THEN 'redirected' ELSE 'not_found' END AS status, l_orderkey * 10 + l_linenumber AS pos FROM lineitem)
SELECT 'page' AS kind, route AS value, min(pos) AS n FROM c WHERE status = 'available' GROUP BY 2 UNION ALL SELECT 'status', status, count(*) FROM c GROUP BY 2""")
def recovered_pages(s, d):
    """The first available candidate of each route, and counts by validation"""
    status = F.when(F.col("l_returnflag") == "N", "available").when(F.col("l_returnflag") == "R", "redirected").otherwise("not_found")
    pos = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    good, counts = directory.recovered_manifest(table(s, d, "lineitem").select(told("/en/p", F.col("l_partkey")).alias("route"), status.alias("status"), pos.alias("pos")))
    return good.select(F.lit("page").alias("kind"), F.col("route").alias("value"), F.col("pos").alias("n")).unionByName(counts.select(F.lit("status").alias("kind"), F.col("status").alias("value"), "n"))


@query("""SELECT CASE WHEN source IN ('src0', 'src1') THEN 'recovered' WHEN source IN ('src2') THEN 'secondary' WHEN source IN ('src3') THEN 'support' WHEN source IN ('src4', 'src5') THEN 'primary' ELSE 'source' END AS role,
count(*) AS n FROM documents GROUP BY 1""")
def source_roles(s, d):
    """Roles of systems; a system of several lists has the first role"""
    role = entities.source_role(F.coalesce("source", F.lit("")), ["src0", "src1"], ["src2", "src1"], ["src3", "src2"], ["src4", "src5"])
    return table(s, d, "documents").groupBy(role.alias("role")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_suppkey, count(*) AS n, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS owners FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def shared_suppliers(s, d):
    """Q05: keys that occur twice, with whose they are"""
    return quality.unique_gate(table(s, d, "lineitem"), "l_suppkey", "l_returnflag").withColumn("owners", F.array_join("owners", ","))


@query("""SELECT c_custkey AS k, 'missing' AS side FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) UNION ALL
SELECT DISTINCT user_id, 'extra' FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)""")
def customers_and_users(s, d):
    """Keys of one table only"""
    users = table(s, d, "events").filter("user_id is not null")
    return rel.set_difference(table(s, d, "customer").select(F.col("c_custkey").alias("k")), users.select(F.col("user_id").alias("k")), "k")


@query("""SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'https://w.example/f' || s_suppkey WHEN 1 THEN 'https://w.example/u' || s_suppkey WHEN 2 THEN 'https://w.example/s' || s_suppkey
ELSE 'https://w.example/x' || s_suppkey END AS url FROM supplier""")
def base_urls(s, d):
    """The first URL that the metadata of a page name, else one of its site and slug"""
    k, at = F.col("s_suppkey"), F.col("s_suppkey") % 4
    base = table(s, d, "supplier").select(k, told("n", F.col("s_nationkey")).alias("system_id"), told("x", k).alias("slug"), at.alias("at"))
    url = lambda letter: told("https://w.example/", letter, k)
    meta = base.filter("at < 3").select("system_id", "slug", F.when(F.col("at") == 0, url("f")).otherwise(" ").alias("final_url"), F.when(F.col("at") < 2, url("u")).alias("url"), url("s").alias("source_url"))
    return readers.with_base_url(base, meta, "https://w.example/").select("s_suppkey", "url")


@query("SELECT 'manifest' AS source_type, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer UNION ALL SELECT 'extra', count(*), sum(s_suppkey)::BIGINT FROM supplier")
def supplement_types(s, d):
    """A manifest and its supplement, told apart"""
    main, extra = table(s, d, "customer").select(F.col("c_custkey").alias("k"), "c_name"), table(s, d, "supplier").select(F.col("s_suppkey").alias("k"))
    return readers.union_sources(main, extra, "extra").groupBy("source_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys"))


@query("""SELECT DISTINCT o_custkey AS k, 'own' AS origin FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT c_custkey, 'legacy' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def season_customers(s, d):
    """Rows of the default season, missing keys from the legacy table"""
    own = table(s, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("season"), F.lit("own").alias("origin")).distinct()
    legacy = table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("legacy").alias("origin"))
    return readers.season_scope(own, "F", "F", legacy, ["k"]).select("k", "origin")


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN 'https://w.example/en/a/b' || l_partkey WHEN 1 THEN 'https://w.example/b' || l_partkey || '?q=../x' WHEN 2 THEN 'https://w.example/en/a/'
WHEN 3 THEN 'https://cdn.example/x/../' || l_partkey ELSE 'https://w.example/en/a/p?k=' || l_partkey END AS target FROM lineitem""")
def resolved_links(s, d):
    """Relative, rooted, absolute and query links with dot segments"""
    k = F.col("l_linenumber") % 5
    href = (F.when(k == 0, told("./x/../b", F.col("l_partkey"), "#f")).when(k == 1, told("/z/.././b", F.col("l_partkey"), "?q=../x")).when(k == 2, "c/..")
            .when(k == 3, told("//cdn.example/x/../", F.col("l_partkey"))).otherwise(told("?k=", F.col("l_partkey"))))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", urls.resolve_url(href, F.lit(SITE + "a/p")).alias("target"))
