"""Registered queries of readers, sinks, extractors and incremental runs (S, Q01, V01, X), each with its SQL.

They write whole tables in a file format into the shared folder (`scratch`) and read them back. Documents of one file each
hold at most 1,000 rows of a table, so no file or group grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import extract, quality, records
from ..sources import readers, sinks
from ..sources.scratch import new_folder
from ..streaming import incremental
from .audits import line_pages
from .function_queries import told
from .queries import query, table

BLOCK = 1000


def one_per_file(df: DataFrame, path: str) -> str:
    df.write.option("maxRecordsPerFile", 1).json(path)
    return path


@query("SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'lost' ELSE 'kept' END AS side, 's' || s_nationkey AS system_id, 'e' || s_suppkey AS id FROM supplier WHERE s_nationkey % 4 <> 0")
def manifest_entries(s, d):
    """Entries of confirmed systems, and those that were not found"""
    validation = F.struct(F.when(F.col("s_suppkey") % 3 == 0, "not_found").otherwise("available").alias("status"))
    entry = F.struct(told("e", F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"), validation.alias("validation"))
    docs = table(s, d, "supplier").groupBy("s_nationkey", (F.col("s_suppkey") / BLOCK).cast("long").alias("block")).agg(F.collect_list(entry).alias("entries"))
    status = F.when(F.col("s_nationkey") % 4 == 0, "candidate").otherwise("confirmed")
    path = one_per_file(docs.select(told("s", F.col("s_nationkey")).alias("system_id"), status.alias("discovery_status"), "entries"), new_folder(s, "manifests"))
    kept, lost = readers.read_entries(s, path)
    side = lambda df, name: df.select(F.lit(name).alias("side"), "system_id", "id")
    return side(kept, "kept").unionByName(side(lost, "lost"))


@query("SELECT o_orderkey AS k, o_orderpriority AS p, o_totalprice AS v FROM orders")
def json_lines(s, d):
    """JSON lines read back, each checked"""
    path = new_folder(s, "lines")
    table(s, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p"), F.col("o_totalprice").alias("v")).write.json(path)
    return readers.read_occurrences(s, path, "k long, p string, v double")


@query("SELECT 's' || s_suppkey AS system_id, 'r' || n_regionkey AS category_id, 'n' || n_nationkey AS child_id FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def content_tree(s, d):
    """Systems with their place in a tree of categories"""
    rows = table(s, d, "supplier").join(table(s, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    systems = rows.groupBy("n_regionkey", "n_nationkey", (F.col("s_suppkey") / BLOCK).cast("long").alias("block")).agg(F.collect_list(told("s", F.col("s_suppkey"))).alias("systems"))
    child = F.struct(told("n", F.col("n_nationkey")).alias("id"), F.col("systems").alias("systems"))
    category = F.struct(told("r", F.col("n_regionkey")).alias("id"), F.lit(True).alias("visible"), F.array(child).alias("children"))
    return readers.load_content_tree(s, one_per_file(systems.select(F.array(category).alias("categories")), new_folder(s, "tree")))


@query("SELECT 'customer#' || c_custkey AS key, '名' || c_custkey AS value FROM customer WHERE c_nationkey % 2 = 0")
def dictionary(s, d):
    """Keys in one case with values in Han"""
    value = F.when(F.col("c_nationkey") % 2 == 0, told("名", F.col("c_custkey"))).otherwise("plain")
    pair = F.struct(told("Customer#", F.col("c_custkey")).alias("key"), value.alias("value"))
    docs = table(s, d, "customer").groupBy((F.col("c_custkey") / BLOCK).cast("long").alias("block")).agg(F.to_json(F.map_from_entries(F.collect_list(pair))).alias("value"))
    path = new_folder(s, "dictionary")
    docs.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.load_dictionary(s, path)


@query("SELECT 'customers' AS module, 'c' || c_custkey AS record_id, c_name AS text FROM customer UNION ALL SELECT 'suppliers', 's' || s_suppkey, s_name FROM supplier")
def registered_modules(s, d):
    """Modules with their headers checked; an optional one that is missing is left out"""
    def module(rows, key, name, letter):
        record = F.struct(told(letter, F.col(key)).alias("record_id"), F.col(name).alias("text"))
        docs = rows.groupBy((F.col(key) / BLOCK).cast("long").alias("block")).agg(F.collect_list(record).alias("records"), F.count(F.lit(1)).alias("record_count"))
        return one_per_file(docs.select(F.lit(1).alias("schema_version"), F.lit("s1").alias("season"), "record_count", "records"), new_folder(s, "module"))

    listed = {"customers": (module(table(s, d, "customer"), "c_custkey", "c_name", "c"), True), "suppliers": (module(table(s, d, "supplier"), "s_suppkey", "s_name", "s"), True),
              "absent": (new_folder(s, "absent"), False)}
    return readers.read_modules(s, listed, "record_id:string,text:string", version=1, season="s1").select("module", "record_id", "text")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def checked_header(s, d):
    """Q01: a table whose header is checked before it is used"""
    rows = table(s, d, "events").withColumn("schema_version", F.lit(1)).withColumn("season", F.lit("s1"))
    quality.check_header(rows, version=1, season="s1", declared=rows.count())
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name FROM customer")
def published_customers(s, d):
    """The second version is current once it has passed its gate"""
    path, rows = new_folder(s, "published"), table(s, d, "customer")
    sinks.publish(rows.select("c_custkey", F.upper("c_name").alias("c_name")), path, "1")
    sinks.publish(rows.select("c_custkey", "c_name"), path, "2", [lambda df: quality.assert_none(df.filter("c_custkey is null"), "customers without key")])
    return sinks.current(s, path)


@query("SELECT doc_id AS page_id, lang AS category, sha256(text) AS text_hash, '/en/' || doc_id AS route FROM documents")
def catalog_and_index(s, d):
    """Catalog and search index of whole texts, read back and joined"""
    path = new_folder(s, "catalog")
    doc = F.col("doc_id")
    pages = table(s, d, "documents").select(doc.alias("page_id"), told("/en/", doc).alias("route"), told("Document ", doc).alias("title"), F.col("lang").alias("category"), "text", F.lit("visible").alias("visibility"))
    sinks.write_catalog(pages, path)
    index = s.read.schema("page_id long, title string, text string, category string, visibility string").json(f"{path}/search")
    return s.read.parquet(f"{path}/catalog").join(index.select("page_id", "text"), "page_id").select("page_id", "category", F.sha2("text", 256).alias("text_hash"), "route")


@query("""SELECT 'nation=' || c_nationkey AS folder, sum(length('{"k":' || c_custkey || '}') + 1)::BIGINT AS bytes FROM customer GROUP BY 1""")
def exported_customers(s, d):
    """Rows in a folder for each value, with the size of what was written"""
    files = sinks.export_partitioned(table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation")), "nation", new_folder(s, "export"))
    return files.groupBy(F.split_part("file", F.lit("/"), F.lit(1)).alias("folder")).agg(F.sum("bytes").alias("bytes"))


@query("""SELECT l_orderkey::VARCHAR AS entity_id, 'modifier:' || l_partkey AS key, 'lines@1' AS parser FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE n >= 3
UNION ALL SELECT l_orderkey::VARCHAR, 'rows', NULL FROM lineitem GROUP BY 1 HAVING count(*) < 3""")
def extractor_records(s, d):
    """An extractor's records of the pages that fit its rules, and the checks that the others fail"""
    def describe(rows):
        shape = extract.section_descriptor(rows)
        return shape.select("page_id", F.lit("rows").alias("check"), F.when(F.col("rows") >= 3, "several").otherwise("few").alias("value"))

    family = records.Extractor("lines", "1", describe, {"rows": "several"}, lambda rows: records.section_affixes(rows, "lines"))
    found, wrong = family.run(extract.section_rows(line_pages(s, d)))
    failed = wrong.select(F.col("page_id").cast("string").alias("entity_id"), F.col("check").alias("key"), F.lit(None).cast("string").alias("parser"))
    return found.select("entity_id", "key", "parser").unionByName(failed)


@query("SELECT c_custkey AS page_id, 0 AS batch, sha256(c_name) AS hash FROM customer UNION ALL SELECT c_custkey, 1, sha256(c_name || '!') FROM customer WHERE c_nationkey % 2 = 0")
def incremental_customers(s, d):
    """A second run writes on what is new or changed, and nothing that is invalid"""
    src, state, mark = new_folder(s, "arriving"), new_folder(s, "state"), new_folder(s, "mark")
    rows = table(s, d, "customer")
    schema = "page_id long, content binary, http_status int, content_length long, html_sha256 string"
    changed = F.when(F.col("c_nationkey") % 2 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))
    for content, status in ((F.col("c_name"), F.lit(200)), (changed, F.lit(200)), (F.concat("c_name", F.lit("?")), F.lit(500))):
        page = rows.select(F.col("c_custkey").alias("page_id"), content.cast("binary").alias("content"), status.alias("http_status"), F.octet_length(content).cast("long").alias("content_length"), F.sha2(content, 256).alias("html_sha256"))
        page.write.mode("append").parquet(src)
        incremental.incremental_pages(s.readStream.schema(schema).parquet(src), state, mark).awaitTermination()
    return s.read.parquet(state).select("page_id", "batch", "hash")


@query("""SELECT '/en/p' || l_partkey AS route, CASE WHEN bool_or(l_returnflag = 'R') THEN 'again' ELSE arg_max(l_returnflag, l_orderkey * 10 + l_linenumber) END AS reason FROM lineitem GROUP BY l_partkey""")
def rejected_routes(s, d):
    """Rejected routes, the last reason counts, over two batches"""
    src, state, mark = new_folder(s, "rejected"), new_folder(s, "state"), new_folder(s, "mark")
    rows = table(s, d, "lineitem").select(told("/en/p", F.col("l_partkey")).alias("route"), F.col("l_returnflag").alias("reason"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    for part in (rows, rows.filter("reason = 'R'").withColumn("reason", F.lit("again"))):
        part.write.mode("append").parquet(src)
        incremental.rejected_state(s.readStream.schema("route string, reason string, seq long").parquet(src), state, mark).awaitTermination()
    return incremental.rejected_routes(s, state).drop("bucket")
