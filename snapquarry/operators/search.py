"""Search over pages and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import snippet


def apply_visibility(pages: DataFrame, hidden_systems: list[str]) -> DataFrame:
    """pages of superseded systems, and index pages without an entity, are hidden."""
    old = F.col("system_id").isin(*hidden_systems) | (F.col("is_index") & F.col("entity_id").isNull())
    return pages.withColumn("visibility", F.when(old, "hidden").otherwise(F.col("visibility")))


def visible_subcategories(tree: DataFrame) -> DataFrame:
    """visible children of each category. tree(category_id, child_id, visible)."""
    return tree.filter("visible").groupBy("category_id").agg(F.array_sort(F.collect_set("child_id")).alias("children"))


def search_pages(pages: DataFrame, query: str, category: str | None = None) -> DataFrame:
    """Visible pages whose title or text holds the query in any case: a hit in the title first, then by title."""
    low = query.lower()
    title, text = F.locate(low, F.lower("title")) > 0, F.locate(low, F.lower("text")) > 0
    out = pages.filter((title | text) & (F.coalesce("visibility", F.lit("visible")) != "hidden"))
    if category is not None:
        out = out.filter(F.col("category") == category)
    return out.withColumn("rank", F.when(title, 0).otherwise(1)).orderBy("rank", F.collate("title", "UNICODE_CI"), "page_id")


def search_records(records: DataFrame, query: str) -> DataFrame:
    """Records whose search text holds the query: exact texts first, then in stored order."""
    low = query.lower()
    return records.filter(F.locate(low, F.lower(F.coalesce("search_text", "text"))) > 0).withColumn("exact", F.lower("text") == low).orderBy(F.desc("exact"), "record_id")


def group_hits(hits: DataFrame, n: int = 8) -> DataFrame:
    """Per entity the first n records and how many more there are."""
    w = Window.partitionBy("entity_id").orderBy("record_id")
    first = hits.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).groupBy("entity_id").agg(F.array_sort(F.collect_list("record_id")).alias("shown"))
    total = hits.groupBy("entity_id").agg(F.count(F.lit(1)).alias("total"))
    return total.join(first, "entity_id").withColumn("more", F.col("total") - F.size("shown"))


def suppress(page_hits: DataFrame, record_hits: DataFrame) -> DataFrame:
    """Page hits without those whose entity or route has a record hit."""
    plain = lambda c: F.regexp_replace(F.coalesce(F.try_url_decode(c), c), r"[?#].*$|/+$", "")
    out = page_hits.join(record_hits.select("entity_id").distinct(), "entity_id", "left_anti")
    routes = record_hits.select(plain(F.col("route")).alias("_r")).distinct()
    return out.withColumn("_r", plain(F.col("route"))).join(routes, "_r", "left_anti").drop("_r")


def collapse_entities(hits: DataFrame, pages: DataFrame) -> DataFrame:
    """One hit per entity (pages without one stay), with the sources of all its pages."""
    key = F.coalesce(F.concat(F.lit("e:"), "entity_id"), F.concat(F.lit("p:"), F.col("page_id").cast("string")))
    w = Window.partitionBy("_k").orderBy("rank", "title", "page_id")
    first = hits.withColumn("_k", key).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    sources = pages.withColumn("_k", key).groupBy("_k").agg(F.array_sort(F.collect_set("system_id")).alias("sources"))
    return first.join(sources, "_k", "left").drop("_k")


def result_groups(hits: DataFrame) -> DataFrame:
    """Hits by subcategory, else category, else system."""
    return hits.groupBy(F.coalesce("subcategory", "category", "system_id").alias("group")).agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("best"))


def with_snippets(hits: DataFrame, query: str) -> DataFrame:
    """Hits with the text around the first place."""
    return hits.withColumn("snippet", snippet(F.col("text"), query))


def search_text() -> Column:
    """Summary of the entity, else the fresh text of skills, else the cached text."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(blank(F.col("clean_summary")), F.when(F.col("entity_type") == "skill", blank(F.col("fresh_text"))), F.col("cached_text"))


def filter_tree(entries: DataFrame, query: str) -> DataFrame:
    """Groups of entries whose name or slug holds the query, with counts."""
    low = query.lower()
    return entries.filter((F.locate(low, F.lower("name")) > 0) | (F.locate(low, F.lower("slug")) > 0)).groupBy("system_id").agg(F.count(F.lit(1)).alias("n"))


def build_search_pages(pages: DataFrame, entities: DataFrame, systems: DataFrame) -> DataFrame:
    """One row for each canonical page, with its entity, category and text. pages(page_id, route, system_id, title,
    cached_text), the first of each route by page_id."""
    first = pages.withColumn("_n", F.row_number().over(Window.partitionBy("route").orderBy("page_id"))).filter("_n = 1").drop("_n")
    j = first.join(entities.select("route", "entity_id", F.col("title").alias("entity_title"), F.col("category").alias("entity_category"), "entity_type", "clean_summary"), "route", "left")
    j = j.join(systems.select("system_id", F.col("category").alias("system_category")), "system_id", "left").withColumn("fresh_text", F.lit(None).cast("string"))
    return j.select("page_id", "route", "system_id", "entity_id", F.coalesce("entity_title", "title").alias("title"), F.coalesce("entity_category", "system_category").alias("category"),
        search_text().alias("text"), F.lit("visible").alias("visibility"))


def refresh_ownership(pages: DataFrame, entities: DataFrame, kind: str, system: str) -> DataFrame:
    """Pages of entities of a kind go over to its main system; of several rows with a route the first stays."""
    own = entities.filter(F.col("entity_type") == kind).select("route", F.lit(True).alias("_o")).distinct()
    moved = pages.join(own, "route", "left").withColumn("system_id", F.when(F.col("_o"), system).otherwise(F.col("system_id"))).drop("_o")
    return moved.withColumn("_n", F.row_number().over(Window.partitionBy("route").orderBy("page_id"))).filter("_n = 1").drop("_n")
