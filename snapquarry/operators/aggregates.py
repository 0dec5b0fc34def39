"""Reports and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_lines, ratio
from ..functions.urls import host


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count by value, null shown as a value."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("null")).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def source_distribution(df: DataFrame, array: str) -> DataFrame:
    """Count by element of an array column."""
    return df.select(F.explode(array).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def _alike(tooltips: DataFrame) -> DataFrame:
    return tooltips.withColumns({c: F.nullif(clean_lines(F.col(c)), F.lit("")) for c in ("tooltip_title", "tooltip_text")})


def definitions(tooltips: DataFrame) -> DataFrame:
    """Tooltips with a text as definitions: title and text, count, ids in order, entities and types in first-seen
    order. White space is made alike line by line first; titles compare null-safe."""
    rows = _alike(tooltips).filter("tooltip_text is not null")
    g = rows.groupBy("tooltip_title", "tooltip_text").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("occurrence_id", "source_entity_id", "source_type"))).alias("o"))
    return g.select("tooltip_title", "tooltip_text", "n", F.col("o.occurrence_id").alias("occurrence_ids"), F.array_distinct("o.source_entity_id").alias("entities"), F.array_distinct("o.source_type").alias("types"))


def conflicts(tooltips: DataFrame) -> DataFrame:
    """conflict_type, key, severity, occurrence_ids (in order): same title with several texts, same text with several
    titles (null counts as one), duplicate id, missing text, hash mismatch (its key is the file). White space is made
    alike line by line first.

    Texts are cleaned once and go by their hash; one grouping of (kind, key) tells the first three kinds apart, and a text is looked up again
    for the few groups that are told."""
    rows = _alike(tooltips).select("tooltip_title", "tooltip_text", "occurrence_id", F.col("source.html_file").alias("file"), F.col("source.hash_match").alias("match"), F.sha2("tooltip_text", 256).alias("h"))
    kind = lambda name, severity, when, key, value, text=None: F.when(when, F.struct(F.lit(name).alias("conflict_type"), F.lit(severity).alias("severity"), key.cast("string").alias("key"),
        value.cast("string").alias("value"), (F.lit(None).cast("string") if text is None else text).alias("text")))
    there, own = F.col("h").isNotNull(), F.col("occurrence_id")
    every = F.array_compact(F.array(
        kind("same_title_different_text", "review", there & F.col("tooltip_title").isNotNull(), F.col("tooltip_title"), F.col("h")),
        kind("same_text_different_title", "review", there, F.col("h"), F.coalesce(F.concat(F.lit("v"), "tooltip_title"), F.lit("n")), F.col("tooltip_text")), kind("duplicate_occurrence_id", "error", own.isNotNull(), own, F.lit("")),
        kind("missing_tooltip_text", "review", ~there, own, F.lit("")), kind("source_hash_mismatch", "review", ~F.col("match"), F.col("file"), F.lit(""))))
    each = rows.select("occurrence_id", F.explode(every).alias("c")).select("occurrence_id", "c.*")
    alone = F.col("conflict_type").isin("missing_tooltip_text", "source_hash_mismatch")
    g = each.filter(~alone).groupBy("conflict_type", "severity", "key").agg(F.array_sort(F.collect_list("occurrence_id")).alias("occurrence_ids"), F.min("value").alias("a"), F.max("value").alias("b"), F.first("text").alias("text"))
    told = g.filter((F.col("a") != F.col("b")) | ((F.col("conflict_type") == "duplicate_occurrence_id") & (F.size("occurrence_ids") > 1)))
    out = told.select("conflict_type", F.coalesce("text", "key").alias("key"), "severity", "occurrence_ids")
    return out.unionByName(each.filter(alone).select("conflict_type", "key", "severity", F.array("occurrence_id").alias("occurrence_ids")))


def first_n(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """Rows with the n smallest values of each key; Spark keeps n of each before it deals them by key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(value))).filter(F.col("_n") <= n)


def link_targets(links: DataFrame, n: int = 5) -> DataFrame:
    """Target, occurrences, pages, and the first n pages. Links are summed per page first, so a target that every
    page links to is spread before it is gathered."""
    page = links.groupBy("target", "page_id").agg(F.count(F.lit(1)).alias("k"))
    first = first_n(page, ["target"], "page_id", n).groupBy("target").agg(F.array_sort(F.collect_list("page_id")).alias("examples"))
    total = page.groupBy("target").agg(F.sum("k").alias("occurrences"), F.count(F.lit(1)).alias("pages"))
    return total.join(first, "target")


def assets(refs: DataFrame, n: int = 20) -> DataFrame:
    """Url, type, reference count, first n different pages that refer to it."""
    total = refs.groupBy("url").agg(F.count(F.lit(1)).alias("ref_count"), F.min("type").alias("type"))
    some = first_n(refs.select("url", "page_id").distinct(), ["url"], "page_id", n)
    return total.join(some.groupBy("url").agg(F.array_sort(F.collect_list("page_id")).alias("refs")), "url")


def asset_summary(assets: DataFrame) -> DataFrame:
    """Kind, value, n: assets by type and by host, and how many references are to an asset that has one already."""
    each = F.array(F.struct(F.lit("type").alias("kind"), F.col("type").alias("value")), F.struct(F.lit("host").alias("kind"), host(F.col("url")).alias("value")))
    parts = assets.select(F.explode(each).alias("r")).groupBy("r.kind", "r.value").agg(F.count(F.lit(1)).alias("n"))
    more = assets.agg(F.coalesce(F.sum(F.col("ref_count") - 1), F.lit(0)).alias("n"))
    return parts.unionByName(more.select(F.lit("duplicates").alias("kind"), F.lit(None).cast("string").alias("value"), "n"))


def duplicate_groups(df: DataFrame, keys: list[str], value: str, n: int = 5) -> DataFrame:
    """Keys with more than one row: row count and smallest examples. Both are cut before they are dealt by key, so a key that very
    many rows have is no task's burden."""
    each = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = first_n(df.select(*keys, value), keys, value, n).groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("examples"))
    return each.join(first, keys)


def same_text_groups(df: DataFrame, text: str, key: str) -> DataFrame:
    """Texts that several keys share: hash of the text, keys, rows."""
    g = df.groupBy(F.sha2(text, 256).alias("text_hash")).agg(F.count_distinct(key).alias("keys"), F.count(F.lit(1)).alias("n"))
    return g.filter("keys > 1")


def completeness(entries: DataFrame, pages: DataFrame, group: str, key: str) -> DataFrame:
    """Per group and in total (group null): entries, present, missing, empty, valid pages and their share.
    pages(key, length, status)."""
    j = entries.select(group, key).join(pages.select(key, "length", "status", F.lit(True).alias("there")), key, "left")
    k = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    out = j.groupingSets([[F.col(group)], []], F.col(group)).agg(
        F.count(F.lit(1)).alias("entries"), k(F.col("there")).alias("present"), k(F.col("there").isNull()).alias("missing"),
        k(F.col("length") == 0).alias("empty"), k((F.col("length") > 0) & (F.col("status") == 200)).alias("valid"))
    return out.withColumn("coverage", ratio(F.col("valid"), F.col("entries")))


def template_summary(pages: DataFrame, template: str, key: str, n: int = 5) -> DataFrame:
    """Members and first n of each template group, larger ones first."""
    some = pages.select(template, key).withColumn("_n", F.row_number().over(Window.partitionBy(template).orderBy(key))).filter(F.col("_n") <= n)
    some = some.groupBy(template).agg(F.array_sort(F.collect_list(key)).alias("representatives"))
    return pages.groupBy(template).agg(F.count(F.lit(1)).alias("members")).join(some, template).orderBy(F.desc("members"), template)


def job_report(results: DataFrame, group: str, status: str, size: str) -> DataFrame:
    """Per group and in total: items, failures, bytes."""
    return results.rollup(group).agg(F.count(F.lit(1)).alias("items"), F.sum(F.when(F.col(status) != "available", 1).otherwise(0)).alias("failed"), F.sum(size).alias("bytes"))


def extract_report(pages: DataFrame, tooltips: DataFrame) -> DataFrame:
    """Pages, pages with rows, rows, rows without title and without text."""
    per = tooltips.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("tooltip_title").isNull()).alias("t"), F.count_if(F.col("tooltip_text").isNull()).alias("x"))
    j = pages.select("page_id").join(per, "page_id", "left")
    return j.agg(F.count(F.lit(1)).alias("pages"), F.count("n").alias("pages_with_rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("missing_title"), F.coalesce(F.sum("x"), F.lit(0)).alias("missing_text"))


def extract_methods(tooltips: DataFrame) -> DataFrame:
    """Tooltips by the way they were read."""
    return tooltips.groupBy("method").agg(F.count(F.lit(1)).alias("n"))


def ordered_summary(rows: DataFrame, keys: list[str], order: str, text: str, separator: str = " ") -> DataFrame:
    """The different texts of a group in order of first appearance, joined."""
    first = rows.filter(F.col(text).isNotNull()).groupBy(*keys, text).agg(F.min(order).alias("_o"))
    listed = F.array_sort(F.collect_list(F.struct("_o", text)))
    return first.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x[text]), separator).alias("summary"))


def count_profile(df: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """Least, greatest and median value in a group, and whose they are (ties by smallest key)."""
    return df.groupBy(group).agg(F.min(value).alias("least"), F.max(value).alias("greatest"), F.median(value).alias("median"), F.min_by(key, F.struct(value, key)).alias("least_key"),
        F.max_by(key, F.struct(F.col(value), -F.col(key))).alias("greatest_key"))


def feature_report(features: DataFrame, key: str, names: list[str], n: int = 10) -> DataFrame:
    """For each flag the pages that have it and the first n of them."""
    stacked = features.select(key, F.explode(F.filter(F.array(*[F.when(F.col(c), F.lit(c)) for c in names]), lambda x: x.isNotNull())).alias("feature"))
    some = stacked.withColumn("_n", F.row_number().over(Window.partitionBy("feature").orderBy(key))).filter(F.col("_n") <= n)
    return stacked.groupBy("feature").agg(F.count(F.lit(1)).alias("pages")).join(some.groupBy("feature").agg(F.array_sort(F.collect_list(key)).alias("examples")), "feature")


def shell_report(pages: DataFrame) -> DataFrame:
    """Shell, pages, hosts, dominant (most pages, then the greatest signature) of pages(url, shell)."""
    each = pages.groupBy("shell").agg(F.count(F.lit(1)).alias("pages"), F.count_distinct(host(F.col("url"))).alias("hosts"))
    top = each.agg(F.max(F.struct("pages", "shell")).alias("top"))
    return each.withColumn("dominant", F.struct("pages", "shell") == top.scalar())


def keyword_counts(df: DataFrame, words: str, categories: dict[str, list[str]]) -> DataFrame:
    """Rows per category; a row counts in each category one of whose words it holds."""
    hits = [F.when(F.arrays_overlap(F.col(words), F.array(*[F.lit(w) for w in v])), F.lit(k)) for k, v in categories.items()]
    return df.select(F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def attribute_counts(df: DataFrame, attributes: str, names: list[str]) -> DataFrame:
    """Rows that have each attribute, and rows with several."""
    return df.agg(*[F.count_if(F.array_contains(attributes, a)).alias(a) for a in names], F.count_if(F.size(attributes) > 1).alias("multi"))


def discovery_confidence(report: DataFrame) -> DataFrame:
    """Confidence of a directory from container, unique, occurrences, duplicates and displayed count."""
    bonus = F.when(F.col("n_unique") >= 10, 0.20).when(F.col("n_unique") >= 2, 0.10).otherwise(0.0)
    shown = F.when(F.col("displayed").isNull(), 0.0).when(F.col("displayed") == F.col("n_unique"), 0.09).otherwise(-0.05)
    double = F.least(F.col("duplicates") / F.greatest(F.col("occurrences"), F.lit(1)), F.lit(1.0))
    score = F.round(F.greatest(F.lit(0.0), F.least(F.lit(0.99), 0.70 + bonus + shown - 0.20 * double)), 2)
    return report.withColumn("confidence", F.when(~F.col("has_container") | (F.col("n_unique") == 0), 0.0).otherwise(score))


def module_report(records: DataFrame) -> DataFrame:
    """Records, entities and record-level locators per module and record type, with subtotals."""
    return records.rollup("module", "record_type").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("entity_id").alias("entities"), F.count_if(F.col("locator_level") == "record").alias("at_record_level"))


def entity_report(entities: DataFrame) -> DataFrame:
    """Per kind: entities, those with a summary, those without, first sample."""
    filled = F.coalesce(F.col("clean_summary"), F.lit("")) != ""
    return entities.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(filled).alias("enriched"), F.count_if(~filled).alias("missing"), F.min("entity_id").alias("sample"))
