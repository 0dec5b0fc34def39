"""Gates and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import asset_type, clean, ratio
from ..functions.urls import canonical_page, host, is_static, is_tracking, path, resolve_url
from .aggregates import count_profile, duplicate_groups, same_text_groups, template_summary
from .extract import call_urls, css_refs


def check_header(df: DataFrame, *, version: int, season: str, declared: int) -> None:
    """Q01: version, season and declared count of a table; one pass, an error names what is wrong."""
    got = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("schema_version").eqNullSafe(F.lit(version))).alias("v"), F.count_if(~F.col("season").eqNullSafe(F.lit(season))).alias("s")).first()
    wrong = [f"{what}: {k}" for what, k in (("rows of another version", got.v), ("rows of another season", got.s), (f"rows instead of {declared}", got.n if got.n != declared or not declared else 0)) if k]
    if wrong or not got.n:
        raise ValueError("; ".join(wrong) or "no rows")


def coverage_gate(expected: DataFrame, produced: DataFrame, key: str) -> DataFrame:
    """Q04: ids that are missing or extra; the gate is passed if there are none."""
    a, b = expected.select(key).distinct(), produced.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("extra")))


def assert_none(df: DataFrame, what: str, n: int = 5) -> None:
    """Fails with the first rows of a report that should be empty."""
    rows = df.limit(n).collect()
    if rows:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def unique_gate(df: DataFrame, key: str, owner: str) -> DataFrame:
    """Q05: keys that occur twice, and whose they are."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(owner)).alias("owners")).filter("n > 1")


def route_audit(links: DataFrame, routes: DataFrame) -> DataFrame:
    """Q06: links(page_id, route) with result, and suggested, the route that was meant: existing; encoding_mismatch (a known route
    in other encoding); wrong_directory, if a route of three parts or more ends in a page that is named after the part before it
    (/en/Sword/Sword:Blade); wrong_namespace, if the last part alone is known below the first one; else missing."""
    plain = lambda c: F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    known = routes.select("route").distinct()
    alike = known.groupBy(plain(F.col("route")).alias("_p")).agg(F.min("route").alias("_alike"))
    parts = F.filter(F.split("route", "/"), lambda s: s != "")
    flat = F.when(F.size(parts) > 2, F.concat(F.lit("/"), F.get(parts, F.lit(0)), F.lit("/"), F.element_at(parts, -1)))
    own = F.startswith(plain(F.element_at(parts, -1)), F.concat(plain(F.get(parts, F.size(parts) - 2)), F.lit(":")))
    rows = links.withColumn("_p", plain(F.col("route"))).withColumn("_flat", flat).withColumn("_own", F.col("_flat").isNotNull() & own)
    j = rows.join(known.withColumn("_k", F.lit(True)), "route", "left").join(alike, "_p", "left").join(known.select(F.col("route").alias("_flat"), F.lit(True).alias("_n")), "_flat", "left")
    result = F.when(F.col("_k"), "existing").when(F.col("_alike").isNotNull(), "encoding_mismatch").when(F.col("_own"), "wrong_directory").when(F.col("_n"), "wrong_namespace").otherwise("missing")
    suggested = F.when(result == "encoding_mismatch", F.col("_alike")).when(result.isin("wrong_directory", "wrong_namespace"), F.col("_flat"))
    return j.withColumn("result", result).withColumn("suggested", suggested).drop("_k", "_alike", "_n", "_p", "_flat", "_own")


def external_audit(links: DataFrame, catalog: DataFrame, hosts: list[str], prefix: str = "/") -> DataFrame:
    """Q07: pages of the own site (its hosts, below the prefix, no static files) that links(href) name by absolute URL: route,
    in_catalog, links."""
    href = F.trim("href")
    own = F.lower(href).rlike("^https?://") & host(href).isin(*hosts) & F.startswith(path(href), F.lit(prefix)) & ~is_static(href)
    j = links.filter(own).select(canonical_page(href).alias("route")).filter("route is not null").join(catalog.select("route", F.lit(True).alias("_c")).distinct(), "route", "left")
    return j.groupBy("route").agg(F.coalesce(F.bool_or("_c"), F.lit(False)).alias("in_catalog"), F.count(F.lit(1)).alias("links"))


def dependency_audit(calls: DataFrame, names: list[str]) -> DataFrame:
    """Q08: pages per kind of runtime call and whether the pages can do without a server."""
    out = calls.agg(F.count(F.lit(1)).alias("pages"), *[F.count_if(F.col(c) > 0).alias(c) for c in names])
    return out.withColumn("verdict", F.when(reduce(lambda a, b: a | b, [F.col(c) > 0 for c in names]), "needs_runtime").otherwise("static"))


def readiness(pages: DataFrame, assets: DataFrame, sheets: DataFrame, scripts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q08: (one row a system: counts, verdict, blocking and remaining reasons; dependency classes by system and host).
    pages(system_id, page_id, url, html), assets(system_id, url, type, present, has_meta), sheets and scripts(system_id, url, text) of what is present.

    A system isn't ready while assets or their metadata are missing, while style sheets or style elements refer to what isn't there, or
    while scripts call endpoints that are no tracking; it is ready_with_minor_gaps while sheets or pages still refer to anything by absolute URL;
    else it is ready."""
    own = assets.groupBy("system_id").agg(F.count(F.lit(1)).alias("assets"), F.count_if(~F.coalesce("present", F.lit(False))).alias("missing_files"), F.count_if(~F.coalesce("has_meta", F.lit(False))).alias("missing_meta"))
    inline = pages.select("system_id", "url", F.array_join(F.regexp_extract_all("html", F.lit(r"(?is)<style[^>]*>(.*?)</style>"), F.lit(1)), "\n").alias("css")).filter("css <> ''")
    css = sheets.select("system_id", "url", F.col("text").alias("css")).unionByName(inline)
    at = F.struct("system_id", "url").alias("url")
    refs = css_refs(css.select(at, "css")).select("url.system_id", F.col("url.url").alias("base"), "kind", "ref").withColumn("target", resolve_url(F.col("ref"), F.col("base"))).filter("target is not null")
    there = assets.filter("present").select("system_id", F.col("url").alias("target"), F.lit(True).alias("_t")).distinct()
    second = refs.groupBy("system_id", "target").agg(F.count(F.lit(1)).alias("k"), F.max(F.lower("ref").rlike("^(https?:)?//")).alias("remote")).join(there, ["system_id", "target"], "left")
    second = second.groupBy("system_id").agg(F.sum("k").alias("secondary_refs"), F.count_if(F.col("_t").isNull()).alias("missing_secondary"), F.count_if("remote").alias("remote_css"))
    told = pages.select(F.struct("system_id", "page_id").alias("page_id"), "url", "html").unionByName(scripts.select(F.struct("system_id",
        F.col("url").cast(pages.schema["page_id"].dataType).alias("page_id")).alias("page_id"), "url", F.concat(F.lit("<script>"), "text").alias("html")))
    calls = call_urls(told).select("page_id.system_id", "target", "kind").distinct()
    run = calls.groupBy("system_id").agg(F.count_if(F.col("kind") == "endpoint").alias("endpoints"), F.count_if(F.col("kind") == "tracking").alias("tracking"))
    markup = r"""(?i)<(?:link|script|img|source|video|audio)\s[^>]*?(?:href|src)\s*=\s*["'](?:https?:)?//"""
    seen = pages.groupBy("system_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.coalesce(F.rlike("html", F.lit(markup)), F.lit(False))).alias("remote_pages"))
    out = seen
    for more in (own, second, run):
        out = out.join(more, "system_id", "full_outer")
    counts = ["pages", "remote_pages", "assets", "missing_files", "missing_meta", "secondary_refs", "missing_secondary", "remote_css", "endpoints", "tracking"]
    out = out.fillna(0, counts)
    reasons = lambda *names: F.array_compact(F.array(*[F.when(F.col(n) > 0, F.concat(F.col(n).cast("string"), F.lit(f" {n}"))) for n in names]))
    out = out.withColumn("blocking", reasons("missing_files", "missing_meta", "missing_secondary", "endpoints")).withColumn("remaining", reasons("remote_css", "remote_pages"))
    verdict = F.when(F.size("blocking") > 0, "not_ready").when(F.size("remaining") > 0, "ready_with_minor_gaps").otherwise("ready")
    category = F.when(is_tracking(F.col("url")), "tracking/ads").when(F.col("type").isin("script", "javascript"), "required_for_interaction").otherwise("required_for_rendering")
    classes = assets.select("system_id", category.alias("category"), host(F.col("url")).alias("host")).unionByName(calls.filter("kind = 'endpoint'").select("system_id",
        F.lit("required_for_interaction").alias("category"), host(F.col("target")).alias("host")))
    return out.select("system_id", *counts, verdict.alias("verdict"), "blocking", "remaining"), classes.groupBy("system_id", "category", "host").agg(F.count(F.lit(1)).alias("n"))


def manifest_audit(entries: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Q09: how many rows fail each check, the failed checks, and the decision."""
    counts = [F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()]
    failed = F.filter(F.array(*[F.when(F.col(n) > 0, F.lit(n)) for n in checks]), lambda x: x.isNotNull())
    return entries.agg(*counts).withColumn("failed", failed).withColumn("decision", F.when(F.size("failed") == 0, "accept").otherwise("reject"))


def regression(fresh: DataFrame, reference: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Q10: per field the keys whose values differ, and the keys of one side only, with counts."""
    a, b = fresh.select(key, F.struct(*fields).alias("a")), reference.select(key, F.struct(*fields).alias("b"))
    differ = [F.when(F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]
    what = F.array(F.when(F.col("b").isNull(), "extra"), F.when(F.col("a").isNull(), "missing"), *differ)
    return a.join(b, key, "full_outer").select(F.explode(F.filter(what, lambda x: x.isNotNull())).alias("difference")).groupBy("difference").agg(F.count(F.lit(1)).alias("n"))


def table_hash(df: DataFrame) -> DataFrame:
    """Q10: a hash of a table's rows in any order, and their number; equal for equal tables."""
    row = F.conv(F.substring(F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256), 1, 12), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(row).cast("string").alias("hash"))


def route_conflicts(pages: DataFrame, route: str, content: str) -> DataFrame:
    """Q11: routes under which several contents stand."""
    return pages.groupBy(route).agg(F.count_distinct(F.sha2(content, 256)).alias("contents"), F.count(F.lit(1)).alias("pages")).filter("contents > 1")


def samples(df: DataFrame, strata: list[str], key: str, k: int = 5) -> DataFrame:
    """Q12: the k rows of each stratum with the smallest hash of their key (ties by the key): the same on every run and however the
    rows are dealt, and as samples of parts can be put together and cut again, no stratum is gathered."""
    w = Window.partitionBy(*strata).orderBy(F.xxhash64(F.col(key).cast("string")), key)
    return df.withColumn("sample_no", F.row_number().over(w)).filter(F.col("sample_no") <= k)


def family_audit(records: DataFrame, pages: DataFrame, k: int = 5) -> dict[str, DataFrame]:
    """Q12: the audit of one family of pages. records(page_id, record_id, record_type, key, text, region, selected),
    pages(page_id, template, historical_cards, related_cards).

    completeness: pages, those with records, share; templates, profile: pages and records a page by template; duplicates: ids that occur
    twice; shared_texts; identity: per record type the records, those with a key of their own (not row:<n>), different keys within their pages, and
    the share; history: cards that don't count, records that stand in them and how many of these were selected (none, if the
    rules hold); samples: k pages of each template by hash, with their records. Only selected records are counted, but
    for history."""
    taken = records.filter("selected")
    per = taken.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    all_pages = pages.join(per, "page_id", "left").fillna(0, ["n"])
    keyed = F.coalesce(F.col("key") != "", F.lit(False)) & ~F.coalesce(F.startswith("key", F.lit("row:")), F.lit(False))
    page = taken.groupBy("record_type", "page_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(keyed).alias("keyed"), F.count_distinct(F.when(keyed, F.col("key"))).alias("different"))
    identity = page.groupBy("record_type").agg(F.sum("n").alias("records"), F.sum("keyed").alias("keyed"), F.sum("different").alias("different"))
    old = records.filter(F.col("region").isin("historical", "related")).agg(F.count(F.lit(1)).alias("records"), F.count_if("selected").alias("selected"))
    cards = pages.agg(F.coalesce(F.sum("historical_cards"), F.lit(0)).alias("historical_cards"), F.coalesce(F.sum("related_cards"), F.lit(0)).alias("related_cards"))
    return {
        "completeness": all_pages.agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("n") > 0).alias("with_records"), ratio(F.count_if(F.col("n") > 0), F.count(F.lit(1))).alias("coverage")),
        "templates": template_summary(pages, "template", "page_id"), "profile": count_profile(all_pages, "template", "page_id", "n"),
        "duplicates": duplicate_groups(taken, ["record_id"], "page_id"), "shared_texts": same_text_groups(taken, "text", "record_id"),
        "identity": identity.withColumn("coverage", ratio(F.col("different"), F.col("records"))), "history": cards.join(old),
        "samples": samples(all_pages, ["template"], "page_id", k).select("template", "page_id", "sample_no", F.col("n").alias("records")),
    }


def cleanup_report(pages: DataFrame, before: str, after: str, sample: str) -> DataFrame:
    """Q13: rows by visibility before and after a rule, and the first of each."""
    return pages.groupBy(before, after).agg(F.count(F.lit(1)).alias("n"), F.min(sample).alias("sample"))


def document_issues(docs: DataFrame, key: str, required: list[str], effects: DataFrame) -> DataFrame:
    """Q14: key, issue: required fields that are absent, effects that are empty or stand twice in a document.
    effects(key, text)."""
    absent = F.explode(F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]), lambda x: x.isNotNull()))
    out = docs.select(key, absent.alias("issue"))
    out = out.unionByName(effects.filter(F.coalesce(clean(F.col("text")), F.lit("")) == "").select(key, F.lit("empty effect").alias("issue")))
    return out.unionByName(effects.filter("text <> ''").groupBy(key, "text").count().filter("count > 1").select(key, F.lit("duplicate effect").alias("issue")))


def snapshot_health(pages: DataFrame) -> DataFrame:
    """pages(content binary, http_status, content_length, html_sha256) with health: empty_body, length_mismatch,
    hash_mismatch, bad_status or valid."""
    size = F.octet_length("content")
    health = (F.when(F.coalesce(size, F.lit(0)) == 0, "empty_body").when(F.col("content_length").isNotNull() & (size != F.col("content_length")), "length_mismatch")
              .when(F.col("html_sha256").isNotNull() & (F.sha2("content", 256) != F.col("html_sha256")), "hash_mismatch").when(~F.col("http_status").eqNullSafe(F.lit(200)), "bad_status").otherwise("valid"))
    return pages.withColumn("health", health)


def type_warning(assets: DataFrame) -> DataFrame:
    """assets(url, content_type) whose content type doesn't fit the type that their URL tells."""
    kind, got = asset_type(F.col("url")), F.lower("content_type")
    fits = (F.when(kind == "style", got.contains("css")).when(kind == "script", got.contains("javascript")).when(kind == "image", got.startswith("image/"))
            .when(kind == "font", got.contains("font") | got.contains("octet-stream")).when(kind == "data", got.contains("json") | got.contains("xml")).otherwise(True))
    return assets.withColumn("type", kind).filter(~F.coalesce(fits, F.lit(False)))


def template_group(features: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """the first rule that a page meets, else `other`."""
    out = F.when(rules[0][1], rules[0][0])
    for name, condition in rules[1:]:
        out = out.when(condition, name)
    return features.withColumn("template", out.otherwise("other"))


def skill_templates() -> list[tuple[str, Column]]:
    """kinds of skill pages, over modifiers, active_panes, has_cache_pane."""
    return [("skill_modifier_growth", F.col("modifiers") > 0), ("skill_tabbed_cache_history", (F.col("active_panes") > 0) & F.col("has_cache_pane")),
            ("skill_tabbed_variants", F.col("active_panes") > 0), ("skill_standalone_card", F.lit(True))]


def legendary_templates() -> list[tuple[str, Column]]:
    """kinds of pages of legendary items, over current_cards, drop_source_cards, historical_cards."""
    return [("multi_variant_current_and_history", F.col("current_cards") > 1), ("current_history_without_drop_source", F.col("drop_source_cards") == 0),
            ("current_only_with_corrosion", F.col("historical_cards") == 0), ("standard_current_history_corrosion_drop", F.lit(True))]


def talent_templates(root: list[str], nested: list[str]) -> list[tuple[str, Column]]:
    """kinds of talent pages, by lists of slugs."""
    return [("talent_root_container", F.col("slug").isin(*root)), ("talent_active_pane_with_nested_modifiers", F.col("slug").isin(*nested)), ("talent_active_pane", F.lit(True))]
