"""Directory pages to manifests."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean, extract_number
from ..functions.urls import canonical_page, host, href_reason, resolve_url
from .aggregates import discovery_confidence
from .dom import Mark, around, marked_nodes, navigation, page_rows, stored
from .relational import append_missing, first_by, unique_ids


def classified_links(pages: DataFrame) -> DataFrame:
    """Links of pages(page_id, url, html) in order: node_id, href, anchor_text, target, reason, route and whether they stand in navigation."""
    return anchors(pages, context=navigation, texts=False, plain=set()).filter("href is not null").withColumnRenamed("text", "anchor_text")


# What in an element's id, classes or role makes it a place of links to systems, a list of entries, or a relation.
CONTEXT_HINTS = ["nav", "menu", "system", "category", "catalog", "directory", "index"]
LIST_HINTS = ["list", "cards", "grid", "entries", "items", "catalog", "directory", "index", "relation", "mapping"]
RELATION_HINTS = ["relation", "source", "drop", "mapping", "location", "来源", "获取"]
ITEM_TYPE = "item_type_list|name|"


def _said(attrs: dict[str, str], *names: str) -> str:
    return " ".join(attrs.get(k, "") for k in names).lower()


def _context(tag, attrs, classes):
    return "" if tag in ("nav", "header") or any(h in _said(attrs, "id", "class", "role") for h in CONTEXT_HINTS) else None


def _anchor(tag, attrs, classes):
    return attrs["href"] if tag == "a" and "href" in attrs else None


def _hinted(tag, attrs, classes):
    return "" if any(h in _said(attrs, "id", "class") for h in LIST_HINTS) else None


def anchors(pages: DataFrame, marks: dict[str, Mark] | None = None, context: Mark = _context, **asked) -> DataFrame:
    """Nodes of pages(page_id, url, html) dealt by page, with href, target, reason and route on anchors, and whether a link stands in
    an element that `context` marks (nav). Further columns of pages stay in `page`."""
    rest = [c for c in pages.columns if c != "html"]
    every = {"context": context, "a": _anchor} | (marks or {})
    nodes = marked_nodes(pages.select(F.struct(*rest).alias("page_id"), "html"), every, **asked).withColumnRenamed("page_id", "page").withColumn("page_id", F.col("page.page_id")).repartition("page_id")
    url, href = F.col("page.url"), F.when(F.col("a.node") == F.col("node_id"), F.col("a.value"))
    nodes = nodes.withColumn("href", href).withColumn("target", resolve_url(F.col("href"), url))
    nodes = nodes.withColumn("reason", F.when(F.col("href").isNotNull(), href_reason(F.col("href"), url, F.col("target")))).withColumn("route", F.when(F.col("href").isNotNull(), canonical_page(F.col("target"))))
    return nodes.withColumn("nav", around("context").isNotNull())


def systems_from_pages(pages: DataFrame, known: DataFrame, utility: list[str]) -> DataFrame:
    """Systems that pages link to: accepted links with a text, no utility slugs, that stand in a context of systems or
    lead to a known system wherever they stand; the first of each route. Known ones (system_id, name, route) are confirmed, and stay if no page
    links to them; others are candidate_<slug>, with _2 and so on where slugs fall together."""
    slug = F.regexp_extract("route", r"([^/]+)$", 1)
    a = anchors(pages, fields=["text"], texts=False, plain=set()).filter((F.col("reason") == "accepted") & (F.col("text") != "")).withColumn("slug", slug).filter(~F.lower("slug").isin(*utility or [""]))
    a = a.select("page_id", "node_id", "route", "slug", "text", "nav").join(known.select("route", F.col("system_id").alias("_id")), "route", "left").filter("nav or _id is not null")
    first = first_by(a, ["route"], ["page_id", "node_id"])
    plain = F.nullif(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(F.try_url_decode("slug"), F.col("slug"))), "[^a-z0-9]+", "_"), "^_+|_+$", ""), F.lit(""))
    rows = first.select(F.coalesce("_id", F.concat(F.lit("candidate_"), F.coalesce(plain, F.lit("unknown")))).alias("system_id"), F.col("text").alias("name"), "route",
        F.when(F.col("_id").isNotNull(), "confirmed").otherwise("candidate").alias("discovery_status"), "page_id", "node_id")
    return append_missing(unique_ids(rows, "system_id", ["page_id", "node_id"]).drop("page_id", "node_id"), known.select("system_id", "name", "route", F.lit("confirmed").alias("discovery_status")), "route")


def links_below(nodes: DataFrame, ok: str) -> DataFrame:
    """Elements of nodes with n_below, how many rows of `ok` stand in them, themselves included, and n_elements, the elements below.
    A running count over the places where elements begin and end, in document order, tells both without any list of ancestors and without a
    join; the last node in an element needn't be among the nodes."""
    begin, element = F.struct(F.col("node_id").alias("at"), F.lit(0).alias("end")), F.col("tag") != "#text"
    places = F.when(element, F.array(begin, F.struct(F.col("last_id").alias("at"), F.lit(1).alias("end")))).otherwise(F.array(begin))
    w, own = Window.partitionBy("page_id").orderBy("_p.at", "_p.end", "node_id"), Window.partitionBy("page_id", "node_id").orderBy("_p.end")
    begins = F.col("_p.end") == 0
    run = nodes.withColumn("_p", F.explode(places)).withColumn("_run", F.count_if(begins & F.col(ok)).over(w)).withColumn("_els", F.count_if(begins & element).over(w))
    out = run.filter(element).withColumn("_to", F.lead("_run").over(own)).withColumn("_upto", F.lead("_els").over(own)).filter(begins)
    return out.withColumn("n_below", F.col("_to") - F.col("_run") + F.col(ok).cast("int")).withColumn("n_elements", F.col("_upto") - F.col("_els")).drop("_p", "_run", "_els", "_to", "_upto")


def max_repeat(counted: DataFrame, containers: DataFrame) -> DataFrame:
    """page_id, repeats: of the elements below each page's container(page_id, node_id, last_id) that hold an accepted link
    or are one (links_below), how many share the most frequent tag and classes."""
    box = containers.select("page_id", F.col("node_id").alias("_c"), F.col("last_id").alias("_l"))
    inside = counted.filter("n_below > 0").join(box, "page_id").filter(F.col("node_id").between(F.col("_c") + 1, F.col("_l")))
    classes = F.array_join(F.filter(F.split(F.coalesce(F.try_element_at("attrs", F.lit("class")), F.lit("")), r"\s+"), lambda c: c != ""), ".")
    return inside.groupBy("page_id", F.concat_ws(".", "tag", classes).alias("_s")).agg(F.count(F.lit(1)).alias("n")).groupBy("page_id").agg(F.max("n").alias("repeats"))


def list_container(counted: DataFrame) -> DataFrame:
    """page_id, node_id, last_id, displayed: from a heading `label / N` up to the first element around it that holds N eligible links
    or more; the smallest of these, else the element with most links. counted: links_below, with the text of headings."""
    heads = counted.filter(F.col("tag").rlike("^h[1-6]$")).select("page_id", F.col("node_id").alias("_h"), extract_number(F.col("text"), r"/\s*(\d+)\s*$").alias("displayed")).filter("displayed is not null")
    some = counted.filter("n_below > 0").select("page_id", "node_id", "last_id", "n_below", (F.col("last_id") - F.col("node_id")).alias("size"))
    up = heads.join(some, "page_id").filter(F.col("_h").between(F.col("node_id") + 1, F.col("last_id")) & (F.col("n_below") >= F.col("displayed")))
    place = F.struct("size", "node_id", "last_id", "displayed")
    near = up.groupBy("page_id", "_h").agg(F.max_by(place, "node_id").alias("p")).groupBy("page_id").agg(F.min("p").alias("best"))
    most = some.groupBy("page_id").agg(F.min_by(F.struct("node_id", "last_id"), F.struct(-F.col("n_below"), "size", "node_id")).alias("most"))
    j = most.join(near, "page_id", "left")
    return j.select("page_id", F.coalesce("best.node_id", "most.node_id").alias("node_id"), F.coalesce("best.last_id", "most.last_id").alias("last_id"), "best.displayed")


def _heading(tag, attrs, classes):
    return "" if tag in ("h1", "h2", "h3", "h4", "h5", "h6") else None


def entries_from_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries of each directory page: different accepted links in its container, in order; report with counts, the container's
    node W10 and confidence G22)."""
    nodes = anchors(pages, {"head": _heading}, navigation, fields=["last_id", "tag", "text"], texts=False).withColumn("ok", F.coalesce((F.col("reason") == "accepted") & ~F.col("nav"), F.lit(False)))
    # Texts are kept of links and headings, and counted nodes have those of headings alone.
    head = F.col("head.node") == F.col("node_id")
    nodes = stored(nodes.select("page_id", "node_id", "last_id", "tag", F.when(head | F.col("ok"), F.col("text")).alias("text"), "ok", F.when(F.col("ok"), F.col("route")).alias("route"), F.coalesce(head, F.lit(False)).alias("head")), "links")
    counted = links_below(nodes.select("page_id", "node_id", "last_id", "tag", F.when(F.col("head"), F.col("text")).alias("text"), "ok"), "ok")
    box = list_container(stored(counted.select("page_id", "node_id", "last_id", "tag", "text", "n_below"), "counted")).select("page_id", F.col("node_id").alias("_c"), F.col("last_id").alias("_l"), "displayed")
    # A container counts itself, as its links were counted: where a page has one link, no smaller element holds as many.
    inside = nodes.filter("ok").join(box, "page_id").filter(F.col("node_id").between(F.col("_c"), F.col("_l")))
    once = inside.groupBy("page_id", "route").agg(F.min("node_id").alias("_n"), F.min_by("text", "node_id").alias("text"))
    entries = once.select("page_id", "route", clean(F.col("text")).alias("name"), (F.row_number().over(Window.partitionBy("page_id").orderBy("_n")) - 1).alias("source_order"))
    report = inside.groupBy("page_id").agg(F.count(F.lit(1)).alias("occurrences"), F.count_distinct("route").alias("n_unique"), F.max("displayed").alias("displayed"), F.first("_c").alias("container")).withColumn("duplicates", F.col("occurrences") - F.col("n_unique"))
    report = pages.select("page_id").join(report, "page_id", "left").withColumn("has_container", F.col("n_unique").isNotNull()).fillna(0, ["occurrences", "n_unique", "duplicates"])
    return entries, discovery_confidence(report)


def _flat(href) -> object:
    """A link to a leaf beside the page: no slash, scheme or host, and neither empty nor dots."""
    plain = F.trim(href)
    return plain.rlike(r"^(?![A-Za-z][A-Za-z0-9+.-]*:)[^/?#]+(\?.*|#.*)?$") & ~plain.rlike(r"^\.{1,2}([?#]|$)")


_LEAVES = pa.schema([("nodes", pa.list_(pa.int32())), ("hrefs", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("keys", pa.list_(pa.string()))])
_PAST = re.compile("[/?#]")


def _leaves(nodes: list[list]) -> Iterator[tuple]:
    """Links of a page that may be to leaves beside it (_flat): their nodes, targets, texts and text keys. Others have a slash where a leaf ends, or no leaf."""
    rows = []
    for n, _, items, _, text, (a,) in nodes:
        href = a[2]
        past = _PAST.search(href)
        if past is None or (past[0] != "/" and href[: past.start()].strip(" ")):
            rows.append((n, href, text, next((v for k, v in items if k == "data-i18n"), None)))
    if rows:
        yield tuple(zip(*rows))


def flat_directory(pages: DataFrame, least: int = 10, markers: int = 3) -> DataFrame:
    """page_id, route, name, source_order, entries, markers, duplicates: the entries of pages whose accepted links beside the
    page lead to `least` different pages or more, while `markers` of these links or more are texts of item types.

    A page's links are one row, told while it is parsed; those to leaves alone are resolved, and rows are dealt by page once."""
    loose = {"href": r"""[^/"&<>?#:.\s][^/"&<>?#]*""", "data-i18n": r"""[^"&<>]+"""}
    rows = page_rows(pages.select(F.struct("page_id", "url").alias("page_id"), "html"), {"a": _anchor}, _leaves, _LEAVES, "nodes array<int>, hrefs array<string>, texts array<string>, keys array<string>",
        attrs={"data-i18n"}, texts=False, plain=set(), loose=loose, cleaned={"texts"})
    zipped = F.arrays_zip(F.col("nodes").alias("node_id"), F.col("hrefs").alias("href"), F.col("texts").alias("text"), F.col("keys").alias("key"))
    a = rows.select("page_id.*", F.explode(F.filter(zipped, lambda x: _flat(x["href"]))).alias("x")).select("page_id", "url", "x.*")
    # Behind explode, as Spark would resolve a link again for each look at its target.
    a = a.select("*", F.explode(F.array(resolve_url(F.col("href"), F.col("url")))).alias("target"))
    a = a.filter(href_reason(F.col("href"), F.col("url"), F.col("target")) == "accepted").select("page_id", "node_id", "text", canonical_page(F.col("target")).alias("route"), F.coalesce(F.startswith("key", F.lit(ITEM_TYPE)), F.lit(False)).alias("marked"))
    a = a.repartition("page_id")
    once = a.groupBy("page_id", "route").agg(F.min("node_id").alias("node_id"), F.min_by("text", "node_id").alias("text"), F.count(F.lit(1)).alias("k"), F.count_if("marked").alias("m"))
    w = Window.partitionBy("page_id")
    out = once.withColumn("entries", F.count(F.lit(1)).over(w)).withColumn("markers", F.sum("m").over(w)).withColumn("duplicates", F.sum("k").over(w) - F.col("entries"))
    out = out.filter((F.col("entries") >= least) & (F.col("markers") >= markers)).withColumn("source_order", F.row_number().over(w.orderBy("node_id")) - 1)
    name = F.coalesce(F.nullif("text", F.lit("")), F.regexp_extract("route", r"([^/]+)$", 1))
    return out.select("page_id", "route", name.alias("name"), "source_order", "entries", "markers", "duplicates")


def routes_from_snapshot(pages: DataFrame, indexed: DataFrame) -> DataFrame:
    """Every linked route with its referring pages and the evidence for it (snapshot, index)."""
    seen = classified_links(pages).filter("reason = 'accepted'").groupBy("route").agg(F.count_distinct("page_id").alias("pages"), F.min("page_id").alias("first_page"))
    j = seen.withColumn("_s", F.lit("snapshot")).join(indexed.select("route", F.lit("index").alias("_i")).distinct(), "route", "full_outer")
    return j.select("route", F.coalesce("pages", F.lit(0)).alias("pages"), "first_page", F.array_compact(F.array("_i", "_s")).alias("evidence"))


def apply_classification(systems: DataFrame, results: DataFrame) -> DataFrame:
    """Status and role of systems from verified results(system_id, page_type, entry_count)."""
    j = systems.join(results, "system_id", "left")
    status = F.when(F.col("page_type") == "confirmed_directory", "confirmed").when(F.col("page_type").isin("navigation_only", "content_page", "empty_or_invalid"), "rejected").otherwise(F.col("discovery_status"))
    return j.withColumn("discovery_status", status).withColumn("role", F.when(F.col("page_type") == "relation_index", "relation").when(F.col("page_type") == "confirmed_directory", "directory"))


def batch_report(results: DataFrame) -> DataFrame:
    """Outcome per system and in total."""
    return results.rollup("system_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("outcome") == "ok").alias("ok"), F.count_if(F.col("outcome") != "ok").alias("failed"))


def recovered_manifest(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(available candidates, the first of each route; counts by validation)."""
    good = first_by(candidates.filter("status = 'available'"), ["route"], ["pos"])
    return good, candidates.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def classify_directory(pages: DataFrame) -> DataFrame:
    """page_type and confidence of pages(page_id, status, redirected, text, n_links, n_nav, n_unique, repeats,
    has_container, has_table, relation_hint, displayed, n_paragraphs, flat; n_chars: the text's length, if text isn't whole)."""
    text = F.coalesce(F.trim("text"), F.lit(""))
    size = F.col("n_chars") if "n_chars" in pages.columns else F.length(text)
    bad = (F.col("status") != 200) | F.col("redirected")
    listed = F.col("has_container") & (F.col("n_unique") >= 2) & (F.col("repeats") >= 2)
    kind = (F.when(bad | (text == ""), "empty_or_invalid").when(F.col("flat") & (F.col("n_unique") >= 2), "confirmed_directory")
            .when(F.col("relation_hint") & F.col("has_table") & (F.col("n_unique") >= 2) & (F.col("repeats") >= 2), "relation_index").when(listed, "confirmed_directory")
            .when(F.col("has_container") & (F.col("n_unique") == 1), "needs_review").when((F.col("n_links") >= 2) & (F.col("n_nav") == F.col("n_links")), "navigation_only")
            .when((F.col("n_paragraphs") >= 2) & (size >= 80) & (F.col("n_links") <= 2), "content_page").otherwise("needs_review"))
    differs = F.col("displayed").isNotNull() & (F.col("displayed") != F.col("n_unique"))
    score = (F.when(kind == "empty_or_invalid", F.when(bad, 1.0).otherwise(0.95)).when(kind == "relation_index", 0.9).when((kind == "confirmed_directory") & differs, 0.85).when(kind == "confirmed_directory", 0.95)
             .when(kind.isin("navigation_only", "content_page"), 0.9).when(F.col("has_container") & (F.col("n_unique") == 1), 0.55).otherwise(0.5))
    return pages.withColumn("page_type", kind).withColumn("confidence", score)


def _wanted(tag, attrs, classes):
    """Elements whose text is looked at."""
    return tag if tag in ("title", "p", "h1", "h2", "h3", "h4", "h5", "h6", "body", "html") else None


def page_features(pages: DataFrame, inventory: list[str] | None = None) -> DataFrame:
    """What F11 looks at, from pages(page_id, system_id, url, status, final_url, html) themselves: one row a page, for classify_directory.

    The container is the nearest element around a heading `label / N` that holds an accepted link with a text, the one with the
    fewest elements if several headings name one; else the element with most such links among those whose id or classes
    hint at a list. Inside it different routes, occurrences and repeats (W09) are counted. Pages of systems in
    `inventory` (inventory, candidate_inventory) are tried as flat directories (M03) first."""
    inventory = inventory or ["inventory", "candidate_inventory"]
    whole = pages.select("page_id", "system_id", "url", "status", F.coalesce(F.nullif("final_url", F.lit("")), "url").alias("final_url"), F.coalesce("html", F.lit("")).alias("html"))
    marks = {"hint": _hinted, "said": _wanted, "mute": lambda t, a, c: "" if t in ("script", "style") else None}
    nodes = anchors(whole, marks, fields=["last_id", "tag", "attrs", "own_text", "text"], attrs={"id", "class", "role"}).withColumn("ok", F.coalesce((F.col("reason") == "accepted") & (F.col("text") != ""), F.lit(False)))
    # The parse, the resolved links and the counts are written once, as seven looks at them follow.
    told = [F.col(f"{m}.node") == F.col("node_id") for m in ("said", "hint")]
    nodes = stored(nodes.select("page_id", "node_id", "last_id", "tag", "attrs", "own_text", "text", "ok", "reason", "nav", "route", told[0].alias("own"), told[1].alias("hinted"), F.col("mute").isNotNull().alias("muted")), "links")
    counted = stored(links_below(nodes.select("page_id", "node_id", "last_id", "tag", "attrs", F.when(F.col("own"), F.col("text")).alias("text"), "ok", "own", "hinted"), "ok"), "counted")
    own = F.col("own")
    accepted = F.col("reason") == "accepted"
    seen = nodes.groupBy("page_id").agg(
        F.count_if(accepted).alias("n_links"), F.count_if(accepted & F.col("nav")).alias("n_nav"), F.count_if(F.col("reason") == "external_domain").alias("n_external"), F.count_if(F.col("reason") == "static_resource").alias("n_static"),
        F.count_if(own & (F.col("tag") == "p") & (F.col("text") != "")).alias("n_paragraphs"), F.sum(F.when((F.col("tag") == "#text") & ~F.col("muted"),
            F.length(clean(F.col("own_text"))) + (F.trim("own_text") != "").cast("int"))).alias("n_chars"),
        F.min_by("text", F.when(own & (F.col("tag") == "title"), F.col("node_id"))).alias("title"))
    place = lambda c: F.struct(F.col("n_elements"), F.col("node_id"), F.col("last_id"), F.col("tag"), F.lower(F.concat_ws(" ", *[F.try_element_at("attrs", F.lit(k)) for k in ("id", "class", "role")])).alias("said"))
    heads = counted.filter(own & F.col("tag").rlike("^h[1-6]$")).select("page_id", F.col("node_id").alias("_h"), F.col("text").alias("label"), extract_number(F.col("text"), r"/\s*(\d+)").alias("displayed")).filter("displayed is not null")
    around = heads.join(counted.filter("n_below > 0").select("page_id", "node_id", "last_id", place(None).alias("c")), "page_id").filter(F.col("_h").between(F.col("node_id") + 1, F.col("last_id")))
    near = around.groupBy("page_id", "_h", "label", "displayed").agg(F.max_by("c", "node_id").alias("c"))
    shown = near.groupBy("page_id").agg(F.min_by(F.struct("c", "label", "displayed"), F.struct("c.n_elements", "_h")).alias("s"))
    hinted = counted.filter(F.col("hinted") & (F.col("n_below") > 0)).groupBy("page_id").agg(F.max_by(place(None), F.struct("n_below", -F.col("node_id"))).alias("c"))
    box = shown.join(hinted, "page_id", "full_outer").select("page_id", F.coalesce("s.c", "c").alias("c"), F.col("s.label").alias("label"), F.col("s.displayed").alias("displayed"))
    box = box.select("page_id", "c.node_id", "c.last_id", "c.tag", "c.said", "label", "displayed")
    inside = nodes.select("page_id", F.col("node_id").alias("_n"), "ok", "route", F.col("tag").alias("_t")).join(box, "page_id").filter(F.col("_n").between(F.col("node_id"), F.col("last_id")))
    held = inside.groupBy("page_id").agg(F.count_distinct(F.when(F.col("ok"), F.col("route"))).alias("n_unique"), F.count_if("ok").alias("occurrences"),
        F.bool_or(F.col("_t") == "table").alias("has_table"), F.first("displayed").alias("displayed"),
                                         F.first(F.concat_ws(" ", "said", F.lower(F.coalesce("label", F.lit(""))))).alias("hints"))
    flat = flat_directory(whole.filter(F.col("system_id").isin(*inventory))).groupBy("page_id").agg(F.first("entries").alias("_entries"), F.first("duplicates").alias("_double"))
    out = whole.drop("html").join(seen, "page_id", "left").join(held, "page_id", "left").join(max_repeat(counted, box), "page_id", "left").join(flat, "page_id", "left")
    relation = F.exists(F.array(*map(F.lit, RELATION_HINTS)), lambda h: F.contains(F.coalesce("hints", F.lit("")), h))
    zero = lambda *c: F.coalesce(*c, F.lit(0))
    return out.select(
        "page_id", "system_id", "title", "status",
            (~canonical_page(F.col("final_url")).eqNullSafe(canonical_page(F.col("url"))) | (F.lower("final_url").rlike("^https?://") & (host(F.col("final_url")) != host(F.col("url"))))).alias("redirected"),
        F.greatest(zero("n_chars") - 1, F.lit(0)).alias("n_chars"), *[zero(c).alias(c) for c in ("n_links", "n_nav", "n_external", "n_static", "n_paragraphs", "repeats")], zero("_entries", "n_unique").alias("n_unique"),
        zero("_double", F.col("occurrences") - F.col("n_unique")).alias("duplicates"), F.col("n_unique").isNotNull().alias("has_container"),
            F.coalesce("has_table", F.lit(False)).alias("has_table"), relation.alias("relation_hint"), "displayed", F.col("_entries").isNotNull().alias("flat"))


def verify_pages(pages: DataFrame, inventory: list[str] | None = None) -> DataFrame:
    """F11 with W09 from pages(page_id, system_id, url, status, final_url, html): page_id, page_type, confidence and what they
    rest on."""
    seen = page_features(pages, inventory)
    return classify_directory(seen.withColumn("text", F.when(F.col("n_chars") > 0, F.lit("x"))))
