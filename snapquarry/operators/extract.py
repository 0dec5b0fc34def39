"""What is read from pages and their nodes."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import signature
from ..functions.text import clean, extract_number, has_han
from ..functions.urls import is_tracking, resolve_url
from .dom import marked_nodes, page_rows, stored

# Elements without visible text, kinds of script calls.
INVISIBLE = ["script", "style", "nav", "footer"]
CALLS = {
    "fetch": r"(?i)\bfetch\s*\(", "xhr": r"\bXMLHttpRequest\b", "ajax": r"(?i)\$\.ajax\s*\(", "get": r"(?i)\$\.get\s*\(", "post": r"(?i)\$\.post\s*\(",
    "axios": r"(?i)\baxios(?:\.|\s*\()", "websocket": r"(?i)\bWebSocket\s*\(", "eventsource": r"(?i)\bEventSource\s*\(",
    "beacon": r"sendBeacon\s*\(", "dynamic_import": r"\bimport\s*\(", "track": r"\btrack\s*\("}
HINTS = ["/api/", "/ajax/", "/search", "/cn/", "/tooltip", "/json"]
CALL_URLS = [
    r"(?i)(?:fetch|axios(?:\.get|\.post)?|\$\.(?:get|post))\s*\(\s*['\"]([^'\"]+)", r"(?i)\.open\s*\(\s*['\"][A-Z]+['\"]\s*,\s*['\"]([^'\"]+)",
    r"(?is)\$\.ajax\s*\(\s*\{[^}]*?\burl\s*:\s*['\"]([^'\"]+)", r"(?i)(?:WebSocket|EventSource)\s*\(\s*['\"]([^'\"]+)"]
NAVIGATES = r"(?i)(?:window\.)?location(?:\.href)?\s*=|window\.open\s*\("
LINK_LISTS = ["alts", "related skills", "关联技能"]
HREF = r'<a\s[^>]*?href="([^"]*)"'


def raw_links(pages: DataFrame) -> DataFrame:
    """T02, fast path: page_id, url, pos, href of each anchor, by pattern, without Python."""
    return pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("pos", "href"))


def links(pages: DataFrame) -> DataFrame:
    """page_id, node_id, pos, href, anchor text of each a[href]."""
    a = marked_nodes(pages, {"a": lambda t, attrs, classes: attrs["href"] if t == "a" and "href" in attrs else None}, {"a"}, fields=["text"], texts=False, plain=set()).filter("a.node = node_id")
    pos = F.row_number().over(Window.partitionBy("page_id").orderBy("node_id")) - 1
    return a.select("page_id", "node_id", pos.alias("pos"), F.col("a.value").alias("href"), F.coalesce("text", F.lit("")).alias("anchor_text"))


def asset_refs(pages: DataFrame) -> DataFrame:
    """page_id, node_id, attribute, url of every reference to an asset; srcset gives each of its candidates. One pass over the parse."""
    nodes = marked_nodes(pages, {"style": lambda t, attrs, classes: "" if t == "style" else None}, fields=["tag", "attrs", "own_text"],
        attrs={"src", "href", "poster", "data", "srcset", "style"}, texts={"style"})
    at = lambda k: F.try_element_at("attrs", F.lit(k))
    css = lambda c: F.coalesce(F.regexp_extract_all(c, F.lit(r"url\(\s*['\"]?([^'\")]+)"), F.lit(1)), F.array().cast("array<string>"))
    srcset = F.transform(F.split(at("srcset"), ","), lambda p: F.split_part(F.trim(p), F.lit(" "), F.lit(1)))
    one = lambda name, v, *tags: F.when(F.col("tag").isin(*tags), F.struct(F.lit(name).alias("attribute"), v.alias("url")))
    single = F.array(one("src", at("src"), "img", "script", "source", "video", "audio", "embed"), one("href", at("href"), "link"), one("poster", at("poster"), "video"), one("data", at("data"), "object"))
    several = F.transform(F.coalesce(F.when(F.col("tag").isin("img", "source"), srcset), F.array()), lambda u: F.struct(F.lit("srcset").alias("attribute"), u.alias("url")))
    said = F.when(F.col("tag") == "style", None).when(F.col("tag") != "#text", at("style")).when(F.col("style").isNotNull(), F.col("own_text"))
    styled = F.transform(css(said), lambda u: F.struct(F.lit("style").alias("attribute"), u.alias("url")))
    every = F.filter(F.concat(single, several, styled), lambda s: s.isNotNull() & s["url"].isNotNull() & (s["url"] != ""))
    return nodes.select("page_id", "node_id", F.explode(every).alias("r")).select("page_id", "node_id", "r.attribute", "r.url")


def css_refs(sheets: DataFrame) -> DataFrame:
    """Url, kind (import, font, url), ref of each reference in sheets(url, css); an import isn't counted twice."""
    imports = F.regexp_extract_all("css", F.lit(r"@import\s+(?:url\()?\s*['\"]?([^'\")\s;]+)"), F.lit(1))
    rest = F.regexp_replace("css", r"@import[^;]*;?", "")
    fonts = F.regexp_extract_all(rest, F.lit(r"(?s)(@font-face\s*\{[^}]*\})"), F.lit(1))
    plain = F.regexp_replace(rest, r"(?s)@font-face\s*\{[^}]*\}", "")
    of = lambda kind, refs: F.transform(refs, lambda r: F.struct(F.lit(kind).alias("kind"), r.alias("ref")))
    found = lambda c: F.regexp_extract_all(c, F.lit(r"url\(\s*['\"]?([^'\")]+)"), F.lit(1))
    every = F.concat(of("import", imports), of("font", F.flatten(F.transform(fonts, found))), of("url", found(plain)))
    return sheets.select("url", F.explode(every).alias("r")).select("url", "r.kind", "r.ref")


def tooltip_occurrences(pages: DataFrame, season: str = "s1", source_type: str = "page") -> DataFrame:
    """page_id, occurrence_id (season, source type, page, number in the page), method (missing, text or html), title, lines, text of every tooltip trigger. The
    payload of an attribute is parsed as a page of its own: with two or more children its first is the title."""
    nodes = marked_nodes(pages, {"tip": lambda t, attrs, classes: "" if attrs.get("data-bs-toggle") == "tooltip" else None}, {"tip"})
    t = nodes.filter("tip.node = node_id").select("page_id", "node_id", F.try_element_at("attrs", F.lit("data-bs-title")).alias("payload"))
    t = t.withColumn("n", F.row_number().over(Window.partitionBy("page_id").orderBy("node_id")) - 1)
    plain = F.trim("payload") != ""
    t = t.withColumn("method", F.when(F.col("payload").isNull(), "missing").when(plain & ~F.col("payload").contains("<"), "text").otherwise("html"))
    inner = stored(marked_nodes(t.filter("method = 'html'").select(F.struct("page_id", "n").alias("page_id"), F.col("payload").alias("html")), {}))
    elements = inner.filter("tag <> '#text' and tag <> 'br'")
    root = elements.filter("depth = 0").groupBy("page_id").agg(F.count(F.lit(1)).alias("roots"))
    level = elements.join(root, "page_id").filter(F.col("depth") == F.when(F.col("roots") == 1, 1).otherwise(0))
    head = level.groupBy("page_id").agg(F.min_by(F.struct("node_id", "last_id"), "node_id").alias("h"), F.count(F.lit(1)).alias("k"))
    rows = lines(inner).join(head, "page_id", "left").withColumn("titled", F.coalesce((F.col("k") >= 2) & F.col("first_node").between(F.col("h.node_id"), F.col("h.last_id")), F.lit(False)))
    parts = rows.groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("titled"), F.struct("line_no", "line")))), lambda x: x["line"]), " ").alias("title"),
        F.transform(F.array_sort(F.collect_list(F.when(~F.col("titled"), F.struct("line_no", "line")))), lambda x: x["line"]).alias("lines"))
    parts = parts.select(F.col("page_id.page_id").alias("page_id"), F.col("page_id.n").alias("n"), F.nullif("title", F.lit("")).alias("title"), "lines")
    out = t.join(parts, ["page_id", "n"], "left").withColumn("lines", F.when(F.col("method") == "text", F.array(clean(F.col("payload")))).otherwise(F.coalesce("lines", F.array().cast("array<string>"))))
    return out.select("page_id", F.concat_ws(".", F.lit(season), F.lit("tooltip"), F.lit(source_type), "page_id", "n").alias("occurrence_id"), "method", "title", "lines", F.nullif(F.array_join("lines", "\n"), F.lit("")).alias("text"))


def visible_text(pages: DataFrame, excluded_ids: list[str] | None = None, strict: bool = False) -> DataFrame:
    """page_id, text: texts outside invisible elements and excluded sections, in order. strict leaves out inactive
    panes, historical cards, data tables and hidden nodes too, and whole cards whose header names a link list. One sweep over each page."""
    ids, invisible = {i.lower() for i in excluded_ids or []}, set(INVISIBLE)

    def gone(tag: str, attrs: dict, classes: set) -> str | None:
        if tag in invisible or attrs.get("id", "").lower() in ids:
            return ""
        if not strict:
            return None
        low, at = {c.lower() for c in classes}, {k: v.lower() for k, v in attrs.items()}
        hidden = "tab-pane" in low and not low & {"active", "show"} or "npc" in at.get("id", "") or any("npc" in c for c in low) or tag == "table" and "datatable" in low
        hidden = hidden or bool(low & {"previousitem", "history", "historical", "d-none"}) or "hidden" in attrs or at.get("aria-hidden") == "true"
        return "" if hidden or re.search(r"display:\s*none|visibility:\s*hidden", at.get("style", "")) else None

    has = lambda name: lambda tag, attrs, classes: "" if name in {c.lower() for c in classes} else None
    nodes = marked_nodes(pages, {"gone": gone, "card": has("card"), "head": has("card-header")}, fields=["last_id", "tag", "own_text"], texts="[^ ]", plain=set()).repartition("page_id")
    if strict:
        named = (F.col("tag") == "#text") & F.col("head").isNotNull() & F.lower(F.trim("own_text")).isin(*LINK_LISTS)
        nodes = nodes.withColumn("listed", F.count_if(named).over(Window.partitionBy("page_id", "card.node")) > 0)
        lists = F.collect_list(F.when((F.col("card.node") == F.col("node_id")) & F.col("listed"), F.struct("node_id", "last_id"))).over(Window.partitionBy("page_id"))
        nodes = nodes.withColumn("lists", lists).filter(~F.exists("lists", lambda c: F.col("node_id").between(c["node_id"], c["last_id"])))
    kept = nodes.filter((F.col("tag") == "#text") & (F.trim("own_text") != "") & F.col("gone").isNull())
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("node_id", "own_text"))), lambda x: x["own_text"])
    return kept.groupBy("page_id").agg(clean(F.array_join(ordered, " ")).alias("text"))


def visible_text_fast(html: Column) -> Column:
    """T06, fast path by patterns for regular pages: script, style, nav and footer go with what they hold, then tags."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for tag in INVISIBLE:
        out = F.regexp_replace(out, rf"(?s)<{tag}[^>]*>.*?</{tag}>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"(?s)<[^>]*>", " "), r"[ \t\r\n]+", " "))


def lines(nodes: DataFrame) -> DataFrame:
    """page_id, line_no, first_node, line: texts of marked_nodes between block elements, with single blanks, empty ones dropped."""
    text = F.transform(F.array_sort(F.collect_list(F.struct("node_id", "own_text"))), lambda x: x["own_text"])
    rows = nodes.filter("tag = '#text'").groupBy("page_id", F.col("line").alias("line_no"))
    return rows.agg(F.min("node_id").alias("first_node"), clean(F.array_join(text, "")).alias("line")).filter("line <> ''")


def _heading(tag, attrs, classes):
    return tag if tag in ("title", "h1", "h2", "h3", "h4", "h5", "h6") else None


def headings(pages: DataFrame, references: list[str] | None = None) -> DataFrame:
    """page_id, title, first heading, first heading with Han characters. One pass: of the parse, only titles and headings go on,
    and one aggregate tells them apart. With `references` only character references of these names are read, others stay as written."""
    if references:
        pages = pages.withColumn("html", F.regexp_replace("html", rf"&(?!(?:{'|'.join(references)});)", "&amp;"))
    h = marked_nodes(pages, {"h": _heading}, {"h"}, fields=["tag", "text"], texts=False, plain=set()).filter("h.node = node_id")
    named, title = (F.col("tag") != "title") & (F.col("text") != ""), F.col("tag") == "title"
    han = named & has_han(F.col("text"))
    first = lambda c, name: F.min_by("text", F.when(c, F.col("node_id"))).alias(name)
    return h.groupBy("page_id").agg(first(title, "title"), first(named, "heading"), first(han, "han_heading")).filter("title is not null or heading is not null")


_STRINGS = pa.list_(pa.string())
_ROWS = pa.schema([("section_id", pa.string()), ("table_no", pa.int32()), ("row_index", pa.int32()), ("headers", _STRINGS), ("cells", _STRINGS), ("stable_key", pa.string()), ("tier_value", pa.string())])
_ROWS_SQL = "section_id string, table_no int, row_index int, headers array<string>, cells array<string>, stable_key string, tier_value string"


def _table_rows(nodes: list[list]) -> Iterator[tuple]:
    """The table rows of a page, from its tables, rows and cells in document order."""
    section, number, tables, held, headers = {}, {}, Counter(), {}, {}  # held: cells, headers, key and tier by table and row
    for n, tag, attrs, _, text, (div, table, row, cell) in nodes:
        t, r = table[0], row and row[0]
        if t == n:
            section[t] = div and div[2]
            number[t] = tables[section[t]]
            tables[section[t]] += 1
        if r is None or section[t] is None:
            continue
        one = held.setdefault((t, r), [[], [], None, None])
        if r == n:
            given = dict(attrs)
            one[2:] = given.get("data-modifier-id"), given.get("data-tier")
        elif cell and cell[0] == n:
            one[tag == "th"].append(text)
    order, at = sorted(held), Counter()
    for t, r in order:
        if held[t, r][1]:
            headers.setdefault(t, held[t, r][1])
    for t, r in order:
        cells, _, key, tier = held[t, r]
        if cells:
            yield section[t], number[t], at[t], headers.get(t, []), cells, key, tier
            at[t] += 1


def section_rows(pages: DataFrame) -> DataFrame:
    """page_id, section_id, table_no, row_index, headers, cells, stable_key, tier_value of every table row inside a
    div with an id. Cells belong to the nearest row, rows to the nearest table, tables to the nearest such div; tables are numbered within sections of
    one id. Rows are told apart while a page is parsed, and nothing is dealt again."""
    tags = lambda *names: lambda t, attrs, classes: t if t in names else None
    marks = {"section": lambda t, attrs, classes: attrs["id"] if t == "div" and "id" in attrs else None, "table": tags("table"), "row": tags("tr"), "cell": tags("td", "th")}
    return page_rows(pages, marks, _table_rows, _ROWS, _ROWS_SQL, {"table"}, attrs={"data-modifier-id", "data-tier"}, texts=False, plain=set(), said={"cell"},
        loose={"data-modifier-id": '[^"&<>]+', "data-tier": '[^"&<>]+'}, cleaned={"cells", "headers"})


def section_descriptor(rows: DataFrame) -> DataFrame:
    """page_id, section_id, tables, rows, keyed rows, headers of the first table."""
    return rows.groupBy("page_id", "section_id").agg(F.count_distinct("table_no").alias("tables"), F.count(F.lit(1)).alias("rows"), F.count("stable_key").alias("keyed"),
        F.min_by("headers", F.struct("table_no", "row_index")).alias("headers"))


def level_tables(rows: DataFrame, name: str = "level") -> DataFrame:
    """The best level table of each page: first header is level; most rows, then smallest least, then largest greatest level."""
    levels = rows.filter(F.lower(F.get("headers", 0)) == name).withColumn("level", extract_number(F.get("cells", 0), r"^\s*(\d+)\s*$")).filter("level is not null")
    t = levels.groupBy("page_id", "section_id", "table_no").agg(F.count(F.lit(1)).alias("n"), F.min("level").alias("least"), F.max("level").alias("greatest"))
    w = Window.partitionBy("page_id").orderBy(F.desc("n"), "least", F.desc("greatest"), "section_id", "table_no")
    return t.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")



def script_calls(pages: DataFrame, keep: bool = False) -> DataFrame:
    """page_id (keep: all columns), how often each kind of call occurs in the page, whether scripts navigate, whether tooltips are named."""
    counts = [F.regexp_count("html", F.lit(p)).alias(k) for k, p in CALLS.items()]
    return pages.select("*" if keep else "page_id", *counts, F.rlike("html", F.lit(NAVIGATES)).alias("navigates"), F.rlike("html", F.lit(r"(?i)\btooltip\b")).alias("tooltips"))


def call_urls(pages: DataFrame) -> DataFrame:
    """page_id, target, kind (endpoint or tracking) of each URL that a script of a page(page_id, url, html) calls."""
    found = F.concat(*[F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in CALL_URLS])
    rows = pages.select("page_id", "url", F.explode(found).alias("href"))
    rows = rows.withColumn("target", resolve_url(F.col("href"), F.col("url"))).filter("target is not null")
    return rows.select("page_id", "target", F.when(is_tracking(F.col("target")), "tracking").otherwise("endpoint").alias("kind"))


def url_hints(pages: DataFrame) -> DataFrame:
    """Hint, n: how often each part of a URL that hints at a server occurs, in any case."""
    low = pages.select(F.lower("html").alias("html"))
    each = F.array(*[F.struct(F.lit(h).alias("hint"), F.regexp_count("html", F.lit(rf"\Q{h}\E")).alias("n")) for h in HINTS])
    return low.select(F.explode(each).alias("h")).groupBy("h.hint").agg(F.sum("h.n").alias("n"))


#: Most languages that a template of a file name is filled with.
MOST_LANGUAGES = 1000


def i18n_refs(pages: DataFrame) -> DataFrame:
    """page_id, kind (lang, key, file), value: text keys of a page, the language of a page that has some, and the JSON files that it names,
    if i18n, lang, locale or translation stand in their path; ${lang} in a name stays."""
    of = lambda kind, values: F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))
    found = lambda p: F.regexp_extract_all("html", F.lit(p), F.lit(1))
    keys = F.filter(found(r"""\sdata-i18n=["']([^"']+)["']"""), lambda k: k != "")
    langs = F.when(F.size(keys) > 0, F.filter(found(r"""(?i)<html[^>]*?\slang=["']([^"']+)["']"""), lambda v: v != "")).otherwise(F.array().cast("array<string>"))
    files = F.filter(found(r"""((?:https?:)?//[^\s"'`]+\.json(?:\?[^\s"'`]*)?|/?[A-Za-z0-9_./${}-]+\.json(?:\?[^\s"'`]*)?)"""), lambda v: F.rlike(v, F.lit("(?i)/i18n/|^i18n/|lang|locale|translation")))
    return pages.select("page_id", F.explode(F.concat(of("lang", langs), of("key", keys), of("file", files))).alias("r")).select("page_id", "r.kind", "r.value")


def i18n_resources(pages: DataFrame, base: str) -> DataFrame:
    """resource_url (resolved against base), reference_type (direct_json or runtime_language_loader), pages, source_pages (the first five
    that name it). A name with ${lang} is filled with each language that pages with text keys have; more than MOST_LANGUAGES
    of these are an error."""
    refs = i18n_refs(pages)
    langs = [r.value for r in refs.filter("kind = 'lang'").select("value").distinct().orderBy("value").limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    named = refs.filter("kind = 'file'").select("page_id", F.col("value").alias("raw"))
    template = F.col("raw").contains("${lang}")
    filled = F.transform(F.array(*map(F.lit, langs)).cast("array<string>"), lambda v: F.replace("raw", F.lit("${lang}"), v))
    each = named.select("page_id", F.when(template, "runtime_language_loader").otherwise("direct_json").alias("type"), F.explode(F.when(template, filled).otherwise(F.array("raw"))).alias("name"))
    each = each.select("page_id", "type", resolve_url(F.col("name"), F.lit(base)).alias("resource_url"))
    once = each.groupBy("resource_url", "page_id").agg(F.min("type").alias("type"))
    # A name that all pages have must not meet in one task: each task gives its first five of a name, and its count.
    first = once.withColumn("_n", F.row_number().over(Window.partitionBy("resource_url").orderBy("page_id"))).filter("_n <= 5")
    first = first.groupBy(F.col("resource_url").alias("_url")).agg(F.array_sort(F.collect_list("page_id")).alias("source_pages"))
    counted = once.groupBy("resource_url").agg(F.min("type").alias("reference_type"), F.count(F.lit(1)).alias("pages"))
    return counted.join(first, F.col("resource_url").eqNullSafe(F.col("_url"))).select("resource_url", "reference_type", "pages", "source_pages")


def page_shell(pages: DataFrame) -> DataFrame:
    """page_id, shell: signature of the page's style sheets, scripts, and whether it has nav, side bar and footer."""
    found = lambda p: F.regexp_extract_all("html", F.lit(p), F.lit(1))
    return pages.select("page_id", signature(
        styles=F.concat(found(r'<link[^>]*href="([^"]+)"'), found(r"(?s)<style[^>]*>(.*?)</style>")), scripts=found(r'<script[^>]*src="([^"]+)"'),
        nav=F.col("html").contains("<nav"), side=F.col("html").contains("sidebar"), footer=F.col("html").contains("<footer")).alias("shell"))


def page_features(pages: DataFrame, keep: bool = False) -> DataFrame:
    """page_id (keep: all columns) and flags."""
    html = F.col("html")
    return pages.select("*" if keep else "page_id", html.contains("data-bs-toggle=\"tooltip\"").alias("has_tooltip"), html.contains("collapse").alias("has_collapse"), html.contains("tab-pane").alias("has_tab"),
                        html.contains("dropdown").alias("has_dropdown"), html.rlike("(?i)datatable").alias("has_table"), html.contains('class="ad"').alias("has_ad"), html.contains("<nav").alias("has_nav"))
