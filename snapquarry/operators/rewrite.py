"""Pages rewritten for local use (T16): references are found by parser events, settled by joins, and put in where they stand."""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import TRACKING_PARTS, canonical_page, host, is_tracking, resolve_url

# Attributes that refer to assets, elements of trackers that go with what they hold, and those that go alone.
ASSETS = {"link": {"href"}, "img": {"src", "srcset"}, "script": {"src"}, "source": {"src", "srcset"}, "video": {"src", "poster"}, "audio": {"src"}, "embed": {"src"}, "object": {"data"}, "iframe": {"src"}, "input": {"src"}}
WITH_CONTENT, ALONE = {"script", "iframe", "ins"}, {"link", "img", "source"}

_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_STYLE = re.compile(r"""@import\s+(?:"([^"]+)"|'([^']+)')|url\(\s*(?:"([^"]*)"|'([^']*)'|([^"'()\s]+))\s*\)""", re.I)


class _References(HTMLParser):
    """Where a page refers to something: spans (start, end, kind, value) of its text that may be put in anew, of kind asset, page or
    integrity, and spans that go. What is in no span stays as it is, byte for byte."""

    def __init__(self, text: str) -> None:
        super().__init__(convert_charrefs=False)
        self.text = text
        self.lines = [0, *(m.end() for m in re.finditer("\n", text))]
        self.spans: list[tuple[int, int, str, str]] = []
        self.gone: list[tuple[int, int]] = []
        self.own: dict[int, int] = {}  # where the one asset of a tag is named, and the tag starts; integrity is about these
        self.skipped: list | None = None  # [tag, depth, start]
        self.style = False
        self.feed(text)
        self.close()
        if self.skipped:
            self.gone.append((self.skipped[2], len(text)))

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _css(self, start: int, text: str) -> None:
        for m in _STYLE.finditer(text):
            k = next(i for i in range(1, 6) if m.group(i) is not None)
            self.spans.append((start + m.start(k), start + m.end(k), "asset", m.group(k)))

    def handle_starttag(self, tag, attrs):
        raw, start = self.get_starttag_text(), self._at()
        if self.skipped:
            self.skipped[1] += tag == self.skipped[0]
            return
        if tag in WITH_CONTENT | ALONE and any(p in markup.unescape(raw).lower() for p in TRACKING_PARTS):
            if tag in WITH_CONTENT and not raw.endswith("/>"):
                self.skipped = [tag, 1, start]
            else:
                self.gone.append((start, start + len(raw)))
            return
        self.style = tag == "style"
        for m in _ATTRIBUTE.finditer(raw, 1 + len(tag)):
            k = next((i for i in (2, 3, 4) if m.group(i) is not None), 0)
            if not k:
                continue
            name, value, at = m.group(1).lower(), m.group(k), start + m.start(k)
            if name == "srcset" and "srcset" in ASSETS.get(tag, ()):
                for part in re.finditer(r"[^\s,][^\s]*(?:\s+[^,]*)?", value):
                    url = re.match(r"\S+", part.group())
                    size = len(url.group().rstrip(","))
                    self.spans.append((at + part.start(), at + part.start() + size, "asset", markup.unescape(url.group()[:size])))
            elif name in ASSETS.get(tag, ()):
                self.spans.append((at, at + len(value), "asset", markup.unescape(value)))
                self.own[at] = start
            elif tag == "a" and name == "href":
                self.spans.append((at, at + len(value), "page", markup.unescape(value)))
            elif name == "style":
                self._css(at, value)
            elif name == "integrity" and tag in ASSETS:
                self.spans.append((start + m.start(), start + m.end(), "integrity", str(start)))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.style = False

    def handle_endtag(self, tag):
        self.style = False
        if self.skipped and tag == self.skipped[0]:
            self.skipped[1] -= 1
            if not self.skipped[1]:
                end = self.text.find(">", self._at())
                self.gone.append((self.skipped[2], len(self.text) if end < 0 else end + 1))
                self.skipped = None

    def handle_data(self, data):
        if self.style and not self.skipped:
            self._css(self._at(), data)


STATS = ["n_refs", "n_assets", "n_pages", "n_remote", "n_unknown_pages", "n_removed", "n_integrity"]


def _parts(value: str) -> tuple[str, str]:
    """Query with its mark, and fragment with its mark."""
    head, mark, fragment = value.partition("#")
    return head[head.index("?") :] if "?" in head else "", mark + fragment


def _put(text: str, known: dict[str, str | None]) -> tuple[str, Counter]:
    found, stats = _References(text), Counter()
    stats["n_removed"] = len(found.gone)
    edits = [(a, b, "") for a, b in found.gone]
    changed = set()
    for a, b, kind, value in found.spans:
        if kind == "integrity":
            continue
        stats["n_refs"] += 1
        key = f"{kind} {value}"
        path = known.get(key)
        if path is None:
            stats["n_remote" if kind == "asset" else "n_unknown_pages"] += key in known
            continue
        query, fragment = _parts(value)
        stats["n_assets" if kind == "asset" else "n_pages"] += 1
        edits.append((a, b, path + (query if kind == "page" else "") + fragment))
        changed.add(found.own.get(a))
    for a, b, kind, value in found.spans:
        if kind == "integrity" and int(value) in changed:
            stats["n_integrity"] += 1
            edits.append((a, b, ""))
    out, at = [], 0
    for a, b, new in sorted(edits):
        if a >= at:
            out += [text[at:a], new]
            at = b
    return "".join([*out, text[at:]]), stats


def page_references(pages: DataFrame) -> DataFrame:
    """page_id, url, kind (asset, page), ref: what each page refers to, once: attributes of assets, every candidate of srcset, url() and
    @import of style attributes and elements, links; nothing of trackers' elements, which go."""
    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kinds, refs = [], [], []
            for i, text in enumerate(batch.column("html").to_pylist()):
                for kind, ref in sorted({(k, v) for _, _, k, v in (_References(text).spans if text else ()) if k != "integrity"}):
                    rows.append(i)
                    kinds.append(kind)
                    refs.append(ref)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id").take(at), batch.column("url").take(at), pa.array(kinds, pa.string()), pa.array(refs, pa.string())], names=["page_id", "url", "kind", "ref"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(told, f"page_id {kind}, url string, kind string, ref string")


def rewrite_pages(pages: DataFrame, assets: DataFrame, routes: DataFrame) -> DataFrame:
    """page_id, html and counts: references of pages(page_id, url, html) put to local paths. assets(url, path) by resolved URL, routes(route,
    path) by canonical page of the page's own host; fragments stay, and queries of page links. n_refs references, n_assets and n_pages of them rewritten, n_remote assets that
    aren't there and no trackers', n_unknown_pages, n_removed trackers' elements, n_integrity attributes that went since their asset is local.

    Parser events tell the spans of a page that may change; all else stays byte for byte, so a page that needs no change comes out as it is.
    References are resolved and looked up by joins, and what a page gets back is a map of its own references. Null pages stay null."""
    # Resolving is the dearest step here; as a row's only element it is worked out once, where filters would each repeat it.
    once = lambda c: F.explode_outer(F.array(c))
    refs = page_references(pages).withColumn("target", once(resolve_url(F.col("ref"), F.col("url")))).filter("target is not null")
    own = F.when((F.col("kind") == "page") & (host(F.col("target")) == host(F.col("url"))), canonical_page(F.col("target")))
    tracked = (F.col("kind") == "asset") & is_tracking(F.col("target"))
    refs = refs.withColumn("route", once(own)).filter(((F.col("kind") == "asset") & ~tracked & F.col("target").rlike("^https?:")) | F.col("route").isNotNull())
    j = refs.join(assets.select(F.col("url").alias("target"), F.col("path").alias("_asset")), "target", "left").join(routes.select("route", F.col("path").alias("_page")), "route", "left")
    entry = F.struct(F.concat_ws(" ", "kind", "ref").alias("k"), F.when(F.col("kind") == "asset", F.col("_asset")).otherwise(F.col("_page")).alias("v"))
    known = j.groupBy("page_id").agg(F.map_from_entries(F.collect_list(entry)).alias("known"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(None, Counter()) if text is None else _put(text, dict(k or ())) for text, k in zip(batch.column("html").to_pylist(), batch.column("known").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array([h for h, _ in out], pa.string()), *[pa.array([s[c] for _, s in out], pa.int64()) for c in STATS]], names=["page_id", "html", *STATS])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "html").join(known, "page_id", "left").mapInArrow(put, f"page_id {kind}, html string, " + ", ".join(f"{c} long" for c in STATS))
