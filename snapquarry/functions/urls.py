"""URL expressions: resolution, canonical pages, classes of links and of fetch results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values; links and paths of plain segments, and folders without empty or dot segments, are told by one pattern each.
PLAIN_LINK, PLAIN_PATH = r"^[A-Za-z0-9_-]+\z", r"^(/[A-Za-z0-9_-]+)+\z"
PLAIN_FOLDER = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(?:/[^/?#.][^/?#]*)*/)[^/?#]*(?:[?#].*)?\z"
STATIC_SUFFIXES = ["css", "js", "png", "jpg", "jpeg", "gif", "webp", "svg", "ico", "woff", "woff2", "ttf", "otf", "eot", "mp3", "mp4", "webm", "pdf", "json", "xml", "txt", "map"]
TRACKING_PARTS = ["google-analytics", "googletagmanager", "doubleclick", "facebook.net", "hotjar", "clarity.ms", "adservice", "analytics", "nitropay", "cloudflareinsights"]
NON_CONTENT = ["api", "cache", "login", "logout", "search", "signin", "signup"]
SKIPPED_SCHEMES = ["#", "data:", "blob:", "javascript:", "mailto:"]


def skipped(href: Column) -> Column:
    """Links that are not resolved."""
    low = F.lower(F.trim(href))
    out = href.isNull() | (low == "")
    for p in SKIPPED_SCHEMES:
        out = out | low.startswith(p)
    return out


def _without_dots(parts: Column) -> Column:
    """Path of segments with . and .. carried out; one that ends in them ends in a slash."""
    none = F.array().cast("array<string>")
    kept = F.aggregate(parts, none, lambda a, s: F.when(s == ".", a).when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.array_append(a, s)))
    return F.concat(F.lit("/"), F.array_join(F.when(F.element_at(parts, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept), "/"))


def resolve_url(href: Column, base: Column) -> Column:
    """Href resolved against base, without fragment, by built-in expressions alone. A link with a scheme stays as it
    is, one that begins with // takes the base's scheme; dot segments of other links are carried out."""
    h = F.split_part(F.trim(href), F.lit("#"), F.lit(1))
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    own, rest = F.split_part(h, F.lit("?"), F.lit(1)), F.regexp_extract(h, r"(?s)(\?.*)$", 1)
    folder = F.slice(F.split(path(base), "/"), F.lit(2), F.greatest(F.size(F.split(path(base), "/")) - 2, F.lit(0)))
    rooted = F.split(F.substr(own, F.lit(2)), "/")
    joined = F.concat(folder, F.split(own, "/"))
    last = F.size(joined)
    relative = F.filter(joined, lambda s, i: (s != "") | (i == last - 1))
    beside = F.regexp_extract(base, PLAIN_FOLDER, 1)
    return (
        F.when(href.rlike(PLAIN_LINK) & (beside != ""), F.concat(beside, href))
        .when(href.rlike(PLAIN_PATH), F.concat(site, href))
        .when(skipped(href), None)
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/") & ~own.rlike(r"/\.\.?(/|$)"), F.concat(site, h))
        .when(h.startswith("/"), F.concat(site, _without_dots(rooted), rest))
        .when(own == "", F.concat(site, path(base), rest))
        .otherwise(F.concat(site, _without_dots(relative), rest))
    )


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def encoded(segment: Column) -> Column:
    """A path segment decoded and encoded again in one way (E02); a plus sign stays one."""
    plain = F.coalesce(F.try_url_decode(F.replace(segment, F.lit("+"), F.lit("%2B"))), segment)
    out = F.url_encode(plain)
    for a, b in (("+", "%20"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def canonical_page(url: Column, hosts: list[str] | None = None) -> Column:
    """Path of a page with each segment encoded in one way and no slash at its end; null where the host is not
    allowed or a segment is a dot segment or holds an encoded slash."""
    parts = F.filter(F.split(path(url), "/"), lambda s: s != "")
    bad = F.exists(parts, lambda s: s.isin(".", "..") | F.lower(s).contains("%2f"))
    ok = ~bad if hosts is None else ~bad & host(url).isin(*hosts)
    whole = F.when(ok, F.concat(F.lit("/"), F.array_join(F.transform(parts, encoded), "/")))
    return whole if hosts is not None else F.when(path(url).rlike(PLAIN_PATH), path(url)).otherwise(whole)


def route(url: Column) -> Column:
    """Canonical page with a slash at its end."""
    page = canonical_page(url)
    return F.when(page == "/", page).otherwise(F.concat(page, F.lit("/")))


def entity_id(route_column: Column, site: str) -> Column:
    """Site:language:slug of a route."""
    lang, slug = F.regexp_extract(route_column, r"^/([^/]+)/", 1), F.regexp_extract(route_column, r"([^/]+)/?$", 1)
    return F.concat_ws(":", F.lit(site), lang, slug)


def is_static(url: Column) -> Column:
    """the path ends in a suffix of a static file."""
    return F.lower(F.regexp_extract(path(url), r"\.([A-Za-z0-9]+)$", 1)).isin(*STATIC_SUFFIXES)


def is_tracking(url: Column) -> Column:
    """the host belongs to a tracking service."""
    return F.exists(F.array(*[F.lit(p) for p in TRACKING_PARTS]), lambda p: F.contains(host(url), p))


def is_non_content(url: Column) -> Column:
    """the page id is one that holds no content."""
    return F.coalesce(F.lower(F.regexp_extract(path(url), r"([^/]+)/?$", 1)).isin(*NON_CONTENT), F.lit(False))


def href_reason(href: Column, base: Column, resolved: Column) -> Column:
    """the first reason that applies: empty, anchor, javascript, mailto, external_domain, static_resource,
    invalid_path, self, accepted."""
    low = F.lower(F.trim(href))
    return (
        F.when(href.isNull() | (low == ""), "empty").when(low.startswith("#"), "anchor").when(low.startswith("javascript:"), "javascript")
        .when(low.startswith("mailto:"), "mailto").when(resolved.isNull() | (host(resolved) != host(base)), "external_domain")
        .when(is_static(resolved), "static_resource").when(~path(resolved).rlike(r"^(/[^/]+){1,2}/?$"), "invalid_path")
        .when(canonical_page(resolved) == canonical_page(base), "self").otherwise("accepted")
    )


# What a page says that is an error though it was served.
ERROR_MARKS = ["<title>404", "not found</title>", "页面不存在"]
ERROR_TERMS = ["404", "not found", "error response", "页面不存在"]


def classify_fetch(status: Column, requested: Column, final: Column, html: Column, look: int = 20_000) -> Column:
    """not_found, network_error, redirected (the final URL, if there is one, is another page), invalid (another status than 200,
    or an error mark in the first `look` characters, beyond which a page isn't looked at) or available."""
    low = F.lower(F.substring(F.coalesce(html, F.lit("")), 1, look))
    marked = F.exists(F.array(*map(F.lit, ERROR_MARKS)), lambda m: F.contains(low, m))
    there = canonical_page(final)
    return (
        F.when(status == 404, "not_found").when(status >= 500, "network_error")
        .when(there.isNotNull() & ((there != canonical_page(requested)) | (host(final) != host(requested))), "redirected")
        .when((status != 200) | status.isNull() | marked, "invalid").otherwise("available")
    )


def is_content_page(status: Column, requested: Column, final: Column, title: Column, canonical: Column, text: Column) -> Column:
    """served with 200 at its own path, with a title, no error term in title or text, and a canonical link, if there is one, to
    itself."""
    own = lambda u: F.regexp_replace(path(u), "/+$", "")
    low = F.lower(F.concat_ws(" ", title, text))
    said = F.exists(F.array(*map(F.lit, ERROR_TERMS)), lambda m: F.contains(low, m))
    named = F.nullif(F.trim(canonical), F.lit(""))
    fits = named.isNull() | (own(resolve_url(named, final)) == own(requested))
    return F.coalesce((status == 200) & (own(final) == own(requested)) & fits & (F.coalesce(F.trim(title), F.lit("")) != "") & ~said, F.lit(False))
