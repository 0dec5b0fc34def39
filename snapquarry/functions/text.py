"""Text expressions."""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def clean(text: Column) -> Column:
    """White space of any kind to single blanks, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def clean_lines(text: Column) -> Column:
    """The same within each line; empty lines go."""
    return F.array_join(F.filter(F.transform(F.split(text, r"\r?\n"), clean), lambda x: x != ""), "\n")


def clean_title(title: Column, marks: tuple[str, ...] = (" - ", " | ", "_")) -> Column:
    """A title up to the first of the marks that part it from the site's name."""
    out = title
    for m in marks:
        out = F.split_part(out, F.lit(m), F.lit(1))
    return clean(out)


def clean_summary(text: Column, slug: Column, titles: Column, noise: tuple[str, ...] = ()) -> Column:
    """Text without slug and titles, longest first, in any case, and without noise patterns."""
    names = F.array_sort(F.filter(F.array_append(titles, slug), lambda x: x.isNotNull() & (x != "")), lambda a, b: F.length(b) - F.length(a))
    quoted = lambda x: F.concat(F.lit(r"(?iu)\Q"), F.replace(x, F.lit(r"\E"), F.lit("")), F.lit(r"\E"))
    out = F.aggregate(names, F.coalesce(text, F.lit("")), lambda a, x: F.regexp_replace(a, quoted(x), F.lit(" ")))
    for n in noise:
        out = F.regexp_replace(out, n, " ")
    return clean(out)


def has_han(text: Column) -> Column:
    """Holds a Han character."""
    return F.coalesce(text.rlike(r"[\x{3400}-\x{9fff}]"), F.lit(False))


def display_name(own: Column, listed: Column, translated: Column, fallback: Column, key: Column) -> Column:
    """Own name if in Han, else the listed one, the translation, the fixed fallback, the id."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(F.when(has_han(own), own), blank(listed), blank(translated), blank(fallback), key)


def extract_number(text: Column, pattern: str, group: int = 1, kind: str = "int") -> Column:
    """A captured group as a number; null where nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast(kind)


def asset_type(url: Column, rel: Column | None = None, hint: Column | None = None) -> Column:
    """Style, script, image, font, media, data or other, from a hint, the link's rel, or the suffix."""
    none = F.lit(None).cast("string")
    rel, hint = F.lower(rel if rel is not None else none), F.lower(hint if hint is not None else none)
    ext = extension(url)
    return (
        F.when(hint.isin("style", "script", "image", "font"), hint).when(rel.contains("stylesheet"), "style").when(rel.contains("icon"), "image")
        .when(ext == "css", "style").when(ext.isin("js", "mjs"), "script").when(ext.isin("png", "jpg", "jpeg", "gif", "svg", "webp", "ico", "avif"), "image")
        .when(ext.isin("woff", "woff2", "ttf", "otf", "eot"), "font").when(ext.isin("mp4", "webm", "mp3", "ogg"), "media").when(ext.isin("json", "xml"), "data").otherwise("other")
    )


def extension(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"\.([A-Za-z0-9]+)$", 1))


def asset_path(url: Column, kind: Column) -> Column:
    """Place of an asset: type, two characters of its hash, hash, suffix."""
    h = F.sha2(url, 256)
    return F.concat_ws("/", kind, F.substring(h, 1, 2), F.concat(h, F.when(extension(url) != "", F.concat(F.lit("."), extension(url))).otherwise("")))


def split_name(name: Column, default: str = "") -> Column:
    """Struct of what stands before and behind a bar."""
    part = lambda i: F.coalesce(F.nullif(F.trim(F.split_part(name, F.lit("|"), F.lit(i))), F.lit("")), F.lit(default))
    return F.struct(part(1).alias("name"), part(2).alias("variant"))


@F.pandas_udf(StringType())
def unescape(text: pd.Series) -> pd.Series:
    """HTML character references resolved."""
    return text.map(lambda x: None if x is None else _html.unescape(x))


def escape(text: Column) -> Column:
    """The five special characters escaped."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def trace(form: str, *columns: Column) -> Column:
    """One step told in a fixed form."""
    return F.format_string(form, *columns)


def ratio(a: Column, b: Column, digits: int = 6) -> Column:
    """A / b rounded; null where b is 0."""
    return F.round(a / F.nullif(b, F.lit(0)), digits)


def fold(text: Column) -> Column:
    """Case folded for matching."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def noise_flags(text: Column, tokens: list[str]) -> Column:
    """which of the given tokens the text holds, in any case."""
    return F.filter(F.array(*[F.lit(t) for t in tokens]), lambda t: F.contains(fold(text), fold(t)))


def snippet(text: Column, query: str, before: int = 60, size: int = 160) -> Column:
    """The text from `before` characters ahead of the first hit."""
    at = F.locate(query.lower(), F.lower(text))
    return F.when(at > 0, F.substring(text, F.greatest(F.lit(1), at - before), F.lit(size)))


def highlight(text: Column, query: str) -> Column:
    """Every hit between marks."""
    quoted = query.replace("\\E", "")
    return F.regexp_replace(text, rf"(?i)(\Q{quoted}\E)", "<mark>$1</mark>")
