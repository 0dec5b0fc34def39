"""Pages to DOM nodes in one pass (T01), with what stands around each node."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import new_folder

# Elements without an end tag, and elements that part lines.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "footer", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "nav", "ol", "p", "section", "table", "td", "th", "tr", "ul"}

def navigation(tag: str, attrs: dict[str, str], classes: set[str]) -> str | None:
    """nav and header, and what hints at navigation in its id, classes or role."""
    return "" if tag in ("nav", "header") or re.search("nav|menu|sidebar|breadcrumb", " ".join(attrs.get(k, "") for k in ("id", "class", "role")).lower()) else None


def around(mark: str) -> Column:
    """The nearest marked element around a node, itself not included (null: none)."""
    return F.when(F.col(f"{mark}.node") == F.col("node_id"), F.col(f"{mark}.outer")).otherwise(F.col(f"{mark}.node"))


def stored(df: DataFrame, name: str = "nodes") -> DataFrame:
    """df, written to the shared folder and read back: for what several looks need, as parsing is the dearest step and Spark would do it
    for each look. Only the columns that are asked for are read."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tells whether an element (tag, attributes, classes) is marked: null, or the value that what is inside gets to know.
Mark = Callable[[str, dict[str, str], set[str]], "str | None"]
_FLAT = pa.schema([
    ("node_id", pa.int32()), ("parent_id", pa.int32()), ("last_id", pa.int32()), ("parent_last", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())),
    ("own_text", pa.string()), ("text", pa.string()), ("line", pa.int32())])
_SQL = {f.name: "int" if f.type == pa.int32() else "map<string,string>" if f.name == "attrs" else "string" for f in _FLAT}
#: Plain pages are told by patterns: tags with quoted attributes without references, and texts. All else is left to HTMLParser.
_PIECES = re.compile(r"<[^<>]*>|[^<]+")
_TAG = re.compile(r"""<(?:/([a-zA-Z][a-zA-Z0-9]*)[ \t\n\r\f]*|([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9_-]*(?:="[^"&]*"|='[^'&]*')?)*)[ \t\n\r\f]*(/?))>""")
_ATTR = re.compile(r"""([a-zA-Z][a-zA-Z0-9_-]*)(?:="([^"]*)"|='([^']*)')?""")
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext"}
_PLACE = pa.struct([("node", pa.int32()), ("top", pa.int32()), ("value", pa.string()), ("outer", pa.int32())])


class _Marked(HTMLParser):
    """Elements and texts (tag #text) in document order; an end tag closes up to the nearest open tag of its name, and one that has
    none is passed over. Each knows, of every mark, the nearest and the outermost marked element that
    it stands in, itself included. A node takes as much room as there are marks, however deep it stands."""

    def __init__(self, marks: dict[str, Mark], seen: dict[str, tuple] | None = None, attrs: set[str] | None = None, found: list[tuple] | None = None,
                 texted: bool | set[int] = True, asked: Callable[[str, str | None, tuple, bool], bool] | None = None, mute: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.found = [] if found is None else found  # (node, top, value, outer) of all marks; places are numbers in this list
        self.texted, self.asked = texted, asked  # texted: whether texts of marked elements are wanted, or of which marks
        self.mute = mute  # no text is given out as a node
        self.count = 0
        self.marks = marks
        self.seen = {} if seen is None else seen  # tags met so far, as written
        self.names = attrs
        self.rows: list[list] = []
        self.open: list[tuple] = []  # (node id, tag, places, whether its text is wanted)
        self.parts: dict[int, list[str]] = {}
        self.wanted: list[int] = []  # open elements whose text is wanted
        self.line = 0

    def _look(self, tag: str, attrs: dict[str, str]) -> tuple:
        """An element's attributes that are given out, what marks say of it (number of the mark, value), and whether its text is wanted."""
        classes = set(attrs.get("class", "").split())
        found = [(i, v) for i, v in enumerate(m(tag, attrs, classes) for m in self.marks.values()) if v is not None]
        texted = any(i in self.texted for i, _ in found) if isinstance(self.texted, set) else bool(found) and self.texted
        return [kv for kv in attrs.items() if self.names is None or kv[0] in self.names], found, texted

    def _add(self, tag: str, looked: tuple | None, own: str | None) -> tuple:
        n = self.count
        self.count = n + 1
        parent, places = (self.open[-1][0], self.open[-1][2]) if self.open else (None, (None,) * len(self.marks))
        items, found, texted = looked or ([], (), False)
        if found:
            now = list(places)
            for i, v in found:
                p = None if now[i] is None else self.found[now[i]]
                now[i] = len(self.found)
                self.found.append((n, p[1] if p else n, v, p[0] if p else None))
            places = tuple(now)
        if tag in BLOCKS:
            self.line += 1
        row = None
        if self.asked is None or self.asked(tag, own, places, bool(found)):
            row = [n, parent, n, None, len(self.open), tag, items, own, None, self.line, places]
            self.rows.append(row)
            if self.open:
                self.open[-1][5].append(row)
        return n, tag, places, texted, row, []

    def _start(self, tag: str, looked: tuple) -> None:
        frame = self._add(tag, looked, None)
        if tag not in VOID:
            self.open.append(frame)
            if frame[3]:
                self.wanted.append(frame[0])
                self.parts[frame[0]] = []

    def handle_starttag(self, tag, attrs):
        self._start(tag, self._look(tag, {k: v or "" for k, v in reversed(attrs)}))

    def handle_startendtag(self, tag, attrs):
        self._add(tag, self._look(tag, {k: v or "" for k, v in reversed(attrs)}), None)

    def _shut(self, k: int) -> None:
        last = self.count - 1
        while len(self.open) > k:
            n, tag, _, texted, row, inside = self.open.pop()
            self.line += tag in BLOCKS
            for r in inside:
                r[3] = last
            if row is not None:
                row[2] = last
            if texted:
                self.wanted.pop()
                said = self.parts.pop(n)
                if row is not None:
                    row[8] = " ".join(" ".join(said).split())

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][1] == tag:
                self._shut(k)
                return

    def handle_data(self, data):
        if self.wanted and self.open[-1][1] not in ("script", "style"):
            for n in self.wanted:
                self.parts[n].append(data)
        if self.mute:
            self.count += 1
        else:
            self._add("#text", None, data)

    def _read(self, piece: str) -> tuple | None:
        """(tag, what an element is, how it begins or ends) of a plain tag; None of anything else."""
        m = _TAG.fullmatch(piece)
        if not m:
            return None
        if m[1]:
            return m[1].lower(), None, "end"
        tag = m[2].lower()
        given = {k.lower(): a or b for k, a, b in reversed(_ATTR.findall(m[3]))}
        return None if tag in _RAW else (tag, self._look(tag, given), "alone" if m[4] else "start")

    def _events(self, html: str) -> list | None:
        """Plain tags and texts of a page, or None if it has other markup."""
        pieces = _PIECES.findall(html)
        if sum(map(len, pieces)) != len(html) or "&" in html[html.rfind("<") + 1 :]:
            return None
        out = []
        for piece in pieces:
            if piece[0] != "<":
                out.append(piece)
                continue
            event = self.seen.get(piece)
            if event is None:
                event = self._read(piece)
                if event is None:
                    return None
                if len(self.seen) >= 20000:
                    self.seen.clear()
                if len(piece) <= 200:
                    self.seen[piece] = event
            out.append(event)
        return out

    def nodes(self, html: str) -> list[list]:
        events = self._events(html)
        if events is None:
            self.feed(html)
            self.close()
        else:
            for e in events:
                if e.__class__ is str:
                    self.handle_data(unescape(e) if "&" in e else e)
                elif e[2] == "start":
                    self._start(e[0], e[1])
                elif e[2] == "end":
                    if self.open and self.open[-1][1] == e[0]:
                        self._shut(len(self.open) - 1)
                    else:
                        self.handle_endtag(e[0])
                else:
                    self._add(e[0], e[1], None)
        self._shut(0)
        return self.rows


class _Units(_Marked):
    """Nodes as page_rows reads them, [node id, tag, attributes, own text, text, places], with places themselves; where elements end isn't kept."""

    def _add(self, tag: str, looked: tuple | None, own: str | None) -> tuple:
        n = self.count
        self.count = n + 1
        places = self.open[-1][2] if self.open else (None,) * len(self.marks)
        items, found, texted = looked or ((), (), False)
        if found:
            now = list(places)
            for i, v in found:
                p = now[i]
                now[i] = (n, p[1], v, p[0]) if p else (n, n, v, None)
            places = tuple(now)
        row = None
        if self.asked is None or self.asked(tag, own, places, bool(found)):
            row = [n, tag, items, own, None, places]
            self.rows.append(row)
        return n, tag, places, texted, row

    def _end(self, frame: tuple) -> None:
        self.wanted.pop()
        said = self.parts.pop(frame[0])
        if frame[4] is not None:
            frame[4][4] = " ".join(" ".join(said).split())

    def _shut(self, k: int) -> None:
        while len(self.open) > k:
            frame = self.open.pop()
            if frame[3]:
                self._end(frame)

    def _run(self, pieces: list[str]) -> bool:
        """Reads plain tags and texts at once; False as soon as there is other markup."""
        seen, open_, mute, wanted = self.seen, self.open, self.mute, self.wanted
        for piece in pieces:
            event = seen.get(piece)
            if event is None:
                if piece[0] != "<":
                    if wanted or not mute:
                        self.handle_data(unescape(piece) if "&" in piece else piece)
                    else:
                        self.count += 1
                    continue
                event = self._read(piece)
                if event is None:
                    return False
                if len(seen) >= 20000:
                    seen.clear()
                if len(piece) <= 200:
                    seen[piece] = event
            tag, looked, how = event
            if how == "end":
                if open_ and open_[-1][1] == tag:
                    frame = open_.pop()
                    if frame[3]:
                        self._end(frame)
                else:
                    self.handle_endtag(tag)
            elif how == "start":
                self._start(tag, looked)
            else:
                self._add(tag, looked, None)
        return True

    def nodes(self, html: str, any_markup: bool = True) -> list[list] | None:
        """The nodes of a page; None of one that isn't plain, unless any markup is read."""
        pieces = _PIECES.findall(html)
        if sum(map(len, pieces)) != len(html) or "&" in html[html.rfind("<") + 1 :] or not self._run(pieces):
            if not any_markup:
                return None
            self.count, self.rows, self.parts = 0, [], {}
            self.open.clear()
            self.wanted.clear()
            self.feed(html)
            self.close()
        self._shut(0)
        return self.rows


def _maps(rows: tuple) -> pa.Array:
    """Lists of pairs as one array of maps."""
    ends, keys, values = [0], [], []
    for pairs in rows:
        for k, v in pairs:
            keys.append(k)
            values.append(v)
        ends.append(len(keys))
    return pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))


def _places(found: list[tuple]) -> pa.Array:
    """What marks found, as one array of structs."""
    columns = list(zip(*found)) or [()] * len(_PLACE)
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PLACE)], fields=list(_PLACE))


def _asked(names: list[str], keep: set[str] | None, texts: str | bool | set[str], plain: set[str] | None) -> Callable[[str, str | None, tuple, bool], bool] | None:
    """Which nodes of a parse are given out (marked_nodes); None: all."""
    chosen = [i for i, m in enumerate(names) if keep and m in keep]
    said = re.compile(texts) if isinstance(texts, str) else None
    told_in = [i for i, m in enumerate(names) if isinstance(texts, set) and m in texts]

    def asked(tag: str, own: str | None, places: tuple, marked: bool) -> bool:
        for i in chosen:
            if places[i] is not None:
                break
        else:
            if chosen:
                return False
        if tag == "#text":
            return said.search(own) is not None if said else any(places[i] is not None for i in told_in) if told_in else bool(texts)
        return plain is None or marked or tag in plain

    return None if not chosen and texts is True and plain is None else asked


def marked_nodes(pages: DataFrame, marks: dict[str, Mark], keep: set[str] | None = None, fields: list[str] | None = None, attrs: set[str] | None = None,
                 texts: str | bool | set[str] = True, plain: set[str] | None = None) -> DataFrame:
    """page_id, node_id, parent_id, last_id, parent_last (the parent's
    last_id), depth, tag, attrs, own_text (of texts, tag #text), text (of marked elements: all text inside, with single
    blanks; scripts and styles are passed over), line (a number that goes up where a block element begins or ends), and for
    each mark a struct of that name: node and top, the nearest and the outermost marked element around the node, itself
    included, the nearest one's value, and outer, the nearest one around that; null outside.

    Containment is settled while the page is parsed, so no rows carry their ancestors and nothing is joined to tell what
    holds what; a page of any depth gives rows of bounded size. A batch ends after 5,000 rows. `keep` names marks: only nodes in one
    of these are given out. Null pages give no rows.

    Spark can't see which columns of a parse are looked at, so an operator says so: `fields` are the columns that it wants beside page_id, node_id and the marks,
    `attrs` the attributes, `texts` the texts (a pattern: those that have it; names of marks: those in one of these; False: none), `plain` the tags of unmarked elements (without: all)."""
    kind = pages.schema["page_id"].dataType.simpleString()
    names = list(marks)
    asked = _asked(names, keep, texts, plain)
    flat = [(k, f) for k, f in enumerate(_FLAT) if fields is None or f.name == "node_id" or f.name in fields]
    texted = fields is None or "text" in fields

    def told(pages_of: pa.Array, at: list[int], rows: list[list], found: pa.Array) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [_maps(columns[k]) if f.name == "attrs" else pa.array(columns[k], f.type) for k, f in flat]
        if names:
            arrays += [found.take(pa.array(numbers, pa.int32())) for numbers in zip(*columns[10])]
        return pa.RecordBatch.from_arrays([pages_of.take(pa.array(at, pa.int64())), *arrays], names=["page_id", *[f.name for _, f in flat], *names])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple] = {}
        for batch in batches:
            at, rows, found, page_ids = [], [], [], batch.column("page_id")
            for page, html in enumerate(batch.column("html").to_pylist()):
                own = _Marked(marks, seen, attrs, found, texted, asked, texts is False).nodes(html) if html else []
                places = None
                for begin in range(0, len(own), 5000):
                    part = own[begin : begin + 5000]
                    at += [page] * len(part)
                    rows += part
                    if len(rows) >= 5000:
                        places = places or _places(found)
                        yield told(page_ids, at, rows, places)
                        at, rows = [], []
                if not rows:
                    found = []
            if rows:
                yield told(page_ids, at, rows, _places(found))

    schema = [f"page_id {kind}", *[f"{f.name} {_SQL[f.name]}" for _, f in flat], *[f"{m} struct<node: int, top: int, value: string, outer: int>" for m in names]]
    return pages.select("page_id", "html").mapInArrow(parsed, ", ".join(schema))


#: What a reader of page_rows is given: a page's nodes in document order, each as [node_id, tag, attrs, own_text, text, places], with a place
#: (node, top, value, outer; None outside) for each mark.
Read = Callable[[list[list]], "Iterator[tuple]"]
_BLANK = re.compile("\ue000([0-9]+)\ue001")


def _taken(at: list[int]) -> Callable[[list], list | tuple]:
    """What a list holds at these places."""
    return itemgetter(*at) if len(at) > 1 else lambda pool: [pool[i] for i in at]


class _Columns:
    """Rows of the pages of a batch, by column; a list's column is its values and where each list ends."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.at = schema, []
        self.values: list[list] = [[] for _ in schema]
        self.ends = [[0] if pa.types.is_list(f.type) else None for f in schema]

    def add(self, page: int, row: tuple) -> None:
        self.at.append(page)
        for held, ends, v in zip(self.values, self.ends, row):
            if ends is None:
                held.append(v)
            else:
                held.extend(v)
                ends.append(len(held))

    def fill(self, page: int, shape: list[tuple], n: int, pool: list) -> None:
        self.at.extend([page] * n)
        for held, ends, (taken, sizes) in zip(self.values, self.ends, shape):
            if ends is not None:
                begin = len(held)
                ends.extend([begin + k for k in sizes])
            held.extend(taken(pool))

    def batch(self, page_ids: pa.Array) -> pa.RecordBatch:
        arrays = [pa.array(held, f.type) if ends is None else pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(held, f.type.value_type))
                  for f, held, ends in zip(self.schema, self.values, self.ends)]
        return pa.RecordBatch.from_arrays([page_ids.take(pa.array(self.at, pa.int64())), *arrays], names=["page_id", *self.schema.names])


class _Shapes:
    """Plain pages that differ in nothing but texts and values of `loose` attributes have rows that differ in nothing else: the second page of a shape is read with
    numbered blanks in their place, and further ones only fill them in. What a reader tells must not depend on what such texts and
    values are (but for empty ones, which are no blanks)."""

    def __init__(self, loose: dict[str, str], schema: pa.Schema, cleaned: set[str]) -> None:
        self.cut = re.compile("|".join([r"((?<=>)[^<]+(?=<)", *[rf'(?<= {k}="){v}(?=")' for k, v in loose.items()]]) + ")")
        self.cleaned = [f.name in cleaned for f in schema]
        self.lists = [pa.types.is_list(f.type) for f in schema]
        self.known: dict[str, tuple | bool | None] = {}
        self.size = 0

    def _shape(self, rows: list[tuple], n: int) -> tuple:
        """Where the values of each column stand in a pool of blanks as written, blanks with single spaces, and more (returned too: fixed values, and pieces to be put together)."""
        fixed, mixed, columns = [], [], []
        for k, (cleaned, listed) in enumerate(zip(self.cleaned, self.lists)):
            at: list = []
            for v in (x for r in rows for x in (r[k] if listed else [r[k]])):
                parts = _BLANK.split(v) if isinstance(v, str) else [v]
                if len(parts) == 1:
                    at.append((1, len(fixed)))
                    fixed.append(v)
                elif len(parts) == 3 and not parts[0] and not parts[2]:
                    at.append((0, int(parts[1]) + cleaned * n))
                else:
                    at.append((2, len(mixed)))
                    mixed.append((cleaned, parts))
            columns.append((at, [sum(len(r[k]) for r in rows[: i + 1]) for i in range(len(rows))] if listed else None))
        begin = [0, 2 * n, 2 * n + len(fixed)]
        return [(_taken([begin[part] + i for part, i in at]), sizes) for at, sizes in columns], len(rows), fixed, mixed

    def told(self, html: str, read: Callable[[str], list[tuple] | None]) -> tuple | None:
        """(shape, number of rows, pool) of a page whose shape is known; None of others."""
        if "\ue000" in html or "'" in html:
            return None
        parts = self.cut.split(html)
        values, key = parts[1::2], "\ue000".join(parts[::2])
        shape = self.known.get(key, False)
        if shape is None:
            rows = read("".join(p if k % 2 == 0 else f"\ue000{k // 2}\ue001" for k, p in enumerate(parts)))
            shape = self.known[key] = rows is not None and self._shape(rows, len(values))
        elif shape is False and key not in self.known and len(key) <= 20000:
            if self.size >= 8_000_000:
                self.known.clear()
                self.size = 0
            self.known[key] = None
            self.size += len(key) + 200
        if not shape:
            return None
        columns, n, fixed, mixed = shape
        if "&" in html:
            values = [unescape(v) if "&" in v else v for v in values]
        clean = [" ".join(v.split()) for v in values]
        pool = [*values, *clean, *fixed]
        for cleaned, pieces in mixed:
            whole = "".join([p if k % 2 == 0 else values[int(p)] for k, p in enumerate(pieces)])
            pool.append(" ".join(whole.split()) if cleaned else whole)
        return columns, n, pool


def page_rows(pages: DataFrame, marks: dict[str, Mark], read: Read, schema: pa.Schema, ddl: str, keep: set[str] | None = None, attrs: set[str] | None = None,
              texts: bool | set[str] = True, plain: set[str] | None = None, said: set[str] | None = None, loose: dict[str, str] | None = None, cleaned: set[str] | None = None, placed: bool = False) -> DataFrame:
    """page_id and the rows that `read` tells of the nodes of each page while it is parsed, for units (rows of a table, boxes) that lie in one
    page anyway: so nodes, which are many times as large, are never dealt again. `schema` and `ddl` name what `read` gives; `said` names the marks whose text is wanted (without: all);
    `loose` attributes with the pattern of values that neither marks nor `read` look at (see _Shapes), `cleaned` the columns with texts of elements; the rest is as in marked_nodes.
    Where nodes are `placed`, parent_id, last_id, parent_last and line follow after places."""
    kind = pages.schema["page_id"].dataType.simpleString()
    names = list(marks)
    asked, texted = _asked(names, keep, texts, plain), True if said is None else {i for i, m in enumerate(names) if m in said}

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple] = {}
        shapes = _Shapes(loose or {}, schema, cleaned or set())

        def rows_of(html: str, any_markup: bool) -> list[tuple] | None:
            if placed:
                parser = _Marked(marks, seen, attrs, None, texted, asked, texts is False)
                if not any_markup and parser._events(html) is None:
                    return None
                rows, found = parser.nodes(html), parser.found
                return list(read([[r[0], r[5], r[6], r[7], r[8], [None if p is None else found[p] for p in r[10]], r[1], r[2], r[3], r[9]] for r in rows]))
            nodes = _Units(marks, seen, attrs, None, texted, asked, texts is False).nodes(html, any_markup)
            return None if nodes is None else list(read(nodes))

        for batch in batches:
            out, page_ids = _Columns(schema), batch.column("page_id")
            for page, html in enumerate(batch.column("html").to_pylist()):
                if not html:
                    continue
                filled = shapes.told(html, lambda blank: rows_of(blank, False))
                if filled:
                    out.fill(page, *filled)
                else:
                    for row in rows_of(html, True):
                        out.add(page, row)
                if len(out.at) >= 5000:
                    yield out.batch(page_ids)
                    out = _Columns(schema)
            if out.at:
                yield out.batch(page_ids)

    return pages.select("page_id", "html").mapInArrow(parsed, f"page_id {kind}, {ddl}")
